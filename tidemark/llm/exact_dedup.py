"""Exact dedup with an extendible-hash index kept in shared files.

A directory of ``2**global_depth`` entries maps the leading bits of a text's key to a bucket and
the bucket to its owner.  It doubles until no bucket holds more keys than a page should; a bucket
that is as deep as the directory may be gets overflow pages.  The index files are laid out by
owner and page.  Owner tasks walk the chain of equal keys in their pages and compare the
normalised bytes; a key that very many rows share is walked in parts, whose leaders meet again.
Only texts whose key occurs more than once are ever moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.grams import mix
from tidemark.llm.scratch import addressed, quoted, stored, without_rows

_BLANK = b"\x20\x09\x0a\x0b\x0c\x0d"
CAPACITY, DIRECTORY_BITS, KEY_BITS = 2_000, 16, 63
#: Index folders, and rows of one key that one task walks.
OWNERS, CHAIN = 64, 1_000


@dataclass(frozen=True)
class Directory:
    """What each prefix of ``global_depth`` bits leads to.

    ``buckets[prefix]`` is the first prefix of the bucket that holds it, ``depths`` the bucket's
    local depth, ``pages`` the number of its pages (one, unless it overflows at full depth) and
    ``owners`` its owner, a range of buckets with about an equal share of all keys.
    """

    global_depth: int
    buckets: np.ndarray
    depths: np.ndarray
    pages: np.ndarray
    owners: np.ndarray

    def place(self, keys: np.ndarray, key_bits: int = 63) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Owner, bucket and page of each key."""
        prefix = keys >> (key_bits - self.global_depth)
        # The low bits of a key tell nothing about its bucket.
        return self.owners[prefix], self.buckets[prefix], mix(keys.astype(np.uint64)).view(np.int64) % self.pages[prefix]


def build_directory(cells: np.ndarray, cell_bits: int, capacity: int, owners: int = OWNERS) -> Directory:
    """Split overfull buckets, doubling the directory when a bucket is as deep as it.

    ``cells[p]`` is the number of keys whose ``cell_bits`` leading bits are ``p``.  Splitting
    ends at ``cell_bits``; a bucket still over ``capacity`` there spreads its keys over overflow
    pages.
    """
    before = np.concatenate([[0], np.cumsum(cells)])
    depth, starts, depths = 0, np.zeros(1, np.int64), np.zeros(1, np.int64)

    def load(prefix, local):
        width = 1 << (cell_bits - local)
        return before[prefix * width + width] - before[prefix * width]

    live = [(0, 0)]
    while live:
        bucket, local = live.pop()  # the bucket's prefix, of local bits
        if load(bucket, local) <= capacity or local == cell_bits:
            continue
        if local == depth:
            starts, depths, depth = np.repeat(starts * 2, 2), np.repeat(depths, 2), depth + 1
        width = 1 << (depth - local)
        low, half = bucket * width, width // 2
        depths[low : low + width] = local + 1
        starts[low + half : low + width] = low + half
        live += [(bucket * 2, local + 1), (bucket * 2 + 1, local + 1)]
    width = 1 << (cell_bits - depth)
    ends = starts + (1 << (depth - depths))
    loads = before[ends * width] - before[starts * width]
    share = max(1, -(-int(before[-1]) // owners))
    return Directory(depth, starts, depths, np.maximum(1, -(-loads // capacity)), before[starts * width] // share)


def _entries(docs: DataFrame, id_col: str, text_col: str, key_bits: int) -> DataFrame:
    """``id, code_points, sha, key`` of each row; the key is the digest's leading bits."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, shas, keys = [], [], []
            for text in batch.column("text").to_pylist():
                digest = hashlib.sha256(_normal(text))
                points.append(len(text or ""))
                shas.append(digest.hexdigest())
                keys.append(_key(digest, key_bits))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(points, pa.int64()), pa.array(shas, pa.string()), pa.array(keys, pa.int64())],
                ["id", "code_points", "sha", "key"],
            )

    return rows.mapInArrow(run, f"id {kind}, code_points bigint, sha string, key bigint")


def _normal(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(None, _BLANK)


def _key(digest, key_bits: int) -> int:
    return int.from_bytes(digest.digest()[:8], "big") >> (64 - key_bits) << (63 - key_bits)


def _pages(
    docs: DataFrame, id_col: str, text_col: str, key_bits: int, directory: Directory, row: Column, memory: int = 32 << 20
) -> DataFrame:
    """Index entries with their bytes: ``row, id, code_points, sha, key, owner, bucket, page, head, body``.

    ``row`` is a handle of the row.  A task remembers up to ``memory`` bytes of texts; a row
    whose bytes are equal to a remembered one points to it as its ``head`` and brings no bytes
    along, so of a text with very many copies each task sends few on.
    """
    rows = docs.select(row.alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind, handle = (rows.schema[c].dataType.simpleString() for c in ("id", "row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, tuple[int, bytes]] = {}
        room = memory
        for batch in batches:
            texts = batch.column("text").to_pylist()
            points, shas, keys, heads, bodies = [], [], [], [], []
            for row, text in zip(batch.column("row").to_pylist(), texts):
                body = _normal(text)
                digest = hashlib.sha256(body)
                points.append(len(text or ""))
                shas.append(digest.hexdigest())
                keys.append(_key(digest, key_bits))
                known = seen.get(digest.digest())
                if known and known[1] == body:
                    heads.append(known[0])
                    bodies.append(None)
                    continue
                heads.append(row)
                bodies.append(body)
                if known is None and len(body) <= room:
                    seen[digest.digest()] = (row, body)
                    room -= len(body)
            keys = np.array(keys, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), batch.column("id"), pa.array(points, pa.int64()), pa.array(shas, pa.string()),
                    pa.array(keys), *map(pa.array, directory.place(keys)), pa.array(heads, batch.column("row").type),
                    pa.array(bodies, pa.binary()),
                ],
                ["row", "id", "code_points", "sha", "key", "owner", "bucket", "page", "head", "body"],
            )

    return rows.mapInArrow(
        run,
        f"row {handle}, id {kind}, code_points bigint, sha string, key bigint, owner bigint, bucket bigint, "
        f"page bigint, head {handle}, body binary",
    )


def _chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk entries sorted by key and part: each ``row`` and the ``first`` row of its chain with
    equal bytes; the leaders of keys that lie in several parts keep key and bytes.

    Holds one text for each different text of one key, and nothing of other keys.
    """
    at, chain = None, []
    for batch in batches:
        firsts, keys, bodies = [], [], []
        columns = (batch.column(c).to_pylist() for c in ("row", "key", "part", "parts", "body"))
        for row, key, part, parts, body in zip(*columns):
            if (key, part) != at:
                at, chain = (key, part), []
            first = next((f for f, b in chain if b == body), None)
            leads = first is None
            if leads:
                first = row
                chain.append((row, body))
            firsts.append(first)
            keys.append(key if leads and parts > 1 else None)
            bodies.append(body if leads and parts > 1 else None)
        kind = batch.column("row").type
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(firsts, kind), pa.array(keys, pa.int64()), pa.array(bodies, pa.binary())],
            ["row", "first", "key", "body"],
        )


def _first_rows(pages: DataFrame) -> DataFrame:
    """``head, first``: for each row with bytes the first row with the same ones."""
    kind = pages.schema["row"].dataType.simpleString()
    walk = f"row {kind}, first {kind}, key bigint, body binary"
    index = stored(
        pages.filter(F.col("body").isNotNull())
        .withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
        .select("owner", "bucket", "page", "key", "part", "parts", "row", "body")
        .repartition("owner", "page", "part")
        .sortWithinPartitions("owner", "bucket", "page", "key", "part"),
        "dedup-index",
        by="owner",
    )
    firsts = stored(
        index.repartition("owner", "bucket", "page", "part")
        .sortWithinPartitions("owner", "bucket", "page", "key", "part", "row")
        .mapInArrow(_chains, walk),
        "dedup-firsts",
    )
    # Leaders of the parts of one key: as many as it has parts and different texts.
    leaders = firsts.filter(F.col("body").isNotNull()).select(
        "row", "key", F.lit(0).cast("long").alias("part"), F.lit(1).cast("long").alias("parts"), "body"
    )
    met = leaders.repartition("key").sortWithinPartitions("key", "row").mapInArrow(_chains, walk)
    met = met.select(F.col("row").alias("first"), F.col("first").alias("leader"))
    return firsts.join(met, "first", "left").select(
        F.col("row").alias("head"), F.coalesce("leader", "first").alias("first")
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    directory_bits: int = DIRECTORY_BITS,
    key_bits: int = KEY_BITS,
) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``.

    Texts are equal if identical without the characters ``[\\x20\\x09-\\x0D]``; null is empty.
    Of equal texts the one with the most code points stays, then the smallest id, a null id
    last; rows that are equal in id and text each count as kept.  An empty table gives no rows.

    ``capacity`` is the number of keys of a bucket, ``2**directory_bits`` the largest directory
    (all that the driver holds), ``key_bits`` the length of a key: short keys only make longer
    chains.  A text whose key occurs once has no equal and does not enter the index.
    """
    entries, again, members = _index(docs, id_col, text_col, capacity, directory_bits, key_bits)
    # Stored, so that the join back on a hot group has shuffles of its own, which Spark can split.
    groups = stored(
        members.groupBy("first").agg(F.count(F.lit(1)).alias("group_size"), _best().alias("best")), "dedup-groups"
    )
    linked = members.join(groups, "first").select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("id").eqNullSafe(F.col("best.id")) & (F.col("code_points") == -F.col("best.n"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    alone = entries.join(again, "key", "left_anti").select(
        F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"),
    )
    return alone.unionByName(linked)


def _best(*ties: str) -> Column:
    """Of a group the entry that stays."""
    return F.min(F.struct((-F.col("code_points")).alias("n"), F.col("id").isNull().alias("none"), "id", *ties))


def _index(
    docs: DataFrame, id_col: str, text_col: str, capacity: int, directory_bits: int, key_bits: int,
    handle: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The entries of all rows, the keys that occur again (with their rows), and of those rows ``id, code_points,
    sha, first``, with ``row`` if the rows have a ``handle``; ``first`` is the same for equal texts.
    """
    entries = stored(_entries(docs, id_col, text_col, key_bits), "dedup-entries")
    again = stored(
        entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "dedup-keys"
    )
    cells = np.zeros(1 << directory_bits, np.int64)
    cell = F.shiftright("key", 63 - directory_bits).alias("cell")
    loads = again.groupBy(cell).agg(F.count(F.lit(1)).alias("n")).toArrow()  # 2**directory_bits rows at most
    cells[loads["cell"].to_numpy()] = loads["n"].to_numpy()
    directory = build_directory(cells, directory_bits, capacity)

    row = F.col(handle) if handle else F.monotonically_increasing_id()
    pages = stored(
        _pages(docs, id_col, text_col, key_bits, directory, row)
        .join(again, "key")
        .withColumn("parts", F.ceil(F.col("n") / CHAIN)),
        "dedup-pages",
    )
    members = stored(
        pages.select(*(["row"] if handle else []), "id", "code_points", "sha", "head").join(_first_rows(pages), "head"),
        "dedup-members",
    )
    return entries, again, members


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts: the one with the most code points, then
    the smallest id, a null id last; of rows that are equal in that any one."""
    rows, handle = addressed(docs, "dedup-rows")
    _, _, members = _index(rows, id_col, text_col, CAPACITY, DIRECTORY_BITS, KEY_BITS, handle)
    groups = stored(members.groupBy("first").agg(_best("row").alias("best")), "dedup-groups")
    gone = stored(
        members.join(groups, "first").filter(F.col("row") != F.col("best.row")).select(F.col("row").alias(handle)),
        "dedup-gone",
    )
    return without_rows(rows, handle, gone).select(*quoted(docs.columns))
