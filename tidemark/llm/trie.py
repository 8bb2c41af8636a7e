"""Prefix trie of conversations by range minima over sorted longest common prefixes.

Conversations become sequences of turn keys, equal ones become one, and all are sorted.  A node
of the trie is a prefix, its members a run of the sorted sequences.  The sequences are cut into
blocks; in each, a sparse table of the common prefixes of neighbours lets every prefix search
its left and right end by itself.  All a node tells is a sum or minimum over its run, so the
parts of a run that lies in several blocks are added up by the node's name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ranks import lookup, positions
from tidemark.llm.scratch import frame, stored

#: A turn's key: 16 bytes of its digest, then the UTF-8 length of its text.
KEY_BYTES = 24
BLOCK_BYTES = 256 << 10
_SEGMENT = 4096
_ROOT = bytes(16)


def turn_key(role: Column, text: Column) -> Column:
    """48 hex digits: 128 bits of the digest of role and text, and the text's length in bytes."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    size = F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0")
    return F.concat(F.substring(F.sha2(whole, 256), 1, 32), F.lower(size))


def sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", head: Column | None = None) -> DataFrame:
    """``conv, seq``: each conversation's turn keys in order, as one binary value.

    ``turns`` has ``role, text``; nulls in them are empty.  Turns ascend, a null turn first; of
    equal turns the smaller key comes first.  Rows without a conversation are left out.

    With ``head``, a number for ``conv`` (0 to 8), a conversation starts with that many first turns
    of conversation ``conv - conv % 5`` (fewer if it has fewer) and goes on with its own turns
    after its first ``head``.

    Only keys are gathered, 24 bytes a turn and in two steps, so no task reads the single turns of
    a long conversation.  A conversation ends at 2 GB of keys, some 80 million turns.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = turns.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), turn_key(role, text).alias("key")
    )
    placed = stored(positions(rows, "conv", ["turn", "key"], "trie-sorted"), "trie-turns")
    own = placed if head is None else placed.filter(F.col("pos") >= head)
    pieces = own.groupBy("conv", F.expr(f"pos div {_SEGMENT}").alias("piece")).agg(_joined("pos", "key").alias("keys"))
    convs = placed.filter("pos = 0").select("conv")
    if head is not None:
        firsts = (
            placed.filter("pos < 8 and conv % 5 = 0")
            .groupBy("conv").agg(_joined("pos", "key").alias("keys")).withColumnRenamed("conv", "base")
        )
        wanted = convs.withColumn("base", F.expr("conv - conv % 5"))
        begin = F.substring(F.coalesce("keys", F.lit("")), F.lit(1), (head * KEY_BYTES * 2).cast("int"))
        heads = wanted.join(firsts, "base", "left").select("conv", F.lit(-1).cast("long").alias("piece"), begin.alias("keys"))
    else:
        heads = convs.select("conv", F.lit(-1).cast("long").alias("piece"), F.lit("").alias("keys"))
    whole = pieces.unionByName(heads).groupBy("conv").agg(_joined("piece", "keys").alias("keys"))
    return whole.select("conv", F.unhex("keys").alias("seq"))


def _joined(place: str, text: str) -> Column:
    """The texts of a group in order, as one."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(place).alias("at"), F.col(text).alias("text"))))
    return F.array_join(F.transform(ordered, lambda x: x["text"]), "")


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each name's texts, joined by commas; rows come sorted by name and place."""
    name, digest = None, None

    def row():
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([digest.hexdigest()])], ["name", "ends_sha256"])

    for batch in batches:
        for key, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist()):
            if key == name:
                digest.update(b",")
            else:
                if name is not None:
                    yield row()
                name, digest = key, hashlib.sha256()
            digest.update(ids.encode())
    if name is not None:
        yield row()


def _ends(named: DataFrame) -> DataFrame:
    """``name, ends_sha256``: digest of the ids of all conversations of one sequence.

    The ids of up to 4,096 neighbouring numbers are joined first; a digest of one list can only be
    made in one place, which reads these pieces as a stream and holds none.
    """
    pieces = named.groupBy("name", F.shiftright("conv", 12).alias("piece")).agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    texts = pieces.select("name", "piece", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    sorted_texts = texts.repartition("name").sortWithinPartitions("name", "piece").select("name", "ids")
    return sorted_texts.mapInArrow(_hash_lists, "name string, ends_sha256 string")


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """``table[k][i]`` is the minimum of ``values[i : i + 2**k]``."""
    table = [values]
    while (step := 1 << (len(table) - 1)) * 2 <= values.size:
        low = table[-1]
        table.append(np.minimum(low[:-step], low[step:]))
    return table


def extents(common: np.ndarray, at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row around each row ``at`` that share ``depth`` turns with it.

    ``common[i]`` is the common prefix of rows ``i - 1`` and ``i``.  Both ends are found by binary
    search over the sparse table, for all prefixes at once and each by itself.
    """
    table = sparse_table(common)
    left, right = at.copy(), at.copy()
    for k in range(len(table) - 1, -1, -1):
        width, low = 1 << k, table[k]
        can = right + width < common.size
        can[can] = low[right[can] + 1] >= depth[can]
        right[can] += width
        can = left - width >= 0
        can[can] = low[left[can] - width + 1] >= depth[can]
        left[can] -= width
    return left, right


def _common(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = (a[:n] != b[:n]).any(axis=1)
    return int(differ.argmax()) if n and differ.any() else n


_PARTS = (
    "id binary, parent binary, depth long, n_convs long, conv_id long, n_leaves long, total long, fresh long, "
    "before long, size long, ends_sha256 string"
)


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    """The nodes of one block of sorted sequences, each with what the block adds to it."""
    rows = rows.sort_values("start", kind="stable")
    home = rows["home"].to_numpy(bool)
    keys = [np.frombuffer(s, ">u8").reshape(-1, KEY_BYTES // 8) for s in rows["seq"]]
    earlier = keys[0] if not home[0] else None
    rows, keys = rows[home], [k for k, h in zip(keys, home) if h]
    n = len(keys)
    if not n:
        return frame({c.split()[0]: [] for c in _PARTS.split(", ")})
    # Common prefix with the row before, in this block or the one before; -1 for the first of all.
    common = np.array([_common(a, b) for a, b in zip(keys, keys[1:])], np.int64)
    first = -1 if earlier is None else _common(earlier, keys[0])
    common = np.concatenate([[first], common]).astype(np.int64)
    lengths = np.array([len(k) for k in keys], np.int64)
    reach = [np.concatenate([[0], np.cumsum(k[:, 2].astype(np.int64))]) for k in keys]
    total = np.array([r[-1] for r in reach], np.int64)
    fresh = total - np.array([r[max(c, 0)] for r, c in zip(reach, common)], np.int64)
    longer = np.concatenate([[-1 if earlier is None else len(earlier)], lengths[:-1]])
    extends = (common == longer) & (common >= 0)  # the row before is no leaf
    weight, least = rows["n"].to_numpy(np.int64), rows["least"].to_numpy(np.int64)
    ends = list(rows["ends_sha256"])

    known = np.concatenate([[-1], common[1:]])  # what an earlier row of this block has named already
    names, parents, path = [], [], [_ROOT]
    for low, key, seq in zip(known.tolist(), keys, rows["seq"]):
        del path[low + 1 :]
        if low < 0:
            path.append(_ROOT)
            names.append(_ROOT)
            parents.append(None)
        for d in range(max(low, 0), len(key)):
            above = path[-1]
            path.append(hashlib.sha256(above + seq[d * KEY_BYTES : (d + 1) * KEY_BYTES]).digest()[:16])
            names.append(path[-1])
            parents.append(above)
    new = lengths - known
    at = np.repeat(np.arange(n), new)
    depth = np.arange(at.size) - np.repeat(np.cumsum(new) - new, new) + np.repeat(known + 1, new)
    inner = common.copy()
    inner[0] = -1
    left, right = extents(inner, at, depth)

    def over(values):
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[right + 1] - sums[left]

    tables = sparse_table(least)
    span = np.frexp((right - left + 1).astype(float))[1] - 1
    lowest = np.empty(at.size, np.int64)
    for k, low in enumerate(tables):
        of = span == k
        lowest[of] = np.minimum(low[left[of]], low[right[of] - (1 << k) + 1])
    opens = common[left] < depth  # the run starts here, not in an earlier block
    before = np.array([reach[i][max(d - 1, 0)] for i, d in zip(at.tolist(), depth.tolist())], np.int64)
    size = np.array([reach[i][d] for i, d in zip(at.tolist(), depth.tolist())], np.int64) - before
    skipped = before - np.array([reach[i][max(c, 0)] for i, c in zip(left.tolist(), common[left].tolist())], np.int64)
    return frame(
        {
            "id": names, "parent": parents, "depth": depth, "n_convs": over(weight), "conv_id": lowest,
            "n_leaves": right - left + 1 - over(extends) + (opens & extends[left]),
            "total": over(total * weight), "fresh": over(fresh) - np.where(opens, skipped, 0),
            "before": before, "size": size,
            "ends_sha256": [ends[i] if lengths[i] == d else None for i, d in zip(left.tolist(), depth.tolist())],
        }
    )


def trie(convs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The nodes of the trie of ``conv, seq`` (``sequences``), one row each.

    ``conv_id`` (the smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``, and ``id, parent``, names that tell nodes apart: the digest of
    the parent's name and the last turn's key.  ``saved_tokens`` counts, over the subtree, each
    node's text bytes once for every member but one.  ``ends_sha256`` is the digest of the ids of
    the members that end at the node, ascending and joined by commas.

    Conversations without turns are members of the root only.  Equal sequences are counted before
    anything is sorted.  No conversations, no nodes.
    """
    convs = stored(convs.withColumn("name", F.sha2("seq", 256)), "trie-sequences")
    groups = convs.groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv").alias("least"), F.min("seq").alias("seq")
    )
    different = groups.join(_ends(convs.select("name", "conv")), "name")
    weighed = different.select(
        F.lit(0).alias("all"), "seq", "n", "least", "ends_sha256", (F.octet_length("seq") + 64).cast("long").alias("bytes")
    )
    laid = positions(weighed, "all", ["seq"], "trie-different", weight="bytes").withColumn(
        "block", F.expr(f"start div {block_bytes}")
    )
    # A block also gets the row before its first one: the last row of the block before.
    after = F.expr(f"(start + bytes) div {block_bytes}")
    sent = F.array_distinct(F.array(F.col("block"), after))
    shared = laid.withColumn("to", F.explode(sent)).select(
        "to", (F.col("to") == F.col("block")).alias("home"), "start", "seq", "n", "least", "ends_sha256"
    )
    parts = shared.groupBy("to").applyInPandas(_block, _PARTS)
    nodes = stored(
        parts.groupBy("id").agg(
            F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
            F.min("conv_id").alias("conv_id"), F.sum("n_leaves").alias("n_leaves"),
            (F.sum("total") - F.sum("n_convs") * F.max("before") - F.sum("fresh")).alias("saved_tokens"),
            F.max("ends_sha256").alias("ends_sha256"),
        ),
        "trie-nodes",
    )
    kids = nodes.filter("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    full = stored(nodes.join(kids, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-full")
    above = full.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("asked"))
    found = lookup(full.filter("parent is not null"), "parent", above.filter("asked > 0"), "asked").drop("asked")
    root = full.filter("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long"))
    nothing = hashlib.sha256(b"").hexdigest()
    return found.unionByName(root).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(nothing)))
