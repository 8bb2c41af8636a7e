"""Merkle manifest of a dataset by a cogrouped exchange of subtrees.

Leaves get their exact places in their source's tree.  A superblock is a whole subtree of
``ARITY ** HEIGHT`` leaves: one pass reduces each to its top, the tops form the next round's
leaves, and so on up to the subroots and the root.  Back down, each superblock is cogrouped
with the outer nodes its proofs need; one function finishes the local reduction, joins the
proofs and folds them.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ranks import positions
from tidemark.llm.scratch import frame, stored

ARITY, HEIGHT = 16, 3
#: The tree above the subroots.
_TOP = "top"


@dataclass(frozen=True)
class Manifest:
    """Rounds of nodes from the leaves up, of the sources' trees and of the tree over them.

    Each has ``tree, pos, of, block, digest``; the first round of ``sources`` are the leaves with
    ``id, altered``, the first of ``top`` the subroots with ``name``, their source's tree.
    """

    sources: list[DataFrame]
    top: list[DataFrame]
    root: DataFrame
    height: int


def field(value: Column) -> Column:
    """A value as a leaf holds it: ``-`` if null, else its UTF-8 length, a colon and itself."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf(values: list[Column]) -> Column:
    """Digest of a row's values, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def _hash(text: bytes) -> bytes:
    return hashlib.sha256(text).hexdigest().encode()


def levels_above(of: int, most: int) -> int:
    """Levels above ``of`` nodes until one remains, at most ``most``."""
    levels = 0
    while of > 1 and levels < most:
        of, levels = -(-of // ARITY), levels + 1
    return levels


def reduce_levels(digests: list[bytes], height: int) -> list[list[bytes]]:
    """``digests`` and the nodes above them, level by level; hex digests as bytes."""
    levels = [digests]
    for _ in range(height):
        low = levels[-1]
        levels.append([_hash(b"".join(low[i : i + ARITY])) for i in range(0, len(low), ARITY)])
    return levels


def siblings(levels: list[list[bytes]], slot: int) -> tuple[list[bytes], list[bytes]]:
    """Per level below the last, the digests left and right of ``slot``'s ancestor in its run."""
    left, right = [], []
    for level in levels[:-1]:
        start = slot // ARITY * ARITY
        left.append(b"".join(level[start:slot]))
        right.append(b"".join(level[slot + 1 : start + ARITY]))
        slot //= ARITY
    return left, right


def _reducer(height: int):
    def top_of(block: pd.DataFrame) -> pd.DataFrame:
        """The top of one superblock, a leaf of the next round."""
        block = block.sort_values("pos")
        of = int(block["of"].iloc[0])
        top = reduce_levels([d.hex().encode() for d in block["digest"]], levels_above(of, height))[-1][0]
        return frame(
            {
                "tree": [block["tree"].iloc[0]], "pos": [block["block"].iloc[0]], "of": [-(-of // ARITY**height)],
                "digest": [bytes.fromhex(top.decode())],
            }
        )

    return top_of


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {ARITY**height}"))


def _climb(nodes: DataFrame, most: int, height: int, name: str) -> list[DataFrame]:
    """Rounds of nodes, from ``nodes`` to one node for each tree; ``most`` is the largest tree's."""
    rounds = [nodes]
    while most > 1:
        up = rounds[-1].select("tree", "block", "pos", "of", "digest").groupBy("tree", "block")
        tops = up.applyInPandas(_reducer(height), "tree string, pos long, of long, digest binary")
        rounds.append(_blocks(stored(tops, name), height))
        most = -(-most // ARITY**height)
    return rounds


def build(rows: DataFrame, height: int = HEIGHT) -> Manifest | None:
    """The manifest of ``source, id, digest, altered``; None if there are no rows.

    Per source the leaves ascend by id, then digest (null ids first); null sources form one tree,
    before all others.  ``altered`` is the digest that the row has now, or null if unchanged.
    Superblocks are ``height`` levels high.
    """
    named = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree"), "id", "digest", "altered"
    )
    leaves = _blocks(stored(positions(named, "tree", ["id", "digest"], "merkle-sorted"), "merkle-leaves"), height)
    most = leaves.agg(F.max("of")).first()[0]
    if most is None:
        return None
    sources = _climb(leaves, most, height, "merkle-nodes")
    subroots = sources[-1].select(F.lit(_TOP).alias("tree"), F.col("tree").alias("name"), "digest")
    first = _blocks(stored(positions(subroots, "tree", ["name"], "merkle-subroots"), "merkle-top"), height)
    top = _climb(first, first.agg(F.max("of")).first()[0], height, "merkle-top-nodes")
    return Manifest(sources, top, top[-1].select("digest"), height)


_OUTER = "lefts array<binary>, rights array<binary>, subroot binary, root binary"


def _paths(own: pd.DataFrame, outer: pd.DataFrame, height: int):
    """Each node of a superblock, in order, with its siblings up to the root."""
    above, of = outer.iloc[0], int(own["of"].iloc[0])
    levels = reduce_levels([d.hex().encode() for d in own["digest"]], levels_above(of, height))
    lefts, rights = list(above["lefts"]), list(above["rights"])
    for slot in range(len(own)):
        left, right = siblings(levels, slot)
        yield left + lefts, right + rights


def _descender(height: int):
    def descend(own: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        """The outer nodes of each superblock one round below: what is beside each of its tops."""
        own = own.sort_values("pos")
        paths = list(_paths(own, outer, height))
        subroots = own["digest"] if own["tree"].iloc[0] == _TOP else [outer["subroot"].iloc[0]] * len(own)
        return frame(
            {
                "tree": list(own["name"]), "block": list(own["below"]),
                "lefts": [p[0] for p in paths], "rights": [p[1] for p in paths],
                "subroot": list(subroots), "root": [outer["root"].iloc[0]] * len(own),
            }
        )

    return descend


def _lower(nodes: DataFrame, outer: DataFrame, height: int, name: str, below: Column) -> DataFrame:
    own = nodes.select("tree", "block", "pos", "of", "digest", F.col(name).alias("name"), below.alias("below"))
    down = own.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block"))
    return stored(down.applyInPandas(_descender(height), f"tree string, block long, {_OUTER}"), "merkle-outer")


def _prover(height: int, keep: bool):
    def prove(own: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("pos")
        out = {"id": list(own["id"]), "leaf": [d.hex() for d in own["digest"]]}
        root, subroot = (outer[c].iloc[0].hex() for c in ("root", "subroot"))
        proofs, folded, kept = [], [], []
        for (lefts, rights), was, now in zip(_paths(own, outer, height), own["digest"], own["altered"]):
            beside = b"".join(a + b for a, b in zip(lefts, rights))
            proofs.append(hashlib.sha256(beside).hexdigest())
            node = (was if now is None else now).hex().encode()
            for a, b in zip(lefts, rights):
                node = _hash(a + node + b)
            folded.append(node.decode())
            if keep:
                kept.append([[text[i : i + 64].decode() for text in pair for i in range(0, len(text), 64)] for pair in zip(lefts, rights)])
        out |= {"subroot": [subroot] * len(own), "root": [root] * len(own), "proof_sha256": proofs, "folded_root": folded}
        out["verified"] = [f == root for f in folded]
        if keep:
            out["proof"] = kept
        return frame(out)

    return prove


def prove(manifest: Manifest, id_type: str, keep_proofs: bool = False) -> DataFrame:
    """``id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every leaf.

    A proof lists the other digests of each run on the way from the leaf to the root.  The folded
    root is what the proof gives for the row as it is now.  With ``keep_proofs`` the column
    ``proof`` holds the digests themselves, a list for each level.
    """
    height = manifest.height
    outer = manifest.root.select(
        F.lit(_TOP).alias("tree"), F.lit(0).cast("long").alias("block"), F.expr("cast(array() as array<binary>)").alias("lefts"),
        F.expr("cast(array() as array<binary>)").alias("rights"), F.lit(None).cast("binary").alias("subroot"),
        F.col("digest").alias("root"),
    )
    for nodes in reversed(manifest.top[1:]):
        outer = _lower(nodes, outer, height, "tree", F.col("pos"))
    outer = _lower(manifest.top[0], outer, height, "name", F.lit(0).cast("long"))
    for nodes in reversed(manifest.sources[1:]):
        outer = _lower(nodes, outer, height, "tree", F.col("pos"))
    # Ids pass Python as text: whole numbers beside nulls would become floats there.
    leaves = manifest.sources[0].withColumn("id", F.col("id").cast("string"))
    pairs = leaves.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block"))
    proved = pairs.applyInPandas(_prover(height, keep_proofs), proof_schema("string", keep_proofs))
    return proved.withColumn("id", F.col("id").cast(id_type))


def proof_schema(id_type: str, keep_proofs: bool = False) -> str:
    more = ", proof array<array<string>>" if keep_proofs else ""
    return (
        f"id {id_type}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
        f"verified boolean{more}"
    )


def dataset_proofs(
    docs: DataFrame,
    id_col: str,
    source_col: str,
    columns: list[str],
    changed: dict[str, Column],
    when: Column,
    keep_proofs: bool = False,
    height: int = HEIGHT,
) -> DataFrame:
    """Proofs of all rows of ``docs`` against the manifest of ``columns`` as they were.

    ``changed`` gives the present values of some columns where ``when`` holds.  Nulls have a form
    of their own in a leaf, so a null and an empty text differ.  Rows equal in id and all columns
    have equal leaves and take neighbouring places.  An empty table gives no rows.  A text is
    hashed within its row and never moves.
    """
    now = [changed.get(c, F.col(c)) for c in columns]
    rows = docs.select(
        F.col(source_col).alias("source"), F.col(id_col).alias("id"), leaf([F.col(c) for c in columns]).alias("digest"),
        F.when(F.coalesce(when, F.lit(False)), leaf(now)).alias("altered"),
    )
    manifest = build(rows, height)
    kind = docs.schema[id_col].dataType.simpleString()
    if manifest is None:
        return docs.sparkSession.createDataFrame([], proof_schema(kind, keep_proofs))
    return prove(manifest, kind, keep_proofs)
