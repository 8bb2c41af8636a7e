import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import trie
from tidemark.llm.queries import remainder

SCHEMA = "conv_id long, turn long, role string, text string, id long, parent long, key string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def truncated(c):
    return c - (abs(c) % 5) * (1 if c >= 0 else -1)


def brute(rows, rebuild=True):
    """Nodes of the trie of ``(conv, turn, role, text)``, by plain prefixes."""
    own = {}
    for c, turn, role, text in rows:
        role, text = role or "", text or ""
        if c is not None:
            key = sha(f"{len(role.encode())}:{role}{text}")
            own.setdefault(c, []).append(((turn is not None, turn or 0, key), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    whole = own
    if rebuild:
        whole = {}
        for c, turns in own.items():
            h = zlib.crc32(str(c).encode()) % 9
            whole[c] = own.get(truncated(c), [])[:h] + turns[h:]
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, convs in members.items():
        size = (len(convs) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += size
    out = []
    for p, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(p))
        out.append((min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), kids.get(p, 0), leaves[p], saved[p], sha(ends)))
    return sorted(out, key=repr)


def nodes(spark, rows, rebuild=True, **more):
    df = spark.createDataFrame([(*r, 1, 2, "k") for r in rows], SCHEMA).repartition(3)
    out = trie.trie(trie.sequences(df, head=remainder("conv", 9) if rebuild else None), **more)
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in out.select(*cols).collect()), key=repr)


EDGE = [
    (1, 0, "user", "a"), (1, 1, None, None), (2, None, "user", "first"), (2, 0, "user", "a"), (2, 0, "user", "a"),
    (3, 0, "user", "a"), (3, 1, "", ""), (None, 0, "user", "lost"), (10, 5, "user", "ü" * 5000), (10, 5, "bot", "ü"),
    (-7, 0, "user", "a"), (-5, 0, "user", "b"), (-5, 1, "bot", "c"), (0, 0, "user", "z"), (4, 3, "user", "own"),
    (-4, 3, "user", "own"), (5, 0, "user", "a"), (7, 0, "use", "ra"),
]


def test_edge_rows(spark):
    assert nodes(spark, EDGE) == brute(EDGE)
    assert nodes(spark, EDGE, rebuild=False) == brute(EDGE, rebuild=False)
    assert nodes(spark, []) == []
    assert nodes(spark, [(None, 0, "user", "x")]) == []


def test_only_conversations_without_turns(spark):
    """Conversations whose base is absent and whose own turns all go: the root is the only node."""
    some = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1][:4]
    rows = [(c, 0, "user", "x") for c in some]
    got = nodes(spark, rows)
    assert got == brute(rows) and len(got) == 1 and got[0][3:7] == (4, 0, 1, 0)


@pytest.mark.parametrize("block", [200, 1000, 1 << 18])
def test_random_conversations(spark, block):
    """Shared first turns, copies, repeated and missing turns; also with runs over many blocks."""
    draw = random.Random(block)
    rows = []
    for c in range(-30, 120):
        for turn in range(draw.randint(1, 9)):
            text = "hello" if turn == 0 and draw.random() < 0.7 else draw.choice(["x", "yy", "é", None, ""])
            rows.append((c, None if draw.random() < 0.05 else turn, draw.choice(["user", "bot"]) if turn else "user", text))
    copies = [(1000 + i, t, "user", f"copy {t}") for i in range(60) for t in range(4)]
    assert nodes(spark, rows + copies, block_bytes=block) == brute(rows + copies)
    assert nodes(spark, rows + copies, rebuild=False, block_bytes=block) == brute(rows + copies, rebuild=False)


def test_long_conversation(spark):
    """Twelve thousand turns in one conversation, more than a segment; a shorter copy beside it."""
    df = spark.range(20_000).selectExpr(
        "if(id < 12000, 5, 6) as conv_id", "if(id < 12000, id, id - 12000) as turn", "'user' as role",
        "cast(if(id < 12000, id, id - 12000) as string) as text",
    )
    out = {r["depth"]: r for r in trie.trie(trie.sequences(df)).collect()}
    assert len(out) == 12_001 and all(r["n_convs"] == (2 if d <= 8000 else 1) for d, r in out.items())
    assert out[8000]["ends_sha256"] == sha("6") and out[12_000]["ends_sha256"] == sha("5") and out[0]["n_leaves"] == 1
    assert out[0]["saved_tokens"] == sum(len(str(i)) for i in range(8000))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=40), st.integers(0, 39), st.integers(0, 6))
def test_extents_by_plain_scan(common, at, depth):
    at %= len(common)
    left = right = at
    while left > 0 and common[left] >= depth:
        left -= 1
    while right + 1 < len(common) and common[right + 1] >= depth:
        right += 1
    got = trie.extents(np.array(common), np.array([at]), np.array([depth]))
    assert (got[0][0], got[1][0]) == (left, right)


def test_sparse_table():
    values = np.array([5, 3, 8, 1, 9, 2, 7])
    for k, low in enumerate(trie.sparse_table(values)):
        assert list(low) == [min(values[i : i + (1 << k)]) for i in range(values.size - (1 << k) + 1)]
