"""Personal data: exact patterns, and a skip-chain conditional random field over what they leave.

Candidates of a document are the spans the patterns find and further runs of digits and words
with ``@``.  Neighbours in the text form a chain; candidates that repeat each other (the same
digits, the same last digits, the same words, the same network) are also joined by skip edges,
however far apart.  Loopy message passing spreads the labels of sure spans along both kinds of
edges, so a number that is written once in full form is recognised where it is repeated.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import stored

# Kinds in the order in which spans are listed, and the patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_NUMBER = re.compile(r"[0-9](?:[\x20().-]{0,2}[0-9])+")
_AROUND_AT = re.compile(r"[^\x20\x09-\x0D]*")
_BLANK = frozenset("\x20\x09\x0a\x0b\x0c\x0d")
_DIGITS = re.compile(r"[^0-9]+")
_CELLS = 4096
_LABELS = len(KINDS) + 1  # label 0: not personal

Span = tuple[int, int, int]  # kind, start, end


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@`` outwards so that long words cost no more."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if place % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the exact patterns, by kind and start."""
    out = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) < 3 or (len(p) == 3 and p <= "255") for p in parts):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _DIGITS.sub("", m.group())
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGITS.sub("", m.group())) <= 15:
                out.append((3, m.start(), m.end()))
    return out


@dataclass
class Node:
    start: int
    end: int
    label: int  # sure label, or 0
    keys: list[tuple[str, str]]  # what it shares with nodes it repeats
    cells: list[int]  # hashed features


def _cell(*parts: object) -> int:
    return zlib.crc32("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass")) % _CELLS


def _word_before(text: str, at: int) -> str:
    part = text[max(0, at - 24) : at].split()
    return part[-1].lower() if part else ""


def nodes(text: str, base: list[Span]) -> list[Node]:
    """Candidates in text order: base spans, and runs that overlap none of them."""
    spans = [(a, b, kind + 1) for kind, a, b in base]
    taken = sorted((a, b) for a, b, _ in spans)
    more = [(m.start(), m.end()) for m in _NUMBER.finditer(text) if m.end() - m.start() >= 7]
    at = text.find("@")
    while at >= 0:
        start = at
        floor = more[-1][1] if more and more[-1][1] <= at else 0
        while start > floor and text[start - 1] not in _BLANK:
            start -= 1
        end = _AROUND_AT.match(text, at).end()
        more.append((start, end))
        at = text.find("@", end)
    place, out = 0, []
    for a, b in sorted(set(more)):
        while place < len(taken) and taken[place][1] <= a:
            place += 1
        if place == len(taken) or taken[place][0] >= b:
            if "@" in text[a:b] or len(_DIGITS.sub("", text[a:b])) >= 7:
                spans.append((a, b, 0))
    for a, b, label in sorted(spans):
        said = text[a:b]
        form, digits = _form(said)
        keys = [("as", said.lower().strip(".,;:"))]
        if form == "dotted":
            keys.append(("net", said.rpartition(".")[0]))
        elif form == "number" and len(digits) >= 7:
            keys += [("digits", digits), ("last", digits[-9:])]
        out.append(Node(a, b, label, keys, _features(said, _word_before(text, a), text[a - 1 : a] == "+")))
    return out


def _form(said: str) -> tuple[str, str]:
    digits = _DIGITS.sub("", said)
    if "@" in said:
        return "at", digits
    return ("dotted" if said.count(".") == 3 and len(digits) <= 12 and " " not in said else "number"), digits


def _features(said: str, before: str, plus: bool) -> list[int]:
    form, digits = _form(said)
    marks = "".join(sorted({c for c in said if not c.isalnum()} - {"+"}))
    return [
        _cell("bias"), _cell("form", form), _cell("size", form, min(len(digits), 20)), _cell("marks", form, marks),
        _cell("before", before), _cell("sign", form, plus or said[:1] == "+"),
    ]


@dataclass(frozen=True)
class Field:
    """Weights of the random field: features x labels, chain transitions, and the skip bond."""

    unary: np.ndarray
    chain: np.ndarray
    bond: float


#: What the bond is drawn to where the data say little, and how strongly (a Gaussian prior).
BOND_PRIOR, BOND_SPREAD = 6.0, 2.0


def examples(text: str, draw: int) -> Iterator[tuple[int, list[int], int, int, list[int]]]:
    """Training nodes of a text: ``label, cells, label before, label after, labels of repeats``.

    Labels are known for sure spans, and for candidates that repeat no sure span: those are not
    personal.  Candidates that do repeat one are what is to be found, so they are no example for
    either.  In their place sure spans are hidden: about half of them, by ``draw``, come once more as
    a bare repeat (without their sign) that only its bond to the sure span gives away.
    ``labels of repeats`` counts, by label, the nodes joined to it; -1 stands for an unknown label.
    """
    own = nodes(text, base_spans(text))
    sure = {key for n in own if n.label for key in n.keys}
    known = [n.label if n.label or not any(k in sure for k in n.keys) else -1 for n in own]
    near: list[set[int]] = [set() for _ in own]
    for a, b in {*_skips([own]), *_anchors([own])}:
        near[a].add(b)
        near[b].add(a)
    for i, n in enumerate(own):
        if known[i] < 0:
            continue
        before, after = (known[i - 1] if i else -1), (known[i + 1] if i + 1 < len(own) else -1)
        repeats = [0] * _LABELS
        for j in near[i]:
            if known[j] >= 0:
                repeats[known[j]] += 1
        yield known[i], n.cells, before, after, repeats
        said = text[n.start : n.end]
        if n.label and zlib.crc32(f"{draw}:{i}".encode()) % 2:
            repeats = list(repeats)
            repeats[n.label] += 1
            yield n.label, _features(said.lstrip("+"), _word_before(text, n.start), False), -1, -1, repeats


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = 20_000, sample_nodes: int = 60_000
) -> Field:
    """Learn all potentials together from the labels that the patterns give (``examples``).

    About ``sample_docs`` documents with the smallest id hashes are read, and of their training nodes
    about ``sample_nodes``, drawn by hash.  The pseudo-likelihood, each node's label given its
    features and the labels around it, is climbed in the unary weights, the chain weights and the
    bond at once, under Gaussian priors; the bond's is around ``BOND_PRIOR``, as repeats may be rare.
    With nothing to learn from, only the priors remain.  Null texts are left out; long texts are read
    whole; repeated rows count again.
    """
    total = docs.count()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(
        F.col("text").isNotNull()
        & (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / F.lit(float(1 << 40)) < sample_docs / max(total, 1))
    ).select("text", F.xxhash64(F.lit(5), "id").alias("draw"))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, draws = [], []
            for text, draw in zip(batch.column("text").to_pylist(), batch.column("draw").to_pylist()):
                own = list(examples(text, draw))
                found += own
                draws += [zlib.crc32(f"{draw}/{i}".encode()) for i in range(len(own))]
            label, cells, before, after, repeats = zip(*found) if found else ([], [], [], [], [])
            yield pa.RecordBatch.from_pydict(
                {"draw": draws, "label": label, "cells": cells, "before": before, "after": after, "repeats": repeats},
                schema=pa.schema(
                    [("draw", pa.int64()), ("label", pa.int32()), ("cells", pa.list_(pa.int32())), ("before", pa.int32()), ("after", pa.int32()), ("repeats", pa.list_(pa.int32()))]
                ),
            )

    found = stored(
        rows.mapInArrow(collect, "draw bigint, label int, cells array<int>, before int, after int, repeats array<int>"),
        "pii-examples",
    )
    share = sample_nodes / max(found.count(), 1)
    table = found.filter(F.col("draw") < share * (1 << 32)).drop("draw").toArrow()
    label = table["label"].to_numpy()
    if not label.size:
        return Field(np.zeros((_CELLS, _LABELS)), np.zeros((_LABELS, _LABELS)), BOND_PRIOR)
    cells, repeats = (np.array(table[c].to_pylist()) for c in ("cells", "repeats"))
    return fit(label, cells, table["before"].to_numpy(), table["after"].to_numpy(), repeats)


def fit(
    label: np.ndarray, cells: np.ndarray, before: np.ndarray, after: np.ndarray, repeats: np.ndarray, rounds: int = 120
) -> Field:
    """The field of highest penalised pseudo-likelihood: scaled gradient steps in the weights, Newton
    steps in the bond."""
    truth, n = np.eye(_LABELS)[label], label.size
    unary, chain, bond = np.zeros((_CELLS, _LABELS)), np.zeros((_LABELS, _LABELS)), BOND_PRIOR
    has_before, has_after = before >= 0, after >= 0
    pace_unary, pace_chain = np.full_like(unary, 1e-6), np.full_like(chain, 1e-6)
    for _ in range(rounds):
        score = unary[cells].sum(axis=1) + bond * repeats
        score[has_before] += chain[before[has_before]]
        score[has_after] += chain.T[after[has_after]]
        p = _softmax(score)
        error = (p - truth) / n
        slope = 1e-2 * unary / n
        for j in range(cells.shape[1]):
            np.add.at(slope, cells[:, j], error)
        turn = chain / n
        np.add.at(turn, before[has_before], error[has_before])
        np.add.at(turn.T, after[has_after], error[has_after])
        pull = float((error * repeats).sum()) + (bond - BOND_PRIOR) / BOND_SPREAD**2 / n
        mean = (p * repeats).sum(axis=1)
        curve = float(((p * repeats**2).sum(axis=1) - mean**2).sum() + 1 / BOND_SPREAD**2) / n
        pace_unary += slope**2
        pace_chain += turn**2
        unary -= 0.3 * slope / np.sqrt(pace_unary)
        chain -= 0.1 * turn / np.sqrt(pace_chain)
        bond -= float(np.clip(0.5 * pull / curve, -0.5, 0.5))
    return Field(unary, chain, max(float(bond), 0.0))


def _skips(docs: list[list[Node]]) -> list[tuple[int, int]]:
    """Edges from each candidate to the last one before it with the same key, in one numbering."""
    out, at = set(), 0
    for own in docs:
        last: dict[tuple[str, str], int] = {}
        for i, n in enumerate(own):
            for key in n.keys:
                if key in last:
                    out.add((at + last[key], at + i))
                last[key] = i
        at += len(own)
    return sorted(out)


def _anchors(docs: list[list[Node]]) -> list[tuple[int, int]]:
    """Edges between each candidate and the nearest sure span with the same key, before or after it."""
    out, at = set(), 0
    for own in docs:
        sure: dict[tuple[str, str], list[int]] = {}
        for i, n in enumerate(own):
            if n.label:
                for key in n.keys:
                    sure.setdefault(key, []).append(i)
        for i, n in enumerate(own):
            for key in n.keys if not n.label else ():
                if key in sure:
                    place = bisect.bisect(sure[key], i)
                    near = min(sure[key][max(0, place - 1) : place + 1], key=lambda s: abs(s - i))
                    out.add((at + min(near, i), at + max(near, i)))
        at += len(own)
    return sorted(out)


def posteriors(field: Field, docs: list[list[Node]], rounds: int = 1_000) -> np.ndarray:
    """Label probabilities of all candidates of several documents, by loopy message passing.

    The documents are one graph without edges between them, so each round is a few array
    operations.  Sure labels are fixed, and each candidate is joined to the nearest sure span it
    repeats, so none is farther from it than one step.  A document is passed on until its own
    messages have settled; one that swings is damped more with time.  Documents that still swing
    after ``rounds`` rounds are finished by mean-field steps, which always settle.
    """
    flat = [n for own in docs for n in own]
    if not flat:
        return np.zeros((0, _LABELS))
    score = field.unary[np.array([n.cells for n in flat])].sum(axis=1)
    sure = np.array([n.label for n in flat])
    fixed = sure > 0
    score[fixed] = -60.0
    score[fixed, sure[fixed]] = 0.0
    pairs, weights, at = [], [], 0
    bond = field.bond * np.eye(_LABELS)
    for own in docs:
        pairs += [(at + i - 1, at + i) for i in range(1, len(own))]
        at += len(own)
    weights += [field.chain] * len(pairs)
    skips = sorted({*_skips(docs), *_anchors(docs)})
    pairs += skips
    weights += [bond] * len(skips)
    if not pairs:
        return _softmax(score)
    a, b = np.array(pairs).T
    w = np.array(weights)
    # Messages along each edge in both directions; into[k] is where message k arrives.
    out_of, into = np.concatenate([a, b]), np.concatenate([b, a])
    table = np.concatenate([w, w.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(a.size) + a.size, np.arange(a.size)])
    message = np.zeros((into.size, _LABELS))
    doc = np.repeat(np.arange(len(docs)), [len(own) for own in docs])[into]
    live = np.arange(into.size)  # messages of documents that have not settled
    place = np.empty(into.size, np.int64)
    for done in range(rounds):
        place[live] = np.arange(live.size)
        own = message[live]
        belief = score.copy()
        np.add.at(belief, into[live], own)
        belief = belief[out_of[live]] - own[place[back[live]]]
        held = fixed[out_of[live]]  # nothing that arrives changes a sure label, however much it is
        belief[held] = score[out_of[live][held]]
        sent = belief[:, :, None] + table[live]
        top = sent.max(axis=1)
        fresh = top + np.log(np.exp(sent - top[:, None, :]).sum(axis=1))
        fresh -= fresh.max(axis=1, keepdims=True)
        moved = np.zeros(len(docs))
        np.maximum.at(moved, doc[live], np.abs(fresh - own).max(axis=1))
        pace = 0.5 * 0.8 ** (done // 100)
        message[live] = (1 - pace) * own + pace * fresh
        live = live[moved[doc[live]] >= 1e-3]
        if not live.size:
            break
    belief = score.copy()
    np.add.at(belief, into, message)
    belief[fixed] = score[fixed]
    p = _softmax(belief)
    if live.size:
        _mean_field(p, score, fixed, np.unique(into[live]), out_of, into, table)
    return p


def _mean_field(
    p: np.ndarray, score: np.ndarray, fixed: np.ndarray, open_: np.ndarray, out_of: np.ndarray, into: np.ndarray, table: np.ndarray
) -> None:
    """Coordinate ascent on the nodes ``open_``, one after another, from the probabilities ``p``.

    Each step raises the same bound, so the steps settle whatever the loops.
    """
    edges: dict[int, list[int]] = {int(i): [] for i in open_}
    for k, i in enumerate(into.tolist()):
        if i in edges:
            edges[i].append(k)
    moved = 1.0
    while moved >= 1e-4:
        moved = 0.0
        for i, own in edges.items():
            if fixed[i]:
                continue
            fresh = _softmax((score[i] + sum(p[out_of[k]] @ table[k] for k in own))[None, :])[0]
            moved = max(moved, float(np.abs(fresh - p[i]).max()))
            p[i] = fresh


def _softmax(score: np.ndarray) -> np.ndarray:
    p = np.exp(score - score.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def all_spans(field: Field, texts: list[str], least: float = 0.9) -> list[tuple[list[Span], list[Span]]]:
    """For each text its base spans, and all spans: those and the candidates the field labels."""
    bases = [base_spans(t) for t in texts]
    own = [nodes(t, base) for t, base in zip(texts, bases)]
    # Without a sure span and a further candidate there is nothing to spread or to decide.
    open_ = [i for i, n in enumerate(own) if any(x.label == 0 for x in n)]
    p, at = posteriors(field, [own[i] for i in open_]), 0
    out = [(base, base) for base in bases]
    for i in open_:
        mine = p[at : at + len(own[i])]
        at += len(own[i])
        added = [
            (int(q.argmax()) - 1, n.start, n.end)
            for n, q in zip(own[i], mine)
            if n.label == 0 and q.argmax() > 0 and q.max() >= least
        ]
        if added:
            out[i] = bases[i], sorted(bases[i] + added)
    return out


def find(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``id_col``, ``n_email, n_ip, n_card, n_phone`` and ``base_sha256`` of the
    base spans, and ``spans``, all spans as ``kind:start:end`` (code points, end exclusive),
    comma-joined by kind and start.

    A null text is empty: no spans.  Base spans always stay; the field only adds spans that
    overlap none of them.  Repeated rows get equal results; of labels with equal posteriors the
    first counts.  Texts are read whole, however long.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(field)
    listed = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = all_spans(sent.value, [t or "" for t in batch.column("text").to_pylist()])
            counts = [[sum(s[0] == k for s in base) for base, _ in found] for k in range(len(KINDS))]
            digests = [hashlib.sha256(listed(base).encode()).hexdigest() for base, _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
                    pa.array([listed(spans) for _, spans in found], pa.string()),
                ],
                ["id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    counted = ", ".join(f"n_{k} bigint" for k in KINDS)
    out = rows.mapInArrow(run, f"id {kind}, {counted}, base_sha256 string, spans string")
    return out.withColumnRenamed("id", id_col)
