"""Vectorised hashing of words and characters over whole batches of texts.

A batch of texts is laid out as one array, and every word or n-gram is hashed by array
arithmetic: there is no Python loop over words.  Word hashes are differences of a running
polynomial sum modulo 2**64, so each byte is touched a fixed number of times however long
a text is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_ROOT = 0x9E3779B97F4A7C15 | 1
_UNROOT = pow(_ROOT, -1, 1 << 64)
_SEEDS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)

SPACE, WORD, MARK = 0, 1, 2
_KIND = np.full(256, MARK, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = SPACE
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _KIND[_low : _high + 1] = WORD
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_powers = np.ones((2, 1), np.uint64)


def _power_table(n: int) -> np.ndarray:
    """Powers 0..n of the root and of its inverse modulo 2**64."""
    global _powers
    if _powers.shape[1] <= n:
        size = max(n + 1, 1 << 16)
        fresh = np.empty((2, size), np.uint64)
        for row, base in zip(fresh, (_ROOT, _UNROOT)):
            row[0] = 1
            row[1:] = np.uint64(base)
            np.multiply.accumulate(row, out=row)
        if size > 1 << 23:  # one very long text: not worth keeping
            return fresh
        _powers = fresh
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers evenly over all bits."""
    x = (x ^ (x >> np.uint64(32))) * _SEEDS[0]
    x = (x ^ (x >> np.uint64(29))) * _SEEDS[1]
    return x ^ (x >> np.uint64(32))


def batches(texts: list[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``limit`` bytes each; one longer text is a range of its own."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


class Tokens:
    """Words and runs of marks of several UTF-8 texts.

    ``hashes`` holds a hash of each token with A-Z in lower case, ``doc`` the index of its
    text, ``shape`` a small number: the kind of token, capitals and length class.
    """

    def __init__(self, texts: list[bytes]):
        # A space between texts ends the last token of each.
        raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.doc_ends = np.cumsum(lengths)
        kind = _KIND[raw]
        edge = np.flatnonzero(np.diff(kind, prepend=np.uint8(SPACE)))
        begins = edge[kind[edge] != SPACE]
        stops = np.append(edge[1:], raw.size)[kind[edge] != SPACE]
        powers = _power_table(raw.size)
        total = np.zeros(raw.size + 1, np.uint64)
        np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * powers[0, : raw.size], out=total[1:])
        self.hashes = mix((total[stops] - total[begins]) * powers[1, begins])
        self.doc = np.searchsorted(self.doc_ends, begins, side="right")
        caps = np.zeros(raw.size + 1, np.int32)
        np.cumsum((raw >= 0x41) & (raw <= 0x5A), out=caps[1:])
        n_caps, size = caps[stops] - caps[begins], stops - begins
        self.shape = (
            kind[begins].astype(np.int64) * 32
            + np.where(n_caps == 0, 0, np.where(n_caps == 1, 1, np.where(n_caps * 2 >= size, 3, 2))) * 8
            + np.minimum(np.frexp(size.astype(np.float32))[1], 7)
        )


def char_cells(texts: list[str], orders: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash cells of all character n-grams of ``orders``, and where each text starts.

    Returns an array (positions, orders) of cells below ``2**bits``.  Every text, empty ones
    too, is followed by as many zero characters as the longest order; what starts at a zero
    character is cell 0, so no n-gram joins two texts and every text has at least one position.
    """
    pad = "\0" * max(orders)
    codes = np.frombuffer((pad.join(texts) + pad).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + len(pad)
    starts = np.cumsum(lengths) - lengths
    room = np.concatenate([codes, np.zeros(len(pad), np.uint32)]).astype(np.uint64)
    n, out = codes.size, np.empty((codes.size, len(orders)), np.uint32)
    running, made = np.zeros(n, np.uint64), 0
    for place, order in enumerate(orders):
        while made < order:
            running = running * _SEEDS[2] + room[made : made + n] + np.uint64(1)
            made += 1
        out[:, place] = ((running * _SEEDS[0] + np.uint64(order)) * _SEEDS[1]) >> np.uint64(64 - bits)
    out[codes == 0] = 0
    return out, starts
