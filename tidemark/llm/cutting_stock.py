"""Cutting stock by column generation, on a histogram of lengths.

The linear program chooses how often to use each pattern (a multiset of length classes that
fits a sequence) so that all classes are covered by few sequences.  Patterns are made when they
are needed: the dual prices of the classes go into a knapsack, whose best filling is the next
pattern.  Everything here is as large as the histogram, whatever the number of documents.
"""

from __future__ import annotations

import numpy as np


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Most valuable filling of ``capacity`` units, by dynamic programming over units."""
    value, chosen = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        value[room], chosen[room] = value[room - 1], -1
        fits = np.searchsorted(sizes, room, side="right")
        if fits:
            options = value[room - sizes[:fits]] + prices[:fits]
            best = int(options.argmax())
            if options[best] > value[room] + 1e-12:
                value[room], chosen[room] = options[best], best
    pattern, room = np.zeros(sizes.size, np.int64), capacity
    while room > 0:
        if chosen[room] < 0:
            room -= 1
        else:
            pattern[chosen[room]] += 1
            room -= sizes[chosen[room]]
    return float(value[capacity]), pattern


def solve(
    sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 2e-4, rounds: int = 4_000
) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often the linear program uses them.

    Revised simplex: every entering column is priced by the knapsack.  Ends when no pattern is
    worth more than a sequence, or the bound of the current prices is within ``gap``.
    ``sizes`` are ascending, ``demand`` positive.
    """
    m = sizes.size
    columns = np.diag(capacity // sizes).astype(float)
    patterns = [row for row in columns.astype(np.int64)]
    held: list[int | None] = list(range(m))  # pattern of each basic column; None: a surplus
    inverse = np.diag(1 / np.diag(columns))
    amount = inverse @ demand
    cost = np.ones(m)
    for turn in range(rounds):
        prices = cost @ inverse
        over = int(prices.argmin())
        if prices[over] < -1e-9:
            entering, price, pattern = -np.eye(m)[over], 0.0, None
        else:
            worth, pattern = best_pattern(np.maximum(prices, 0), sizes, capacity)
            if worth <= 1 + 1e-9 or cost @ amount <= (prices @ demand) / worth * (1 + gap):
                break
            entering, price = pattern.astype(float), 1.0
        change = inverse @ entering
        falls = change > 1e-9
        if not falls.any():
            break
        ratio = np.full(m, np.inf)
        ratio[falls] = amount[falls] / change[falls]
        leaving = int(ratio.argmin())
        step = ratio[leaving]
        amount = np.maximum(amount - step * change, 0)
        amount[leaving] = step
        row = inverse[leaving] / change[leaving]
        inverse = inverse - np.outer(change, row)
        inverse[leaving] = row
        columns[:, leaving], cost[leaving] = entering, price
        held[leaving] = None if pattern is None else len(patterns)
        if pattern is not None:
            patterns.append(pattern)
        if turn % 200 == 199:
            inverse = np.linalg.inv(columns)
            amount = np.maximum(inverse @ demand, 0)
    used = [(patterns[k], x) for k, x in zip(held, amount) if k is not None and x > 1e-9]
    return np.array([p for p, _ in used], np.int64).reshape(-1, m), np.array([x for _, x in used])


def plan(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns ``{size: pieces}`` with whole multiplicities that cover ``counts``.

    The linear program's amounts are rounded down; what is left over, less than one sequence
    for each of its patterns, is packed first-fit, largest sizes first.
    """
    sizes = np.array(sorted(s for s, n in counts.items() if n > 0), np.int64)
    if not sizes.size:
        return []
    demand = np.array([counts[s] for s in sizes.tolist()], np.int64)
    patterns, amounts = solve(sizes, demand.astype(float), capacity)
    out, left = [], demand.copy()
    for pattern, amount in zip(patterns, np.floor(amounts + 1e-6).astype(np.int64)):
        # Never more than what is still asked for of every class in the pattern.
        used = pattern > 0
        times = int(min(amount, (left[used] // pattern[used]).min())) if used.any() else 0
        if times > 0:
            out.append((pattern, times))
            left -= pattern * times
    while left.any():
        room, pattern = capacity, np.zeros(sizes.size, np.int64)
        for i in np.flatnonzero(left)[::-1]:
            take = min(int(left[i]), room // int(sizes[i]))
            pattern[i], room = take, room - take * int(sizes[i])
        used = pattern > 0
        times = int((left[used] // pattern[used]).min())
        out.append((pattern, times))
        left -= pattern * times
    return [({int(s): int(n) for s, n in zip(sizes, p) if n}, t) for p, t in out]
