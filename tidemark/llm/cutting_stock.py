"""Cutting stock by column generation: patterns that pack a histogram of lengths into few equal rolls."""

from __future__ import annotations

import numpy as np

GAP = 5e-4
MAX_PIVOTS = 4000


def _best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the pattern of the greatest total value that fits."""
    worth = np.full(capacity + 1, -1.0)
    item_of = np.zeros(capacity + 1, dtype=np.int64)
    candidates = np.flatnonzero((values > 0) & (sizes <= capacity))
    worth[sizes[candidates]], item_of[sizes[candidates]] = values[candidates], candidates
    usable = np.flatnonzero(worth > 0)
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1, dtype=np.int64)
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        fits = usable[: np.searchsorted(usable, room, side="right")]
        if len(fits):
            totals = worth[fits] + best[room - fits]
            top = int(totals.argmax())
            if totals[top] > best[room] + 1e-12:
                best[room], took[room] = totals[top], item_of[fits[top]]
    pattern = np.zeros(len(sizes), dtype=np.int64)
    room = capacity
    while room > 0:
        if took[room] < 0:
            room -= 1
        else:
            pattern[took[room]] += 1
            room -= int(sizes[took[room]])
    return float(best[capacity]), pattern


def _first_basis(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """A feasible basis: again and again the longest size left, filled up by the knapsack, until a size is used up.

    Each pattern uses up one size and holds none used up before, so that the patterns, in the order of the sizes' ends,
    form a triangular matrix. (patterns, rolls of each, that order).
    """
    m = len(sizes)
    left = demand.astype(float)
    open_sizes = left > 0
    patterns, rolls, order = np.zeros((m, m), dtype=np.int64), np.zeros(m), []
    while open_sizes.any():
        longest = int(np.flatnonzero(open_sizes)[-1])
        _, pattern = _best_pattern(np.where(open_sizes, sizes**1.02, 0), sizes, capacity - int(sizes[longest]))
        pattern[longest] += 1
        held = pattern > 0
        most = np.full(m, np.inf)
        most[held] = left[held] / pattern[held]
        out = int(most.argmin())
        patterns[:, out], rolls[out] = pattern, most[out]
        left = np.maximum(left - most[out] * pattern, 0)
        open_sizes[out] = False
        order.append(out)
    return patterns, rolls, order


def _triangular_inverse(patterns: np.ndarray, order: list[int]) -> np.ndarray:
    """Inverse of the first basis by substitution, a few vector steps per pattern.

    No call of a linear algebra library: its threads would compete with those of the Spark driver.
    """
    inverse = np.eye(len(order))
    for out in order:
        inverse[out] /= patterns[out, out]
        for k in np.flatnonzero(patterns[:, out]):
            if k != out:
                inverse[k] -= patterns[k, out] * inverse[out]
    return inverse


def _fractional(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Linear program by the revised simplex method; priced columns come from the knapsack. (patterns, rolls of each).

    It ends within GAP of the optimum: total rolls divided by the best price bound the optimum from below, and so
    does the total size. MAX_PIVOTS bounds the driver's time; an earlier end costs padding, nothing else.
    """
    patterns, rolls, order = _first_basis(sizes, demand, capacity)
    inverse = _triangular_inverse(patterns, order)
    enough = (1 + GAP) * float((sizes * demand).sum()) / capacity
    for _ in range(MAX_PIVOTS):
        value, pattern = _best_pattern(inverse.sum(axis=0), sizes, capacity)
        if value <= 1 + GAP or rolls.sum() <= enough:
            break
        held = np.flatnonzero(pattern)
        direction = (inverse[:, held] * pattern[held]).sum(axis=1)
        rising = direction > 1e-9
        ratios = np.full(len(sizes), np.inf)
        ratios[rising] = rolls[rising] / direction[rising]
        leave = int(ratios.argmin())
        step = ratios[leave]
        rolls = np.maximum(rolls - step * direction, 0)
        rolls[leave] = step
        row = inverse[leave] / direction[leave]
        inverse -= np.outer(direction, row)
        inverse[leave] = row
        patterns[:, leave] = pattern
    return patterns, rolls


def _first_fit(sizes: np.ndarray, left: np.ndarray, capacity: int) -> list[np.ndarray]:
    """First fit, longest first, for the pieces that whole rolls of the linear program leave over."""
    room: list[int] = []
    patterns: list[np.ndarray] = []
    for k in np.argsort(-sizes, kind="stable"):
        for _ in range(int(left[k])):
            for r, free in enumerate(room):
                if free >= sizes[k]:
                    break
            else:
                r = len(room)
                room.append(capacity)
                patterns.append(np.zeros(len(sizes), dtype=np.int64))
            room[r] -= int(sizes[k])
            patterns[r][k] += 1
    return patterns


def plan_rolls(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(pattern, rolls cut by it) that together hold every piece of the histogram {size: pieces} exactly.

    Work and memory depend on the number of different sizes and on the capacity only, not on the number of pieces.
    Fractional rolls are rounded down; what is left, less than a roll per pattern, is placed first fit.
    """
    if not histogram:
        return []
    if min(histogram) < 1 or max(histogram) > capacity:
        raise ValueError("sizes must lie between 1 and the capacity")
    sizes = np.array(sorted(histogram), dtype=np.int64)
    left = np.array([histogram[int(s)] for s in sizes], dtype=np.int64)
    patterns, rolls = _fractional(sizes, left.astype(float), capacity)
    plan = []
    for pattern, count in zip(patterns.T, np.floor(rolls + 1e-6).astype(np.int64)):
        used = pattern > 0
        whole = int(min(count, (left[used] // pattern[used]).min())) if used.any() else 0
        if whole:
            left -= whole * pattern
            plan.append((pattern, whole))
    plan += [(pattern, 1) for pattern in _first_fit(sizes, left, capacity)]
    return [({int(sizes[k]): int(p[k]) for k in np.flatnonzero(p)}, n) for p, n in plan]
