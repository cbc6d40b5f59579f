"""SuperMinHash signatures of many sets at once."""

from __future__ import annotations

import numpy as np

from tidemark.llm.words import mix

EMPTY = np.uint64(2**64 - 1)
_ROUND_SHIFT = np.uint64(48)
_BLOCK = 40_000


def _draw(elements: np.ndarray, number: int) -> np.ndarray:
    return mix(elements + np.uint64((2 * number + 1) * 0xD1342543DE82EF95 % 2**64))


def signatures(sets: list[np.ndarray], size: int) -> np.ndarray:
    """A row of `size` ranks per set; an empty set keeps EMPTY in all places.

    Each element walks through a random permutation of the places (Fisher-Yates, seeded by the element) and offers in
    step j a random value of [j, j + 1) to the j-th place of its permutation; a place keeps the least offer. The ranks
    of one element in different places are thus correlated, which lowers the variance against independent hashes.
    A set stops early: once all its places are filled, a later step can't improve any of them. Step j is held in the
    upper 16 bits of a rank and the random fraction in the lower 48.
    """
    out = np.full((len(sets), size), EMPTY, dtype=np.uint64)
    at = 0
    while at < len(sets):
        stop, total = at, 0
        while stop < len(sets) and (stop == at or total + len(sets[stop]) <= _BLOCK):
            total += len(sets[stop])
            stop += 1
        _fill(out[at:stop], sets[at:stop])
        at = stop
    return out


def _fill(out: np.ndarray, sets: list[np.ndarray]) -> None:
    size = out.shape[1]
    lengths = np.array([len(s) for s in sets])
    if not lengths.sum():
        return
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), lengths)
    flat = out.reshape(-1)
    swap = (_draw(elements, 0) % np.uint64(size)).astype(np.int64)
    np.minimum.at(flat, owner * size + swap, _draw(elements, 1) >> np.uint64(16))
    open_sets = (out == EMPTY).any(axis=1)
    keep = open_sets[owner]
    elements, owner, swap = elements[keep], owner[keep], swap[keep]
    order = np.tile(np.arange(size, dtype=np.int16), (len(elements), 1))
    rows = np.arange(len(elements))
    order[rows, swap] = 0
    for step in range(1, size):
        if not len(elements):
            return
        pick = step + (_draw(elements, 2 * step) % np.uint64(size - step)).astype(np.int64)
        place = order[rows, pick]
        order[rows, pick] = order[:, step]
        value = (_draw(elements, 2 * step + 1) >> np.uint64(16)) | (np.uint64(step) << _ROUND_SHIFT)
        np.minimum.at(flat, owner * size + place, value)
        keep = (out == EMPTY).any(axis=1)[owner]
        if not keep.all():
            elements, owner, order = elements[keep], owner[keep], order[keep]
            rows = np.arange(len(elements))


def band_keys(ranks: np.ndarray, rows_per_band: int) -> np.ndarray:
    """A hash per band of `rows_per_band` ranks; the band's number is part of it."""
    bands = ranks.shape[1] // rows_per_band
    parts = ranks[:, : bands * rows_per_band].reshape(len(ranks), bands, rows_per_band)
    total = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * np.uint64(0xA0761D6478BD642F)
    for k in range(rows_per_band):
        total = mix(total + parts[:, :, k])
    return total.view(np.int64)
