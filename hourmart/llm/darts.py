"""Weighted MinHash signatures by throwing darts.

Each element of a set stands for a region as wide as its weight. Darts fall on the plane
of weight and rank as a fixed random rain, made by hashing the element and a cell of its
region, so equal elements of two sets are hit by the same darts. A dart is dealt to one of
k coordinates; a coordinate keeps the dart of least rank within the regions of the set. Two
sets agree in a coordinate with the probability of their weighted Jaccard likeness.

About k ln k + 2k darts fill all coordinates, however large the set: ranks are opened cell by
cell, each as high as all before it, until the set has that many and no coordinate is empty.
"""

from __future__ import annotations

from math import exp, log

import numpy as np

from hourmart.llm.common import mix

_CELL = np.uint64(0xD1B54A32D192ED03)
_CELL_STEP = 0xD1B54A32D192ED03
_UNIT = np.uint64(0x8CB92BA72F3D8DD7)
_DART = np.uint64(0xABC98388FB8FAC03)
# Height of the lowest cell of ranks: sets of thousands of elements need no more.
LOWEST = 1 / 8


def rain(mean: float) -> np.ndarray:
    """Cumulated Poisson probabilities of 0, 1, ... darts in a cell of this area."""
    n = int(mean + 12 * mean**0.5 + 12)
    logs = np.arange(n) * log(mean) - mean
    logs -= np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n)))])
    return np.minimum(np.cumsum(np.exp(logs)), 1.0) if mean < 700 else np.cumsum(np.exp(logs))


def signatures(
    elements: np.ndarray, starts: np.ndarray, k: int, weights: np.ndarray | None = None
) -> np.ndarray:
    """(sets, k) least darts; ``starts`` says where each set begins in ``elements`` (64-bit hashes).

    Without weights each element weighs 1, repeated ones once. The largest 64-bit value is in all
    coordinates of a set without elements.
    """
    sets = len(starts) - 1
    sizes = np.diff(starts)
    owner = np.repeat(np.arange(sizes.size), sizes)
    if weights is None:
        total = sizes.astype(float)
        unit, width = np.zeros(len(elements), np.int64), None
    else:
        cells = np.ceil(weights).astype(np.int64)
        total = np.bincount(owner, weights, sets)
        at = np.repeat(np.arange(len(elements)), cells)
        unit = np.arange(len(at)) - np.repeat(np.cumsum(cells) - cells, cells)
        width = np.minimum(weights[at] - unit, 1.0)
        elements, owner = elements[at], owner[at]
    least = np.full(sets * k, np.iinfo(np.uint64).max, np.uint64)
    wanted = (k * log(k) + 2 * k) / np.maximum(total, 1e-9)
    open_ = total > 0
    cell, top = 0, LOWEST
    while open_.any():
        area = LOWEST if cell == 0 else top / 2
        mine = open_[owner] if not open_.all() else slice(None)
        own, own_unit, of = elements[mine], unit[mine], owner[mine]
        seed = mix(own + own_unit.astype(np.uint64) * _UNIT + np.uint64((cell + 1) * _CELL_STEP % 2**64))
        chance = (seed >> np.uint64(11)) * 2.0**-53
        if area < 1:
            # Most cells are empty; only the others are looked up.
            hit = np.flatnonzero(chance >= exp(-area))
            darts = np.searchsorted(rain(area), chance[hit], side="right")
        else:
            hit = np.arange(len(own))
            darts = np.searchsorted(rain(area), chance, side="right")
        at = np.repeat(hit, darts)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(darts) - darts, darts)
        dart = mix(seed[at] + (nth.astype(np.uint64) + np.uint64(1)) * _DART)
        if width is not None:
            kept = (mix(dart ^ _UNIT) >> np.uint64(11)) * 2.0**-53 < width[mine][at]
            at, dart = at[kept], dart[kept]
        rank = (np.uint64(cell) << np.uint64(58)) | (mix(dart ^ _CELL) >> np.uint64(6))
        np.minimum.at(least, of[at] * k + (dart % np.uint64(k)).astype(np.int64), rank)
        empty = (least.reshape(sets, k) == np.iinfo(np.uint64).max).any(axis=1)
        open_ = (total > 0) & ((wanted > top) | empty)
        cell, top = cell + 1, top * 2
    return least.reshape(sets, k)


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """(sets, bands) hashes of the bands of each signature; the band's number is part of it."""
    rows = signature.reshape(len(signature), bands, -1)
    key = np.broadcast_to(mix(np.arange(bands, dtype=np.uint64) + np.uint64(1)), rows.shape[:2])
    for r in range(rows.shape[2]):
        key = mix(key + rows[:, :, r])
    return key
