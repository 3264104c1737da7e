"""Strassen's recursive product of whole-number matrices."""

from __future__ import annotations

import numpy as np

# Blocks with a side of at most so many are multiplied directly.
LEAF = 16


def multiply(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices, by seven products of halves instead of eight.

    A side of odd length is padded with zeros. Only additions, subtractions and products occur,
    all exact modulo 2**64, so the result is right whenever it fits in 64 bits itself, even if a
    sum on the way does not.
    """
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
    if k % 2 or n % 2:
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    out = np.empty((2 * i, 2 * l), np.int64)
    c11, c12, c21, c22 = out[:i, :l], out[:i, l:], out[i:, :l], out[i:, l:]
    p = multiply(a11 + a22, b11 + b22, leaf)
    c11[:], c22[:] = p, p
    p = multiply(a21 + a22, b11, leaf)
    c21[:] = p
    c22 -= p
    p = multiply(a11, b12 - b22, leaf)
    c12[:] = p
    c22 += p
    p = multiply(a22, b21 - b11, leaf)
    c11 += p
    c21 += p
    p = multiply(a11 + a12, b22, leaf)
    c11 -= p
    c12 += p
    c22 += multiply(a21 - a11, b11 + b12, leaf)
    c11 += multiply(a12 - a22, b21 + b22, leaf)
    return out[:m, :n]
