"""The largest eigenvalues of a symmetric matrix by contour integration, in numpy.

Inertia counts tell how many eigenvalues lie above a number, without finding any. They
cut the wanted part of the spectrum into intervals of few eigenvalues. On a circle
around an interval, a quadrature of complex shifted solves projects a block of vectors
onto the interval's eigenvectors; Rayleigh-Ritz on the block extracts the pairs, and
the count of the interval verifies that none is missed.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

# Points on the upper half of a circle; the lower half follows by symmetry.
NODES = 12

# Eigenvalues are parted as far as they differ by more than this share.
CLOSE = 5e-4

MAX_ROUNDS = 40

_EPS = float(np.finfo(np.float64).eps)

# The growth bound of the pivoting below, (1 + sqrt(17)) / 8.
_PIVOT = (1 + 17**0.5) / 8


class Interval(NamedTuple):
    """low < eigenvalues < high, and how many there are."""

    low: float
    high: float
    count: int


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are larger than ``shift``: the inertia of a pivoted LDL factorisation."""
    a = matrix - shift * np.eye(len(matrix))
    above = 0
    while (n := len(a)) > 1:
        column = np.abs(a[1:, 0])
        r = int(column.argmax()) + 1
        most = column[r - 1]
        if most == 0:
            above += a[0, 0] > 0
            a = a[1:, 1:]
            continue
        size, swap = 1, 0
        if abs(a[0, 0]) < _PIVOT * most:
            other = np.abs(a[r])
            other[r] = 0
            if abs(a[0, 0]) * other.max() >= _PIVOT * most * most:
                pass
            elif abs(a[r, r]) >= _PIVOT * other.max():
                swap = r
            else:
                size = 2
        order = np.arange(n)
        if size == 2:
            order[[1, r]] = order[[r, 1]]
        elif swap:
            order[[0, swap]] = order[[swap, 0]]
        a = a[np.ix_(order, order)]
        if size == 1:
            above += a[0, 0] > 0
            a = a[1:, 1:] - np.outer(a[1:, 0] / a[0, 0], a[0, 1:])
        else:
            above += 1  # such a pivot has one eigenvalue of either sign
            a = a[2:, 2:] - a[2:, :2] @ np.linalg.solve(a[:2, :2], a[:2, 2:])
    return int(above + (n == 1 and a[0, 0] > 0))


def intervals_of_largest(matrix: np.ndarray, k: int) -> list[Interval]:
    """Intervals around the ``k`` largest eigenvalues, falling; fewer if not so many are above rounding.

    Eigenvalues closer than a part in 2,000 share an interval, so that there may be more than
    ``k`` of them in all. Every interval ends halfway to the next eigenvalue outside, or nearer.
    """
    d = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    gap = 8 * d * _EPS * scale
    floor, top = 64 * gap, scale + gap
    wanted = min(k, count_above(matrix, floor)) if scale else 0
    groups: list[Interval] = []
    while not groups or groups[-1].low > floor:
        before = sum(g.count for g in groups)
        # The next one lies between two shifts; those that share its place are counted with it.
        low, high = floor, groups[-1].low if groups else top
        n_low, n_high = count_above(matrix, low), before
        if n_low <= before:
            break
        while high - low > max(8 * gap, high * CLOSE):
            middle = (low + high) / 2 if low > high / 4 else (low * high) ** 0.5
            n = count_above(matrix, middle)
            if n > before:
                low, n_low = middle, n
            else:
                high = middle
        found = Interval(low, high, n_low - n_high)
        if groups and groups[-1].low - high < max(8 * gap, high * CLOSE):
            found = Interval(low, groups[-1].high, found.count + groups.pop().count)
        elif before >= wanted:
            groups.append(found)
            break
        groups.append(found)
    out, total = [], 0
    for i, group in enumerate(groups):
        if total >= wanted:
            break
        total += group.count
        below = groups[i + 1].high if i + 1 < len(groups) else 0.0
        above = groups[i - 1].low if i else np.inf
        margin = min(group.low - below, above - group.high, group.low) / 2
        out.append(Interval(group.low - margin, group.high + margin, group.count))
    return out


def solve_interval(matrix: np.ndarray, part: Interval, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues of an interval, falling, and their vectors as columns.

    An error is raised where the pairs found do not number ``part.count``.
    """
    d = len(matrix)
    size = min(d, 2 * part.count + 4)
    scale = float(np.abs(matrix).sum(axis=1).max())
    centre, radius = (part.low + part.high) / 2, (part.high - part.low) / 2
    angles = np.pi * (np.arange(NODES) + 0.5) / NODES
    steps = radius * np.exp(1j * angles)
    block = np.random.default_rng(seed).standard_normal((d, size))
    eye, least, before = np.eye(d), 4 * d * _EPS * scale, np.inf
    for _ in range(MAX_ROUNDS):
        projected = np.zeros((d, size))
        for step in steps:
            projected += (step * np.linalg.solve((centre + step) * eye - matrix, block)).real
        basis = np.linalg.qr(projected)[0]
        values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ turn
        inside = (values > part.low) & (values < part.high)
        wrong = np.linalg.norm(matrix @ block - block * values, axis=0)
        held = inside & (wrong <= 1e-9 * scale)
        worst = wrong[held].max(initial=0.0)
        # Each round shrinks the residuals, until rounding is all that is left of them.
        if held.sum() == part.count and (worst <= least / 4 or worst > before / 4 and worst <= least * 16):
            order = np.flatnonzero(held)[::-1]
            return values[order], block[:, order]
        before = worst if held.sum() == part.count else np.inf
    raise ArithmeticError(f"{int(held.sum())} of {part.count} eigenvalues found in {part}")
