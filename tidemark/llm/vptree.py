"""Vantage-point partitioning of binary fingerprints: all pairs within a Hamming radius.

A set is split at the median distance mu from a vantage point v. By the triangle inequality a pair of points on either
side lies within the radius only if the inner one is at least mu - radius and the outer one at most mu + radius away
from v, so besides the two halves just those boundary shells are joined, by the same rule again. Where the shells are
no smaller than the halves (distances concentrate and the bound can't prune), the rest is compared block by block.
"""

from __future__ import annotations

import numpy as np

LEAF = 48
BLOCK = 1024


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Hamming distances of broadcastable arrays of uint64 words."""
    return np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64)


def _brute_cross(fp: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int, out: list) -> None:
    for lo in range(0, len(a), BLOCK):
        part = a[lo : lo + BLOCK]
        for at in range(0, len(b), BLOCK):
            other = b[at : at + BLOCK]
            i, j = np.nonzero(distances(fp[part][:, None, :], fp[other][None, :, :]) <= radius)
            if len(i):
                out.append((part[i], other[j]))


def _brute_self(fp: np.ndarray, a: np.ndarray, radius: int, out: list) -> None:
    for lo in range(0, len(a), BLOCK):
        part = a[lo : lo + BLOCK]
        i, j = np.triu_indices(len(part), 1)
        near = distances(fp[part[i]], fp[part[j]]) <= radius
        if near.any():
            out.append((part[i[near]], part[j[near]]))
        _brute_cross(fp, part, a[lo + BLOCK :], radius, out)


def _cross(fp: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int, out: list) -> None:
    stack = [(a, b)]
    while stack:
        a, b = stack.pop()
        if not len(a) or not len(b):
            continue
        if len(a) * len(b) <= LEAF * LEAF:
            _brute_cross(fp, a, b, radius, out)
            continue
        v = fp[(a if len(a) >= len(b) else b)[0]]
        da, db = distances(fp[a], v), distances(fp[b], v)
        mu = int(np.median(np.concatenate((da, db))))
        ai, bi = da <= mu, db <= mu
        shells = [(a[ai], b[bi]), (a[~ai], b[~bi]), (a[ai & (da >= mu - radius)], b[~bi & (db <= mu + radius)]), (a[~ai & (da <= mu + radius)], b[bi & (db >= mu - radius)])]
        if sum(len(x) * len(y) for x, y in shells) > 0.9 * len(a) * len(b):
            _brute_cross(fp, a, b, radius, out)
        else:
            stack += shells


def near_pairs(fp: np.ndarray, radius: int, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within the radius: among all points, or between those of side 0 and side 1. Each pair comes once."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    every = np.arange(len(fp))
    if side is not None and (side < 2).all():
        _cross(fp, every[side == 0], every[side == 1], radius, out)
        every = every[:0]
    stack = [every]
    while stack:
        a = stack.pop()
        if len(a) < 2:
            continue
        if len(a) <= LEAF:
            _brute_self(fp, a, radius, out)
            continue
        d = distances(fp[a], fp[a[0]])
        mu = int(np.median(d))
        inner = d <= mu
        if inner.all():  # half of the points or more lie at one distance: split below it instead
            inner = d < mu
        if not inner.any() or inner.all():
            _brute_self(fp, a, radius, out)
            continue
        edge = int(d[inner].max())
        stack += [a[inner], a[~inner]]
        _cross(fp, a[inner & (d >= d[~inner].min() - radius)], a[~inner & (d <= edge + radius)], radius, out)
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out])
