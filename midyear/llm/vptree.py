"""Vantage-point trees over 64-bit fingerprints under Hamming distance.

A node keeps the points within ``radius`` of its vantage point inside and the others outside.
Two points at distance ``reach`` or less that a node parts lie on either side of its boundary: by the
triangle inequality the inner one is more than ``radius - reach`` away from the vantage point.
Such inner points go along to the outer side too, so that every close pair meets in a leaf.
"""

from __future__ import annotations

import numpy as np


def distances(points: np.ndarray, centre: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ centre)


def best_split(points: np.ndarray, reach: int, tries: int = 6) -> tuple[np.uint64, int] | None:
    """The vantage point and radius that leave the least work; None if no split helps."""
    best, found = 0.8 * len(points) ** 2, None
    for centre in points[np.linspace(0, len(points) - 1, tries).astype(np.int64)]:
        upto = np.cumsum(np.bincount(distances(points, centre), minlength=65))
        outside = len(points) - np.concatenate([np.zeros(reach, np.int64), upto[:-reach]])
        work = upto**2 + outside**2  # by radius
        radius = int(np.argmin(work))
        if work[radius] < best:
            best, found = work[radius], (centre, radius)
    return found


def build_tree(points: np.ndarray, n_all: int, leaf: int, reach: int) -> list[tuple]:
    """Nodes (centre, radius, inner, outer); a leaf has centre None.  ``points`` stands for ``n_all``."""
    nodes: list = []
    weight = n_all / max(1, len(points))

    def grow(some: np.ndarray) -> int:
        at = len(nodes)
        nodes.append((None, 0, 0, 0))
        split = best_split(some, reach) if len(some) >= 8 and len(some) * weight > leaf else None
        if split:
            inner, outer = part(some, *split, reach)
            nodes[at] = (*split, grow(some[inner]), grow(some[outer]))
        return at

    grow(np.sort(points))
    return nodes


def part(points: np.ndarray, centre: np.uint64, radius: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    gap = distances(points, centre)
    return np.flatnonzero(gap <= radius), np.flatnonzero(gap > radius - reach)


def route(points: np.ndarray, nodes: list[tuple], reach: int):
    """(leaf, positions in ``points``) for every leaf that a point belongs to."""
    todo = [(0, np.arange(len(points)))]
    while todo:
        node, at = todo.pop()
        centre, radius, inner, outer = nodes[node]
        if centre is None:
            if len(at):
                yield node, at
            continue
        near, far = part(points[at], centre, radius, reach)
        todo += [(inner, at[near]), (outer, at[far])]


def close_stars(points: np.ndarray, reach: int, leaf: int = 256) -> list[tuple[int, int]]:
    """Links that join all ``points`` (distinct) at ``reach`` or less, at most one a point and leaf."""
    links = []
    todo = [np.sort(points)]
    while todo:
        some = todo.pop()
        split = best_split(some, reach) if len(some) > leaf else None
        if split:
            todo += [some[at] for at in part(some, *split, reach)]
        elif len(some) > 1:
            label = _labels(some, reach)
            own = np.flatnonzero(label != np.arange(len(some)))
            links += zip(some[own].tolist(), some[label[own]].tolist())
    return links


def _labels(points: np.ndarray, reach: int, block: int = 1024) -> np.ndarray:
    """For each point the first point it is joined with through close ones."""
    label = np.arange(len(points))
    while True:
        before = label.copy()
        for first in range(0, len(points), block):
            rows = slice(first, first + block)
            for other in range(0, len(points), 4 * block):
                columns = slice(other, other + 4 * block)
                near = np.bitwise_count(points[rows, None] ^ points[None, columns]) <= reach
                least = np.where(near, label[None, columns], len(points)).min(axis=1)
                label[rows] = np.minimum(label[rows], least)
        label = label[label]
        if (label == before).all():
            return label
