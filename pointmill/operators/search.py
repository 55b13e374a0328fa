"""Neighbours inside one task: exact searches in numpy, a grid at a time.

Targets are sorted by cells as wide as the radius sought; the queries of a cell
share the targets of the cells around it, so distances come as matrices of
bounded size. A search begins with cells that hold a few targets and goes on with
wider ones for queries that are not settled: the work follows the density around
a query, not the radius that a rule allows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import product

import numpy as np

#: Entries of a matrix of distances, and cells along an axis.
ENTRIES, CELLS = 1 << 18, 2**20


def ragged(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, .. of each row, count of them, one row after the other."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())


def fitted(xyz: np.ndarray, most: int) -> float:
    """A side of cells such that the median point shares its cell with about `most` points or fewer."""
    n, d = xyz.shape
    low, extent = xyz.min(0), xyz.max(0) - xyz.min(0)
    least = max(float(extent.max()) / CELLS, 1e-9)
    side = max(float(np.prod(np.maximum(extent, least)) * most / n) ** (1 / d), least)
    for _ in range(12):
        cell = np.floor((xyz - low) / side).astype(np.int64)
        size = cell.max(0) + 1
        key = cell[:, 0]
        for k in range(1, d):
            key = key * size[k] + cell[:, k]
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        middle = float(np.median(count[which]))
        if middle <= 1.3 * most or side <= least:
            break
        side = max(side * min((most / middle) ** (1 / d), 0.8), least)
    return side


def around(queries: np.ndarray, targets: np.ndarray, reach: float, least: int = 1) -> Iterator[tuple[np.ndarray, Callable, Callable]]:
    """(queries, differences, names) in parts of bounded size: differences(axis) is a matrix of target minus query, names(rows, columns) the targets of its entries.

    A query's row has all targets within reach, others of the cells around it, and
    infinite entries. Queries with fewer than `least` targets in these cells are left out.
    """
    d = targets.shape[1]
    low = np.minimum(queries.min(0), targets.min(0))
    high = np.maximum(queries.max(0), targets.max(0))
    side = max(reach * (1 + 1e-9), float((high - low).max()) / CELLS)
    size = np.floor((high - low) / side).astype(np.int64) + 3

    def keys(xyz: np.ndarray) -> np.ndarray:
        key = np.zeros(len(xyz), np.int64)
        for k in range(d):
            key = key * size[k] + np.floor((xyz[:, k] - low[k]) / side).astype(np.int64) + 1
        return key

    ranked = keys(targets)
    order = np.argsort(ranked, kind="stable")
    ranked = ranked[order]
    own = keys(queries)
    by = np.argsort(own, kind="stable")
    cell, first, many = np.unique(own[by], return_index=True, return_counts=True)
    # cells next to each other along the last axis have neighbouring keys
    steps = np.zeros(1, np.int64)
    for k in range(d - 1):
        steps = np.array([(s + i) * size[k + 1] for s, i in product(steps, (-1, 0, 1))])
    middle = cell[:, None] + steps
    start = np.searchsorted(ranked, middle - 1, "left")
    count = np.searchsorted(ranked, middle + 1, "right") - start
    width = count.sum(1)
    rank = np.argsort(width, kind="stable")
    rank = rank[np.searchsorted(width[rank], max(least, 1)) :]
    held = [np.append(targets[order, k], np.inf) for k in range(d)]
    asked = [queries[by, k] for k in range(d)]
    wide, total = width[rank], np.append(0, np.cumsum(many[rank]))
    at = 0
    while at < len(rank):
        end, over = at + 1, len(rank) + 1
        while over - end > 1:
            half = (end + over) // 2
            end, over = (half, over) if (total[half] - total[at]) * wide[half - 1] <= ENTRIES else (end, half)
        some, c = rank[at:end], int(wide[end - 1])
        rows = np.repeat(np.arange(len(some)), width[some])
        index = np.full((len(some), c), len(targets))
        index[rows, ragged(np.zeros(len(some), np.int64), width[some])] = ragged(start[some].ravel(), count[some].ravel())
        places, row = ragged(first[some], many[some]), np.repeat(np.arange(len(some)), many[some])
        part = max(1, ENTRIES // c)
        near = [h[index] for h in held]
        for a in range(0, len(places), part if end == at + 1 else len(places)):
            z = a + part if end == at + 1 else len(places)
            p, r = places[a:z], row[a:z]
            yield by[p], lambda k, p=p, r=r: near[k][r] - asked[k][p][:, None], lambda i, j, r=r: order[index[r[i], j]]
        at = end


def squares(differences: Callable, d: int) -> np.ndarray:
    out = differences(0)
    out *= out
    for k in range(1, d):
        more = differences(k)
        more *= more
        out += more
    return out


def closest(queries: np.ndarray, targets: np.ndarray, k: int, limit: float, begin: float) -> np.ndarray:
    """The k least squared distances below limit squared of each query, in any order; infinite where there are fewer."""
    n, d = queries.shape
    out, left, reach = np.full((n, k), np.inf), np.arange(n), begin
    while len(left) and len(targets):
        last = reach >= limit
        reach = min(reach, limit)
        settled = np.zeros(len(left), bool)
        for q, differences, _ in around(queries[left], targets, reach, 1 if last else k):
            d2 = squares(differences, d)
            if d2.shape[1] > k:
                d2.partition(k - 1, axis=1)
                d2 = d2[:, :k]
            if last:
                out[left[q], : d2.shape[1]] = np.where(d2 < limit * limit, d2, np.inf)
            else:
                enough = d2.max(1) < reach * reach
                out[left[q[enough]]] = d2[enough]
                settled[q[enough]] = True
        if last:
            break
        left = left[~settled]
        reach *= 1.5
    return out


def nearest_one(queries: np.ndarray, targets: np.ndarray, ids: np.ndarray, limit: float, begin: float) -> tuple[np.ndarray, np.ndarray]:
    """(target, squared distance) of each query: the nearest one closer than limit, ties to the smaller id; -1 where there is none."""
    n, d = queries.shape
    best, dist, left, reach = np.full(n, -1), np.full(n, np.inf), np.arange(n), begin
    while len(left) and len(targets):
        reach = min(reach, limit)
        settled = np.zeros(len(left), bool)
        for q, differences, names in around(queries[left], targets, reach):
            d2 = squares(differences, d)
            rows, column = np.arange(len(q)), d2.argmin(1)
            least = d2[rows, column]
            near = least < reach * reach
            chosen = np.full(len(q), -1)
            chosen[near] = names(rows[near], column[near])
            ties = d2 == least[:, None]
            several = np.flatnonzero(near & (np.count_nonzero(ties, axis=1) > 1))
            if len(several):
                i, j = np.nonzero(ties[several])
                target = names(several[i], j)
                by = np.lexsort((ids[target], i))
                head = by[np.append(True, i[by][1:] != i[by][:-1])]
                chosen[several[i[head]]] = target[head]
            best[left[q[near]]], dist[left[q[near]]] = chosen[near], least[near]
            settled[q[near]] = True
        left = left[~settled]
        if reach >= limit:
            break
        reach *= 2
    return best, dist


def exposed(own: np.ndarray, targets: np.ndarray, reach: float, begin: float) -> np.ndarray:
    """Whether each own target may be the nearest one, in the plane, of some place that is at least `reach` away from it; some that are not count too.

    A target that has others within 3/4 of reach in so many directions that no two
    octants next to each other are empty has, for any such place, one of them within
    67.5 degrees of the place's direction, and that one is strictly closer.
    """
    out, left, side = np.ones(len(own), bool), np.arange(len(own)), begin
    while len(left):
        side = min(side, 0.75 * reach)
        for q, differences, _ in around(own[left], targets, side):
            x, y = differences(0), differences(1)
            d2 = x * x + y * y
            octant = np.where(x < 0, 1, 0) + np.where(y < 0, 2, 0) + np.where(np.abs(x) < np.abs(y), 4, 0)
            bits = np.where((d2 <= side * side) & (d2 > 1e-8 * reach * reach), 1 << OCTANT[octant], 0)
            out[left[q]] = ~CLOSED[np.bitwise_or.reduce(bits, axis=1)]
        before, left = len(left), left[out[left]]
        if side >= 0.75 * reach or side > begin and 2 * len(left) > before:
            break
        side *= 2
    return out


#: The place around the circle of an octant by its signs, and which sets of octants leave no two neighbours empty.
OCTANT = np.array([0, 3, 7, 4, 1, 2, 6, 5])
CLOSED = np.array([all(s >> k & 1 or s >> (k + 1) % 8 & 1 for k in range(8)) for s in range(256)])
