"""Links between close points, found leaf by leaf and contracted before they leave it.

Distances are rounded up to rungs. A point's core rung is the least one within
which points of a given weight lie, itself counted; two points are linked on the
greatest of their core rungs and the rung of their distance. A leaf of the
quadtree sees all points within two reaches of its own, so it knows the core
rungs of both ends of each link of its own points. What leaves it is, for each of
its points, the least point that it is linked with on the lowest rung inside the
leaf, and a spanning forest of all other links between such parts and points of
the halo: no more rows than points, however dense the cloud.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import cut
from .graph import merged
from .quadtree import LEAF, dealt

PAIRS = 2_000_000


def close_pairs(xyz: np.ndarray, reach: float, wanted: np.ndarray, among: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, squared distance) of all pairs within reach, the first point wanted and the second among those marked (all, by default), each with itself too, in bounded parts."""
    cell = np.floor((xyz - xyz.min(0)) / reach).astype(np.int64) + 1
    size = cell.max(0) + 2
    key = (cell[:, 0] * size[1] + cell[:, 1]) * size[2] + cell[:, 2]
    order = np.arange(len(key)) if among is None else np.flatnonzero(among)
    order = order[np.argsort(key[order], kind="stable")]
    ranked = key[order]
    # boxes above each other have neighbouring keys, so nine ranges hold all 27 boxes
    steps = np.array([(i * size[1] + j) * size[2] for i in (-1, 0, 1) for j in (-1, 0, 1)])
    own = np.flatnonzero(wanted)
    own = own[np.argsort(key[own], kind="stable")]
    for at in range(0, len(own), 20_000):
        some = own[at : at + 20_000]
        middle = key[some][:, None] + steps
        low, high = np.searchsorted(ranked, middle - 1, "left"), np.searchsorted(ranked, middle + 1, "right")
        total = np.cumsum((high - low).sum(1))
        ends = np.unique(np.append(np.searchsorted(total, np.arange(PAIRS, total[-1], PAIRS), "right"), len(some)))
        for a, z in zip([0, *ends], ends, strict=False):
            start, count = low[a:z].ravel(), (high - low)[a:z].ravel()
            j = order[np.repeat(start, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
            i = np.repeat(some[a:z], count.reshape(-1, 9).sum(1))
            d2 = ((xyz[i] - xyz[j]) ** 2).sum(1)
            near = d2 <= reach * reach
            yield i[near], j[near], d2[near]


def forest(a: np.ndarray, b: np.ndarray, rung: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, rung) of a spanning forest that connects, up to each rung, what all links up to it connect."""
    label, out = np.arange(n), [(a[:0], b[:0], rung[:0])]
    for r in np.unique(rung):
        label, x, y = merged(label, a[rung == r], b[rung == r])
        out.append((x, y, np.full(len(x), r)))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def leaf_links(xyz: np.ndarray, weight: np.ndarray, ids: np.ndarray, n_own: int, rungs: np.ndarray, samples: int) -> tuple[np.ndarray, ...]:
    """(core rung, part) of the own points, which come first, and links (a, b, rung) between parts and points of the halo, all by id; len(rungs) stands for none."""
    n, top, squares = len(xyz), len(rungs), rungs * rungs
    own = np.arange(n) < n_own
    low, high = xyz[own].min(0) - rungs[-1], xyz[own].max(0) + rungs[-1]
    within = np.zeros(n * (top + 1))
    for i, j, d2 in close_pairs(xyz, rungs[-1], ((xyz >= low) & (xyz <= high)).all(1)):
        np.add.at(within, i * (top + 1) + np.searchsorted(squares, d2), weight[j])
    enough = np.cumsum(within.reshape(n, top + 1)[:, :top], axis=1) >= samples
    core = np.where(enough.any(1), enough.argmax(1), top)
    held = tuple(np.zeros(0, np.int64) for _ in range(3))
    for i, j, d2 in close_pairs(xyz, rungs[-1], own):
        rung = np.maximum(np.maximum(core[i], core[j]), np.searchsorted(squares, d2))
        new = (rung < top) & (i < j)
        held = forest(*(np.concatenate(c) for c in zip(held, (i[new], j[new], rung[new]), strict=True)), n)
    a, b, rung = held
    inside = (rung == 0) & own[a] & own[b]
    part = merged(np.arange(n), a[inside], b[inside])[0]
    return core[own], ids[part[own]], ids[part[a[~inside]]], ids[part[b[~inside]]], rung[~inside]


def links(points: DataFrame, rungs: list[float], samples: int, cap: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """(id, core, part) of each row of a written table (id, x, y, z, n), and (a, b, rung) between parts; core is null for points without enough near them."""
    reach = rungs[-1]
    kinds = "id bigint, core int, a bigint, b bigint, rung int"
    steps = np.array(rungs, float)

    def search(table: pa.Table) -> pa.Table:
        get = lambda c: table[c].combine_chunks().to_numpy(zero_copy_only=False)
        order = np.argsort(~get("is_core"), kind="stable")
        ids, n = get("id")[order], int(get("is_core").sum())
        xyz = np.column_stack([get(c)[order] for c in "xyz"])
        core, part, a, b, rung = leaf_links(xyz, get("n")[order].astype(float), ids, n, steps, samples)
        of_points = pa.table({"id": ids[:n], "core": core.astype(np.int32), "a": part, "b": pa.nulls(n, pa.int64()), "rung": pa.nulls(n, pa.int32())})
        m = len(a)
        of_links = pa.table({"id": pa.nulls(m, pa.int64()), "core": pa.nulls(m, pa.int32()), "a": a, "b": b, "rung": rung.astype(np.int32)})
        return pa.concat_tables([of_points, of_links])

    placed = dealt(points.select("id", "x", "y", "z", "n"), max(2 * reach, 0.5), cap, 2 * reach)
    found = cut(placed.groupBy(*LEAF).applyInArrow(search, kinds))
    parts = found.where("id IS NOT NULL").select("id", F.when(F.col("core") < len(rungs), F.col("core")).alias("core"), F.col("a").alias("part"))
    between = found.where("id IS NULL").select("a", "b", "rung")
    # a halo point stands for the part that its own leaf gave it
    label = parts.select("id", "part")
    ends = between.join(label.select(F.col("id").alias("a"), F.col("part").alias("pa")), "a").join(label.select(F.col("id").alias("b"), F.col("part").alias("pb")), "b")
    return parts, ends.where("pa <> pb").groupBy(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).agg(F.min("rung").alias("rung"))
