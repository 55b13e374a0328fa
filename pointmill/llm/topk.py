"""Exact top-k inner products by a dual-tree cover-tree search.

Vectors become integers floor(1024 * x). Candidates are dealt into cells by
their nearest pivot (a bounded sample), large cells being split into blocks by a
hash, so one very common vector is many blocks. Queries form groups by the same
pivots. A cell has a centre and a covering radius; a query goes to a cell only
if the best possible score there, from centre and radius, is not below the worst
k-th score known of it. First each group meets its own cell, which gives good
k-th scores, then the other cells that these leave. In each block a cover tree
over the candidates meets cover trees over the groups' queries, and pairs of
nodes are pruned in the same way. K-th scores start from a bounded sample of the
candidates, which can only lower-bound the true ones, so the search stays exact;
blocks' best are merged by query. A task holds one block and a bounded batch of
groups.

Vectors that are null, empty or hold null or non-finite components take no part,
nor do rows with a null id. Queries meet vectors of their own dimension only and
never rows with their own id. Repeated candidate rows count as rows; repeated
queries are answered once. Ties go to the smaller id; with fewer than k
candidates all are returned. Components or scores beyond 64 bits raise an error.
Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .spark_tools import cut

LEAF, FANOUT = 128, 16
#: No k-th score is known.
NONE = np.iinfo(np.int64).min
OUT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def integers(vectors: DataFrame, vector: str = "embedding", scale: float = 1024.0) -> DataFrame:
    """vec_id, v (array<bigint>) of the rows that take part."""
    double = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0)).where(fine)
    beyond = F.raise_error(F.lit("a vector's component is beyond 64 bits after scaling")).cast("bigint")
    whole = lambda x: F.when(F.abs(x * scale) < F.lit(2.0**63), F.floor(x * scale).cast("bigint")).otherwise(beyond)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(double, whole).alias("v"))


def matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products; floats hold them while they are below 2**53."""
    top = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * max(a.shape[1], 1)
    if top < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if top < 2**62:
        return a @ b.T
    whole = a.astype(object) @ b.T.astype(object)
    if whole.size and (whole.max() >= 2**63 or whole.min() <= NONE):
        raise OverflowError("a score is beyond 64 bits")
    return whole.astype(np.int64)


def best_possible(dot, norm_a, radius_a, norm_b, radius_b):
    """No pair of points of two balls scores more: centres' product, norms and radii, with room for rounding in proportion to the terms."""
    return dot + radius_a * norm_b + norm_a * radius_b + radius_a * radius_b + 1 + 1e-9 * (norm_a + radius_a) * (norm_b + radius_b)


class Node:
    __slots__ = ("rows", "centre", "radius", "norm", "children")

    def __init__(self, rows, centre, radius, children) -> None:
        self.rows, self.centre, self.radius, self.children = rows, centre, radius, children
        self.norm = float(np.sqrt(centre @ centre))


def cover_tree(x: np.ndarray, rows: np.ndarray | None = None, centre: int | None = None) -> Node:
    """Children's centres are taken farthest first until they cover at half the radius (or FANOUT are taken): each level covers its points and keeps its centres apart."""
    rows = np.arange(len(x)) if rows is None else rows
    centre = rows[0] if centre is None else centre
    d = np.sqrt(((x[rows] - x[centre]) ** 2).sum(1))
    radius = float(d.max(initial=0.0))
    if len(rows) <= LEAF or radius == 0:
        return Node(rows, x[centre], radius, [])
    centres, near, owner = [centre], d.copy(), np.zeros(len(rows), np.int64)
    while len(centres) < FANOUT and near.max() > radius / 2:
        far = int(near.argmax())
        e = np.sqrt(((x[rows] - x[rows[far]]) ** 2).sum(1))
        owner[e < near] = len(centres)
        near = np.minimum(near, e)
        centres.append(rows[far])
    parts = [(c, rows[owner == i]) for i, c in enumerate(centres)]
    return Node(rows, x[centre], radius, [cover_tree(x, r, c) for c, r in parts if len(r)])


class Search:
    """Dual traversal of one block of candidates and one group of queries."""

    def __init__(self, ids, x, query_ids, queries, k: int, floor: np.ndarray) -> None:
        self.ids, self.x, self.qids, self.q, self.k = ids, x, query_ids, queries, k
        self.floor = floor.copy()  # what is known of each k-th score
        self.scores = np.zeros((len(query_ids), k), np.int64)
        self.found = np.zeros((len(query_ids), k), np.int64)
        self.there = np.zeros((len(query_ids), k), bool)

    def bound(self, a: Node, b: Node) -> float:
        return best_possible(float(a.centre @ b.centre), a.norm, a.radius, b.norm, b.radius)

    def run(self, a: Node, b: Node) -> None:
        if self.bound(a, b) < self.floor[a.rows].min():
            return
        if not a.children and not b.children:
            self.leaf(a.rows, b.rows)
        elif b.children and (not a.children or len(b.rows) >= len(a.rows)):
            for child in sorted(b.children, key=lambda c: -self.bound(a, c)):
                self.run(a, child)
        else:
            for child in a.children:
                self.run(child, b)

    def leaf(self, q: np.ndarray, d: np.ndarray) -> None:
        s = products(self.q[q], self.x[d])
        ok = (s >= self.floor[q][:, None]) & (self.qids[q][:, None] != self.ids[d][None, :])
        some = ok.any(1)
        q, s, ok = q[some], s[some], ok[some]
        if not len(q):
            return
        used = ok.any(0)
        s, ok, d = s[:, used], ok[:, used], d[used]
        scores = np.hstack([self.scores[q], s])
        ids = np.hstack([self.found[q], np.broadcast_to(self.ids[d], s.shape)])
        there = np.hstack([self.there[q], ok])
        order = np.lexsort((ids, -scores, ~there), axis=-1)[:, : self.k]
        at = np.arange(len(q))[:, None]
        self.scores[q], self.found[q], self.there[q] = scores[at, order], ids[at, order], there[at, order]
        full = self.there[q, -1]
        self.floor[q[full]] = np.maximum(self.floor[q[full]], self.scores[q[full], -1])

    def rows(self):
        q, j = np.nonzero(self.there)
        return self.qids[q], self.found[q, j], self.scores[q, j]


class Pivots:
    """A bounded sample of the candidates: pivots of the cells and first k-th scores, by dimension."""

    def __init__(self, sample: list, pivots: int) -> None:
        self.pivots, self.rows = pivots, {}
        for n in {len(r.v) for r in sample}:
            own = [r for r in sample if len(r.v) == n]
            self.rows[n] = np.array([r.vec_id for r in own]), np.array([r.v for r in own], np.int64)

    def of(self, dim: int) -> np.ndarray:
        return self.rows[dim][1][: self.pivots].astype(np.float64) if dim in self.rows else np.zeros((1, dim))

    def cells(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nearest pivot of each vector, distance to it)."""
        x, p = v.astype(np.float64), self.of(v.shape[1])
        cell = ((p * p).sum(1)[None] - 2 * x @ p.T).argmin(1)
        return cell, np.sqrt(((x - p[cell]) ** 2).sum(1))

    def floor(self, ids: np.ndarray, v: np.ndarray, k: int) -> np.ndarray:
        """What the sample alone says of each query's k-th score."""
        known, x = self.rows.get(v.shape[1], (np.zeros(0), None))
        if len(known) < k:
            return np.full(len(ids), NONE)
        s = np.where(ids[:, None] == known[None], NONE, products(v, x))
        return np.partition(s, len(known) - k, axis=1)[:, len(known) - k]


def dealt(data: DataFrame, shared) -> DataFrame:
    """vec_id, v, dim, cell, far (distance to the cell's pivot)."""

    def run(batches):
        for b in batches:
            sizes = np.diff(b["v"].offsets.to_numpy())
            cell, far = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            for n in np.unique(sizes):
                own = np.flatnonzero(sizes == n)
                cell[own], far[own] = shared.value.cells(matrix(b["v"].take(pa.array(own))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sizes.astype(np.int32)), pa.array(cell), pa.array(far)], [*b.schema.names, "dim", "cell", "far"])

    return data.mapInArrow(run, "vec_id bigint, v array<bigint>, dim int, cell bigint, far double")


def meetings(groups: DataFrame, shared, radii, k: int, own: bool) -> DataFrame:
    """dim, cell, part, asked (pickled ids, queries, k-th scores and cover tree): the queries of each group that some vector of a cell may still concern.

    groups: rows vec_id, v, floor by (dim, cell, part). radii: {(dim, cell): (radius, blocks)}, at most as many as there
    are pivots. `own` asks for the group's own cell, else for all others.
    """

    def meet(key, table):
        ids, q = table["vec_id"].to_numpy(), matrix(table["v"])
        floor = np.maximum(table["floor"].fill_null(NONE).to_numpy(), shared.value.floor(ids, q, k))
        x, p = q.astype(np.float64), shared.value.of(q.shape[1])
        there = [c for c in range(len(p)) if (q.shape[1], c) in radii.value and (c == key[1].as_py()) == own]
        radius = np.array([radii.value[q.shape[1], c][0] for c in there])
        best = best_possible(x @ p[there].T, np.sqrt((x * x).sum(1))[:, None], 0.0, np.sqrt((p[there] ** 2).sum(1))[None], radius[None])
        out = []
        for c, may in zip(there, (best >= floor[:, None]).T, strict=True):
            if may.any():
                asked = pickle.dumps((ids[may], q[may], floor[may], cover_tree(x[may])))
                out += [(q.shape[1], c, part, key[1].as_py() * 1_000_003 + key[2].as_py(), asked) for part in range(radii.value[q.shape[1], c][1])]
        names, kinds = ["dim", "cell", "part", "group", "asked"], (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [[]] * 5, kinds, strict=True)], names=names)

    return groups.groupBy("dim", "cell", "part").applyInArrow(meet, "dim int, cell bigint, part int, group bigint, asked binary")


def searched(blocks: DataFrame, met: DataFrame, k: int, batch: int = 16) -> DataFrame:
    """query_id, vec_id, score: each block's k best of every query that meets it; a task holds a block and about `batch` groups."""
    keys = ["dim", "cell", "part"]
    groups = met.groupBy(*keys).agg(F.ceil(F.count("*") / batch).cast("int").alias("batches"))
    met = met.join(groups, keys).withColumn("batch", F.pmod(F.xxhash64("group"), F.col("batches")).cast("int"))
    copies = blocks.join(groups, keys).withColumn("batch", F.explode(F.sequence(F.lit(0), F.col("batches") - 1)))

    def search(key, left, right):
        out = [[], [], []]
        if left.num_rows and right.num_rows:
            ids, x = left["vec_id"].to_numpy(), matrix(left["v"])
            tree = cover_tree(x.astype(np.float64))
            for asked in right["asked"]:
                query_ids, q, floor, queries = pickle.loads(asked.as_py())
                s = Search(ids, x, query_ids, q, k, floor)
                s.run(queries, tree)
                for o, c in zip(out, s.rows(), strict=True):
                    o.append(c)
        return pa.table([pa.array(np.concatenate(o) if o else np.zeros(0, np.int64), pa.int64()) for o in out], schema=OUT)

    right = met.select(*[F.col(c).alias(f"q_{c}") for c in (*keys, "batch")], "asked")
    return copies.select(*keys, "batch", "vec_id", "v").groupBy(*keys, "batch").cogroup(right.groupBy(*(f"q_{c}" for c in (*keys, "batch")))).applyInArrow(search, "query_id bigint, vec_id bigint, score bigint")


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, vector: str = "embedding", block_rows: int = 8192, group_rows: int = 512, sample: int = 2048, pivot_rows: int = 2048) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of vectors that is_query marks, against all rows; one pivot for about pivot_rows rows, at most `sample` of them."""
    data = cut(integers(vectors, vector))
    spark = data.sparkSession
    known = data.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").limit(sample).collect()  # bounded
    shared = spark.sparkContext.broadcast(Pivots(known, -(-data.count() // pivot_rows)))
    placed = cut(dealt(data, shared))
    cells = placed.groupBy("dim", "cell").agg(F.max("far").alias("radius"), F.ceil(F.count("*") / block_rows).cast("int").alias("parts")).collect()  # at most `sample` rows a dimension
    radii = spark.sparkContext.broadcast({(r.dim, r.cell): (r.radius * (1 + 1e-9) + 1, r.parts) for r in cells})
    split = lambda rows, size: rows.join(
        F.broadcast(rows.groupBy("dim", "cell").agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))), ["dim", "cell"]
    ).withColumn("part", F.pmod(F.hash(F.xxhash64("vec_id"), "v"), "parts"))
    blocks = split(placed, block_rows).select("dim", "cell", "part", "vec_id", "v")
    queries = split(placed.where(is_query).select("vec_id", "v", "dim", "cell").distinct(), group_rows)
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    first = queries.withColumn("floor", F.lit(None).cast("bigint"))
    near = cut(ranked(searched(blocks, cut(meetings(first, shared, radii, k, own=True)), k)).drop("rank"))
    floors = near.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("n"), F.min("score").alias("least"))
    second = queries.join(floors, "vec_id", "left").withColumn("floor", F.when(F.col("n") == k, F.col("least")))
    best = near.union(searched(blocks, cut(meetings(second, shared, radii, k, own=False)), k))
    return ranked(best).select("query_id", "rank", "vec_id", "score")


def op6_topk(spark, sf_dir) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


ORACLE_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10
"""
