"""Near-duplicate documents by HyperMinHash and exact verification.

A document's set holds its distinct two-word shingles (the whole sequence if it
has fewer words). Equal sets form a class at once. A class keeps 256 registers:
shingles fall into a bucket by their hash, and a bucket keeps the least second
hash as a leading-zero count and ten mantissa bits; an empty bucket borrows from
the first full one in an order of its own. Registers are banded, five to a band;
classes that share a band are candidates. In a few bands each class is compared
with one centre and verified links are joined into components; then, in all
bands that still span several components, one class of each component with a
centre; and what then remains across components is compared pair by pair inside
tasks, large bands in pairs of parts, each pair in the first band it shares. A pair passes if its size ratio allows it, the
collision-corrected Jaccard estimate is not far below the threshold, and the
full sets agree.

Null and empty texts have no shingles and link with nothing. Rows that share a
doc_id are one vertex; a null doc_id links with nothing and has a null
component, and is kept. One output row per input row; empty tables give empty
results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from .spark_tools import batches_of, bit_filter, cut, in_filter
from .words import SPACED_LOWER, Words, mix, parts, split

REGISTERS, MANTISSA, BAND = 256, 10, 5
BANDS = REGISTERS // BAND
#: Expected accidental agreements a register, of the public HyperMinHash analysis.
ACCIDENT = 0.169919487159739 / 2**MANTISSA
_ORDERS = np.argsort(mix(np.arange(REGISTERS * REGISTERS, dtype=np.uint64) + np.uint64(99)).reshape(REGISTERS, REGISTERS), axis=1)
_EDGES = np.arange(REGISTERS, dtype=np.uint64) << np.uint64(56)
_ONE = np.uint64(1)


def shingle_sets(w: Words, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    grams, _ = w.grams(k)
    alone = {j: w.grams(j)[0] for j in range(1, k)}
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        n = b - a
        out.append(np.unique(grams[a : b - k + 1]) if n >= k else alone[n][a : a + 1] if n else grams[:0])
    return out


def registers(s: np.ndarray) -> np.ndarray:
    """The HyperMinHash registers of one set of sorted hashes."""
    at = np.searchsorted(s, _EDGES)
    full = np.diff(np.append(at, len(s))) > 0
    least = np.minimum.reduceat(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)), at[full]) | _ONE
    top = np.frexp(least.astype(np.float64))[1] - 1  # the highest set bit, at most one too high after rounding
    top = np.minimum(top, 63).astype(np.uint64)
    top -= (least >> top) == 0
    shift = np.where(top >= MANTISSA, top - np.uint64(MANTISSA), 0).astype(np.uint64)
    mantissa = (least >> shift) & np.uint64(2**MANTISSA - 1)
    out = np.zeros(REGISTERS, np.uint16)
    out[full] = ((np.uint64(63) - top) << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    empty = np.flatnonzero(~full)
    if len(empty):
        order = _ORDERS[empty]
        out[empty] = out[order[np.arange(len(empty)), full[order].argmax(1)]]
    return out


def sketches(docs: DataFrame, k: int = 2) -> DataFrame:
    """doc_id, n_shingles, set_a, set_b (128 bits of the set), sketch (bytes) per row."""

    def run(batches):
        for b in parts(batches):
            sets = shingle_sets(split(b["text"], SPACED_LOWER), k)
            n = np.array([len(s) for s in sets], np.int64)
            one = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
            two = np.array([mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets], np.uint64)
            sketch = [registers(s).tobytes() if len(s) else b"" for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array(n), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(sketch, pa.binary())],
                ["doc_id", "n_shingles", "set_a", "set_b", "sketch"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, n_shingles bigint, set_a bigint, set_b bigint, sketch binary")


def _sketch_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def bands(classes: DataFrame) -> DataFrame:
    """band, nth, rep: one row for each band of each class; nth is the band's number."""

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                part = b.slice(lo, 2000)
                m = _sketch_matrix(part["sketch"])[:, : BANDS * BAND].reshape(part.num_rows, BANDS, BAND).astype(np.uint64)
                h = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), m.shape[:2]).copy()
                for j in range(BAND):
                    h = mix(h * np.uint64(0x9E3779B97F4A7C15) + m[:, :, j] + _ONE)
                nth = np.tile(np.arange(BANDS, dtype=np.int32), part.num_rows)
                yield pa.RecordBatch.from_arrays([pa.array(h.ravel().view(np.int64)), pa.array(nth), part["rep"].take(pa.array(np.repeat(np.arange(part.num_rows), BANDS)))], ["band", "nth", "rep"])

    return classes.select("rep", "sketch").mapInArrow(run, f"band bigint, nth int, rep {classes.schema['rep'].dataType.simpleString()}")


def likely(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, similarity: float) -> np.ndarray:
    """Row by row: whether the sizes allow the similarity and the collision-corrected estimate is at most four deviations below it."""
    j = ((x == y).mean(1) - ACCIDENT) / (1 - ACCIDENT)
    small, large = np.minimum(nx, ny), np.maximum(nx, ny)
    return (small >= similarity * large - 1e-6) & (j >= similarity - 4 * np.sqrt(similarity * (1 - similarity) / np.minimum(small, REGISTERS)))


def estimated(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """The likely ones of the pairs (a, b)."""
    left = classes.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = classes.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))

    def agree(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for sa, sb, na, nb in batches:
            x, y = (np.frombuffer(b"".join(s), np.uint16).reshape(-1, REGISTERS) for s in (sa, sb))
            yield pd.Series(likely(x, y, na.to_numpy(float), nb.to_numpy(float), similarity), dtype=bool)

    sized = pairs.join(left, "a").join(right, "b").where(F.least("na", "nb") >= similarity * F.greatest("na", "nb") - 1e-6)
    return sized.where(F.pandas_udf(agree, "boolean")("sa", "sb", "na", "nb")).select("a", "b")


def _likely_pairs(table: pa.Table, part_i: int, part_j: int, similarity: float):
    """For each row x of a group, the later rows y of another component that it is likely to resemble and shares this band with first; across parts if they differ."""
    n, own = table["n"].to_numpy().astype(float), table["own"].to_numpy()
    c = np.unique(np.array(table["c"].to_pylist(), object), return_inverse=True)[1]
    m = _sketch_matrix(table["sketch"])
    banded = m[:, : BANDS * BAND].reshape(len(m), BANDS, BAND)
    nth = table["nth"][0].as_py() if len(m) else 0
    for x in range(len(m) - 1):
        y = np.arange(x + 1, len(m))
        y = y[(c[y] != c[x]) & ((own[y] != own[x]) | (part_i == part_j))]
        if len(y):
            y = y[likely(m[y], m[x][None], n[y], np.full(len(y), n[x]), similarity)]
        if len(y):
            y = y[(banded[y] == banded[x]).all(2).argmax(1) == nth]
        if len(y):
            yield x, y


def links_across(docs: DataFrame, groups: DataFrame, classes: DataFrame, k: int, percent: int, part: int = 512) -> DataFrame:
    """Verified links (a, b) between different components in the groups (band, nth, rep, c), written.

    A group is split into parts of about `part` classes; each pair of parts is a
    group of its own, so a large band is spread. First the classes with some
    likely partner are named; then their full sets meet in the same groups, and
    only verified links leave them.
    """
    similarity = percent / 100
    parts_of = groups.groupBy("band").agg(F.ceil(F.count("*") / part).cast("int").alias("parts"))
    rows = groups.join(parts_of, "band").join(classes.select("rep", "n", "sketch"), "rep")
    own = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    rows = rows.select("band", "nth", "rep", "c", "n", "sketch", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    rows = cut(rows.select("band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "nth", "rep", "c", "n", "sketch", "own"))
    kind = classes.schema["rep"].dataType.simpleString()

    def hopeful(key, table):
        some = np.zeros(table.num_rows, bool)
        for x, y in _likely_pairs(table, key[1].as_py(), key[2].as_py(), similarity):
            some[x] = some[y] = True
        return table.select(["band", "i", "j", "rep"]).filter(pa.array(some))

    def verify(key, table):
        full = [np.frombuffer(v, np.uint64) for v in table["full"].to_pylist()]
        a, b = [], []
        for x, ys in _likely_pairs(table, key[1].as_py(), key[2].as_py(), similarity):
            for y in ys.tolist():
                both = len(np.intersect1d(full[x], full[y], assume_unique=True))
                if both and 100 * both >= percent * (len(full[x]) + len(full[y]) - both):
                    a.append(x)
                    b.append(y)
        rep = table["rep"].combine_chunks()
        return pa.table({"a": rep.take(pa.array(a, pa.int64())), "b": rep.take(pa.array(b, pa.int64()))})

    keys = ["band", "i", "j"]
    named = cut(rows.groupBy(*keys).applyInArrow(hopeful, f"band bigint, i int, j int, rep {kind}"))
    sets = cut(full_sets(docs, named.select(F.col("rep").alias("id")), k))
    wanted = named.join(rows, [*keys, "rep"]).join(sets, F.col("rep") == F.col("id")).drop("id")
    found = wanted.groupBy(*keys).applyInArrow(verify, f"a {kind}, b {kind}")
    return cut(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def full_sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """id, full (bytes of the sorted shingle hashes) of the documents in ids; a bounded filter spares the others' sets the work and the shuffle."""
    ids = ids.distinct()
    bits = docs.sparkSession.sparkContext.broadcast(bit_filter(ids.select(F.xxhash64("id").alias("h")), 24))

    def run(batches):
        table = np.frombuffer(bits.value, np.uint8)
        for b in batches:
            b = b.filter(pa.array(in_filter(table, b["h"].to_numpy().view(np.uint64))))
            for p in parts([b]):
                full = [s.tobytes() for s in shingle_sets(split(p["text"], SPACED_LOWER), k)]
                yield pa.RecordBatch.from_arrays([p["id"], pa.array(full, pa.binary())], ["id", "full"])

    slim = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), F.xxhash64("doc_id").alias("h"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, f"id {ids.schema['id'].dataType.simpleString()}, full binary").join(ids, "id", "left_semi")


def verified(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of their full sets, written."""
    sets = cut(full_sets(docs, pairs.select(F.col("a").alias("id")).union(pairs.select("b")), k))
    left, right = sets.select(F.col("id").alias("a"), F.col("full").alias("fa")), sets.select(F.col("id").alias("b"), F.col("full").alias("fb"))

    def alike(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for fa, fb in batches:
            out = []
            for x, y in zip(fa, fb, strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                out.append(bool(both) and 100 * both >= percent * (len(x) + len(y) - both))
            yield pd.Series(out, dtype=bool)

    with batches_of(docs.sparkSession, 500):
        return cut(pairs.join(left, "a").join(right, "b").where(F.pandas_udf(alike, "boolean")("fa", "fb")).select("a", "b").distinct())


def near_duplicates(docs: DataFrame, k: int = 2, percent: int = 80, first_bands: int = 4, star_rounds: int = 1) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per row of docs."""
    found = cut(sketches(docs, k))
    linked = found.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = cut(linked.groupBy("set_a", "set_b", F.col("n_shingles").alias("n")).agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch")))
    banded = bands(classes)
    shared = banded.groupBy("band").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi")
    groups = cut(banded.join(shared.select("band", F.col("lo").alias("centre")), "band"))
    similarity = percent / 100
    pair = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))

    tested = cut(groups.where((F.col("nth") < first_bands) & (F.col("rep") != F.col("centre"))).select(*pair("centre", "rep")).distinct())
    links = verified(docs, cut(estimated(tested, classes, similarity)), k, percent)
    for turn in range(star_rounds + 1):
        components = connected_components(links)
        named = cut(groups.drop("centre").join(components, groups["rep"] == components["id"], "left").select("band", "nth", "rep", F.coalesce("component", "rep").alias("c")))
        by = F.xxhash64("rep", F.lit(turn))
        apart = named.groupBy("band").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min_by(F.struct("rep", "c"), by).alias("centre")).where("lo < hi")
        if turn < star_rounds:  # one class of each component with the band's centre
            one = named.join(apart.select("band", "centre"), "band").where("c <> centre.c").groupBy("band", "c").agg(F.min_by(F.struct("rep", "centre"), by).alias("p"))
            new = one.select(*pair("p.rep", "p.centre.rep")).distinct().join(tested, ["a", "b"], "left_anti")
            new = cut(new)
            tested = tested.union(new)
            links = links.union(verified(docs, cut(estimated(new, classes, similarity)), k, percent))
        else:  # what is left
            links = links.union(links_across(docs, named.join(apart.select("band"), "band"), classes, k, percent))
    members = linked.join(classes.select("set_a", "set_b", F.col("n").alias("n_shingles"), "rep"), ["set_a", "set_b", "n_shingles"]).select("doc_id", "rep")
    components = connected_components(links.union(members.where("doc_id <> rep").select("rep", "doc_id")))
    return found.join(components, found["doc_id"] == components["id"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(True)).alias("kept")
    )


def op7_near_dedup(spark, sf_dir) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with all columns of docs."""
    gone = near_duplicates(docs, k, percent).where("NOT kept").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__id"], "left_anti")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
#: The joined sets make this right for small tables only.
ORACLE_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 2 THEN w ELSE w[i:i + 1] END AS g FROM d, unnest(range(1, greatest(len(w), 2))) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
x AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM x JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM d LEFT JOIN n USING (doc_id) JOIN m ON m.doc_id = d.doc_id
"""
