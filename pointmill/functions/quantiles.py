"""Exact order statistics by histograms that are refined in a few passes.

A pass counts the values of each range still open in a few thousand bins, by
partial aggregates, and keeps only the bins that hold the ranks sought. A bin of
few values is read as it is. No task ever holds the values of a column, however
many differ, and what reaches the driver has a fixed size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS, FEW = 4096, 4096


def quantiles(df: DataFrame, columns: dict[str, Column], shares: list[float], by: Column | None = None) -> dict[tuple, float]:
    """{(column, share, group): value}, interpolated between the two values around share * (n - 1), as `percentile` does.

    Nulls do not count; a column without values has no entry. `by` should have few
    values, such as classes. NaN counts as greater than all numbers.
    """
    by = F.lit(None).cast("int") if by is None else by
    names = list(columns)
    rows = df.select(by.alias("g"), F.explode(F.array(*[F.struct(F.lit(k).alias("c"), columns[c].cast("double").alias("v")) for k, c in enumerate(names)])).alias("x"))
    rows = rows.select("g", "x.c", "x.v").where("v IS NOT NULL")
    open_, found = [], {}
    for r in rows.groupBy("g", "c").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect():  # a row for each group
        wanted = {k for q in shares for k in (math.floor(q * (r.n - 1)), math.ceil(q * (r.n - 1)))}
        open_.append({"g": r.g, "c": r.c, "n": r.n, "low": r.low, "high": r.high, "before": 0, "ranks": wanted, "size": r.n})
    sizes = {(r["g"], r["c"]): r["n"] for r in open_}
    while open_:
        still = []
        for t in open_:
            if t["low"] == t["high"] or math.isnan(t["low"]):
                found |= {(t["g"], t["c"], k): t["low"] for k in t["ranks"]}
            else:
                still.append(t)
        few = [t for t in still if t["size"] <= FEW]
        many = [t for t in still if t["size"] > FEW]
        if few:
            for i, values in _values(rows, few).items():
                t = few[i]
                found |= {(t["g"], t["c"], k): values[k - t["before"]] for k in t["ranks"]}
        open_ = _refined(rows, many) if many else []
    out = {}
    for (g, c), n in sizes.items():
        for q in shares:
            at = q * (n - 1)
            a, b = found[g, c, math.floor(at)], found[g, c, math.ceil(at)]
            out[names[c], q, g] = a if a == b else a * (math.ceil(at) - at) + b * (at - math.floor(at))
    return out


def quantile_table(df: DataFrame, columns: dict[str, Column], shares: list[float], by: str) -> DataFrame:
    """One row for each value of `by`, with columns such as h_p95 for {"h": ...} and 0.95."""
    got = quantiles(df, columns, shares, F.col(by))
    groups = {g for _, _, g in got}
    names = [(c, q, f"{c}_p{round(100 * q, 6):g}") for c in columns for q in shares]
    rows = [(g, *[got.get((c, q, g)) for c, q, _ in names]) for g in groups]
    kind = df.schema[by].dataType.simpleString()
    return df.sparkSession.createDataFrame(rows, f"{by} {kind}, " + ", ".join(f"{n} double" for *_, n in names))


def _inside(t: dict) -> Column:
    return F.col("g").eqNullSafe(F.lit(t["g"])) & (F.col("c") == t["c"]) & (F.col("v") >= t["low"]) & (F.col("v") <= t["high"])


def _values(rows: DataFrame, targets: list[dict]) -> dict[int, list[float]]:
    which = F.filter(F.array(*[F.when(_inside(t), F.lit(i)) for i, t in enumerate(targets)]), lambda x: x.isNotNull())
    got = rows.select(F.explode(which).alias("i"), "v").groupBy("i").agg(F.sort_array(F.collect_list("v")).alias("v")).collect()  # at most FEW values each
    return {r.i: r.v for r in got}


def _refined(rows: DataFrame, targets: list[dict]) -> list[dict]:
    def bin_of(t: dict) -> Column:
        width = (t["high"] / BINS) - (t["low"] / BINS)  # divided first: the difference itself may overflow
        if t.get("stuck") or not (0 < width < math.inf) or not math.isfinite(t["low"] / width):
            return F.when(F.col("v") == t["low"], 0).otherwise(1)
        return F.least(F.floor(F.col("v") / width - t["low"] / width), F.lit(BINS - 1)).cast("int")

    which = F.filter(F.array(*[F.when(_inside(t), F.struct(F.lit(i).alias("i"), bin_of(t).alias("b"))) for i, t in enumerate(targets)]), lambda x: x.isNotNull())
    bins = rows.select(F.explode(which).alias("t"), "v").groupBy("t.i", "t.b").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    out, before = [], [t["before"] for t in targets]
    for r in sorted(bins.collect(), key=lambda r: (r.i, r.b)):  # at most BINS a target
        t = targets[r.i]
        mine = {k for k in t["ranks"] if before[r.i] <= k < before[r.i] + r.n}
        if mine:
            out.append({"g": t["g"], "c": t["c"], "low": r.low, "high": r.high, "before": before[r.i], "ranks": mine, "size": r.n, "stuck": r.n == t["size"] and (r.low, r.high) == (t["low"], t["high"])})
        before[r.i] += r.n
    return out
