"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into windows of ten words (an item of fewer words is one
window). A window is a set of word shingles (five words, or all of a shorter
window) that a document must contain wholly. Under full containment the
necessary prefix is one shingle, so each window is joined through its rarest
shingle alone, rarity being the number of documents that hold it; a window with
a shingle that no document holds drops out at once. The place of the shingle in
the window bounds where the window must start and end in the document, and the
words there are compared exactly.

Null or empty texts have no words and are never contaminated; null doc_ids and
repeated rows are kept, each input row gives one output row; items with null
text or id count for nothing; empty tables give empty results. Columns other
than doc_id and text (item_id and text) are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spark_tools import bit_filter, cut, in_filter, text_key
from .words import ALNUM, parts, split

WINDOW, SHINGLE = 10, 5


def item_windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """item_id, words (of one window), shingles array<struct<at, h>>."""

    def make(batches):
        for b in batches:
            w = split(b["text"], ALNUM)
            grams: dict[int, np.ndarray] = {}
            ids, words, shingles = [], [], []
            for r, item in enumerate(b["item_id"].to_pylist()):
                lo, hi = int(w.first[r]), int(w.first[r + 1])
                size = min(window, hi - lo)
                if item is None or not size:
                    continue
                k = min(shingle, size)
                if k not in grams:
                    grams[k] = w.grams(k)[0].view(np.int64)
                own = [w.text(i) for i in range(lo, hi)]
                for at in range(hi - lo - size + 1):
                    ids.append(item)
                    words.append(own[at : at + size])
                    shingles.append([{"at": j, "h": int(grams[k][lo + at + j])} for j in range(size - k + 1)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.string()),
                    pa.array(words, pa.list_(pa.string())),
                    pa.array(shingles, pa.list_(pa.struct([("at", pa.int32()), ("h", pa.int64())]))),
                ],
                ["item_id", "words", "shingles"],
            )

    return items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        make, "item_id string, words array<string>, shingles array<struct<at:int,h:bigint>>"
    )


HIT = "struct<at:int,h:bigint,new:boolean,from_word:int,words:array<string>>"


def shingle_hits(docs: DataFrame, windows: DataFrame, window: int, shingle: int) -> DataFrame:
    """doc_id, __key, n_words and the places where a shingle of the benchmark may stand, with the words around each."""
    flat = windows.select(F.explode("shingles").alias("s"), F.size("words").alias("size"))
    filters = flat.sparkSession.sparkContext.broadcast(bit_filter(flat.select(F.col("s.h").alias("h"))))
    sizes = [r[0] for r in windows.select(F.least(F.lit(shingle), F.size("words")).alias("k")).distinct().collect()]
    kind = pa.list_(pa.struct([("at", pa.int32()), ("h", pa.int64()), ("new", pa.bool_()), ("from_word", pa.int32()), ("words", pa.list_(pa.string()))]))

    def scan(batches):
        bits = np.frombuffer(filters.value, np.uint8)
        for b in parts(batches):
            w = split(b["text"], ALNUM)
            found: list[list] = [[] for _ in range(b.num_rows)]
            rows = w.row()
            for k in sizes:
                h, whole = w.grams(k)
                at = np.flatnonzero(whole & in_filter(bits, h))
                seen, shown = set(), {}
                for i in at.tolist():
                    r = int(rows[i])
                    lo, hi = max(int(w.first[r]), i - window + k), min(int(w.first[r + 1]), i + window)
                    for j in range(lo, hi):
                        if j not in shown:
                            shown[j] = w.text(j)
                    new = (r, h[i]) not in seen
                    seen.add((r, h[i]))
                    found[r].append({"at": i - int(w.first[r]), "h": int(h[i].view(np.int64)), "new": new, "from_word": lo - int(w.first[r]), "words": [shown[j] for j in range(lo, hi)]})
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["__key"], pa.array(w.count(), pa.int64()), pa.array(found, kind)], ["doc_id", "__key", "n_words", "hits"])

    slim = docs.select("doc_id", text_key().alias("__key"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(scan, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, __key bigint, n_words bigint, hits array<{HIT}>")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Per row of docs: doc_id, __key, n_words, n_hit, items (sorted ids), hit_words (their places)."""
    windows = cut(item_windows(items, window, shingle))
    base = cut(shingle_hits(docs, windows, window, shingle))
    hits = base.where(F.size("hits") > 0).select("doc_id", "__key", "n_words", F.explode("hits").alias("hit"))
    rarity = hits.where("hit.new").groupBy(F.col("hit.h").alias("h")).agg(F.count("*").alias("n_docs"))
    distinct = windows.groupBy("words").agg(F.first("shingles").alias("shingles"))
    prefix = (
        distinct.select("words", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
        .join(rarity, F.col("s.h") == rarity["h"])
        .groupBy("words")
        .agg(F.count("*").alias("there"), F.max("n").alias("n"), F.min_by("s", F.struct("n_docs", "s.at")).alias("s"))
        .where("there = n")
        .select("words", F.col("s.at").alias("offset"), F.col("s.h").alias("h"))
    )
    start = F.col("hit.at") - F.col("offset")
    size = F.size("words")
    matches = (
        hits.join(prefix, F.col("hit.h") == prefix["h"])
        .where((start >= F.col("hit.from_word")) & (start + size <= F.col("n_words")))
        .where(F.slice("hit.words", start - F.col("hit.from_word") + 1, size) == F.col("words"))
        .select("doc_id", "__key", start.alias("start"), size.alias("size"), "words")
        .distinct()
    )
    matches = cut(matches)
    keys = ("doc_id", "__key")
    places = (
        matches.select(*keys, F.explode(F.sequence("start", F.col("start") + F.col("size") - 1)).alias("at"))
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_set("at")).alias("hit_words"))
    )
    named = (
        matches.select(*keys, "words").distinct().join(windows.select("words", "item_id").distinct(), "words").groupBy(*keys).agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    found = places.alias("p").join(named.alias("n"), F.expr("p.doc_id <=> n.doc_id AND p.__key = n.__key")).select("p.doc_id", "p.__key", "hit_words", "items")
    return base.drop("hits").alias("b").join(found.alias("f"), F.expr("b.doc_id <=> f.doc_id AND b.__key = f.__key"), "left").select(
        "b.doc_id",
        "b.__key",
        "n_words",
        F.coalesce(F.size("hit_words"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("hit_words", F.array().cast("array<int>")).alias("hit_words"),
    )


def op1_decontaminate(spark, sf_dir) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return decontaminate(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of docs without any benchmark window, with all their columns."""
    bad = decontaminate(docs, items, **options).where("n_hit > 0").select(F.col("doc_id").alias("__id"), F.col("__key").alias("__k")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__id"]) & (text_key() == bad["__k"]), "left_anti")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE_SQL = f"""
WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
iw AS (SELECT DISTINCT item_id, least(10, len(w)) AS size, w[p:p + least(10, len(w)) - 1] AS win
  FROM i, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM iw),
dw AS (SELECT doc_id, size, p, w[p:p + size - 1] AS win FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS t(p) WHERE len(w) >= size),
m AS (SELECT doc_id, p, dw.size, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.size = iw.size),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM m, unnest(range(p, p + size)) AS t(q) GROUP BY doc_id),
g AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN g USING (doc_id)
"""
