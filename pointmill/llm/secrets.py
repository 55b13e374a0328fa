"""Secret scans judged by how widely each candidate is owned.

Three base kinds (assignments, access keys, long hex runs) are found in every
whole text, and with them "opaque" candidates: long mixed tokens of high
entropy. Each candidate's hash is aggregated over the corpus to its number of
distinct owners (source) and repositories (source and lang). A candidate with
several owners is a copied example; one with a single owner looks live. Opaque
tokens become spans only if they look live; base spans always stay.

Null or empty texts have no spans; a null source or lang is an owner of its own;
every input row gives one output row, repeated rows and null ids included; empty
tables give empty results; other columns are ignored. Positions are code points,
ends exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spark_tools import cut, join_counted, text_key
from .words import parts

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
#: Whole runs, so a minimal length in the pattern drops the same matches as a later test.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
OPAQUE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
KINDS = ("assign", "access", "hex", "opaque")


def entropy(token: str) -> float:
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values())


def candidates(text: str | None, min_entropy: float = 3.5) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, secret) by start, then kind."""
    if not text:
        return []
    found = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    taken = sorted((a, b) for a, _, b, _ in found)
    for m in OPAQUE.finditer(text):
        t = m[0]
        if any(c.isdigit() for c in t) and any(c.islower() for c in t) and any(c.isupper() for c in t) and entropy(t) >= min_entropy and not any(a < m.end() and m.start() < b for a, b in taken):
            found.append((m.start(), 3, m.end(), t))
    return sorted(found)


SPAN = "struct<start:int,kind:int,end:int,h:bigint>"


def scan(docs: DataFrame, min_entropy: float = 3.5) -> DataFrame:
    """doc_id, __key, owner, repo, spans (all candidates) per input row."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("h", pa.int64())]))

    def find(batches):
        for b in parts(batches):
            spans = [
                [{"start": s, "kind": k, "end": e, "h": int.from_bytes(hashlib.blake2b(v.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)} for s, k, e, v in candidates(t, min_entropy)]
                for t in b["text"].to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["__key"], b["owner"], b["repo"], pa.array(spans, kind)], ["doc_id", "__key", "owner", "repo", "spans"])

    owner = F.coalesce(F.col("source").cast("string"), F.lit(""))
    slim = docs.select("doc_id", text_key().alias("__key"), owner.alias("owner"), F.concat_ws("/", owner, F.col("lang").cast("string")).alias("repo"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(find, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, __key bigint, owner string, repo string, spans array<{SPAN}>")


def ownership(found: DataFrame) -> DataFrame:
    """h, n_owners, n_repos, n_seen of each candidate; pre-aggregated per owner and repository, so a hot candidate is a few rows."""
    return (
        found.select("owner", "repo", F.explode("spans.h").alias("h"))
        .groupBy("h", "owner", "repo")
        .agg(F.count("*").alias("n"))
        .groupBy("h", "owner")
        .agg(F.sum("n").alias("n"), F.count("*").alias("repos"))
        .groupBy("h")
        .agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"), F.sum("n").alias("n_seen"))
    )


def scan_secrets(docs: DataFrame, max_owners: int = 1, min_entropy: float = 3.5) -> DataFrame:
    """Per row: doc_id, spans array<struct<start,kind,end,live,n_owners,n_repos>> with opaque ones only if live."""
    found = cut(scan(docs, min_entropy))
    owned = cut(ownership(found))
    each = found.where(F.size("spans") > 0).select("doc_id", "__key", "owner", "repo", F.explode("spans").alias("s")).withColumn("h", F.col("s.h"))
    judged = (
        join_counted(each, owned, "h", "n_seen")
        .where((F.col("s.kind") < 3) | (F.col("n_owners") <= max_owners))
        .groupBy("doc_id", "__key", "owner", "repo")
        .agg(
            F.array_sort(
                F.collect_set(F.struct("s.start", "s.kind", "s.end", (F.col("n_owners") <= max_owners).alias("live"), "n_owners", "n_repos"))
            ).alias("judged")
        )
    )
    return (
        found.alias("f")
        .join(judged.alias("j"), F.expr("f.doc_id <=> j.doc_id AND f.__key = j.__key AND f.owner = j.owner AND f.repo = j.repo"), "left")
        .select("f.doc_id", F.coalesce("judged", F.array().cast("array<struct<start:int,kind:int,end:int,live:boolean,n_owners:bigint,n_repos:bigint>>")).alias("spans"))
    )


def op4_secrets(spark, sf_dir) -> DataFrame:
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    names = F.array(*[F.lit(k) for k in KINDS])
    said = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")
    base = F.filter("spans", lambda x: x["kind"] < 3)
    count = lambda test: F.size(F.filter("spans", test)).cast("long")
    of_kind = lambda k: count(lambda x: x["kind"] == k)  # noqa: E731  a lambda with a second parameter would get the index there
    return found.select(
        "doc_id",
        *[of_kind(k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(said(base), 256).alias("base_sha256"),
        said(F.col("spans")).alias("spans"),
        count(lambda x: x["live"]).alias("n_live"),
        count(lambda x: ~x["live"]).alias("n_example"),
    )
