"""The pipeline, stage by stage, against brute force on the smallest tables."""

import re
from collections import Counter

import pytest
from test_operators import brute_decontaminate, brute_near, brute_pii

import corpus_pipeline
from pointmill.llm import packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10**6, None, None, None, 0), (10**6 + 1, "", "en", "s", 0)], docs.schema)
    out = [("documents", docs.union(extra).cache())]
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, stage(spark, out[-1][1], SF).cache()))
    return dict(out)


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_order_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontaminate", "pii", "packing"]
    assert all(steps[n].columns == steps["documents"].columns for n in ("toxicity", "near_dedup", "decontaminate", "pii"))


def test_toxic_documents_go(spark, steps):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {i for i, _ in rows(steps["toxicity"])}
    seen = [(i, labels[i]) for i, _ in rows(steps["documents"]) if i in labels]
    assert sum((i in kept) == (not y) for i, y in seen) >= 0.9 * len(seen)
    assert {10**6, 10**6 + 1} <= kept


def test_one_of_each_group_stays(steps):
    before = rows(steps["toxicity"])
    groups = brute_near(before, 5, 80)
    assert Counter(rows(steps["near_dedup"])) == Counter((i, t) for i, t in before if groups[i] == i)


def test_contaminated_documents_go(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = rows(steps["near_dedup"])
    hit = {k[0] for k in brute_decontaminate(before, items) if k[2]}
    assert {i for i, _ in rows(steps["decontaminate"])} == {i for i, _ in before} - hit


def test_personal_data_goes(steps):
    after = dict(rows(steps["pii"]))
    for i, t in rows(steps["decontaminate"]):
        spans = brute_pii(t)
        if spans:
            assert "[" in after[i] and not any(t[a:b] in after[i] for a, _, b in spans)
        elif t:
            # only revealing terms may be missing
            assert len(after[i]) <= len(t) and set(re.findall(r"\w+", after[i])) <= set(re.findall(r"\w+", t))
        else:
            assert after[i] == t


def test_every_token_is_packed_once(steps):
    encoder = packing.public_encoder()
    length = {i: len(encoder.exact.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in rows(steps["pii"])}
    got, places = Counter(), {}
    for r in steps["packing"].collect():
        got[r.doc_id] += r.length
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == length
    for own in places.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 2048
    assert len(places) <= -(-sum(length.values()) // 2048) * 1.05 + 1
