"""Each pipeline stage on hostile tables: repeated rows, null ids and columns, empty and very long texts, ties, clashing names, no rows."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from pointmill.llm import packing

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, words string, h long, key long, id string, n int, spans string, start long"
STAGES = dict(corpus_pipeline.STAGES)
rng = random.Random(21)


def prose(n):
    return " ".join("".join(rng.choice("bcdfghjklmnpr") + rng.choice("aeiou") for _ in range(rng.randrange(2, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def hostile(spark):
    """(rows of (doc_id, text), DataFrame)."""
    item = next(r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect() if r.text and len(r.text.split()) >= 12)
    long, copy = prose(60_000), prose(120)
    mail = prose(20) + " write to someone.else@mail.example.org " + prose(20)
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, copy), (5, copy), (5, copy), (6, prose(40)), (6, prose(40)), (None, copy), (None, prose(30)), (None, None)]
    texts += [(7, long), (8, long + " tail"), (9, prose(15) + " " + item), (10, mail), (11, "word"), (12, "word"), (13, "!!! ... ???")]
    texts = [(None if i is None else i + 10**7, t) for i, t in texts]
    rows = [(i, t, rng.choice(["en", None]), rng.choice(["s", None]), None if t is None else len(t), 0.5, "w", 1, 2, "i", 3, "x", 4) for i, t in texts]
    return texts, spark.createDataFrame(rows, SCHEMA).repartition(4)


def left(df):
    return Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


@pytest.mark.parametrize("name", list(STAGES))
def test_no_rows_give_no_rows(spark, hostile, name):
    out = STAGES[name](spark, hostile[1].limit(0), SF)
    assert out.count() == 0 and (name == "packing" or out.columns == hostile[1].columns)


def test_without_labels_of_its_ids_nothing_is_toxic(spark, hostile):
    out = STAGES["toxicity"](spark, hostile[1], SF)
    assert out.columns == hostile[1].columns and left(out) == Counter(hostile[0])


def test_copies_go_but_rows_of_one_id_and_null_ids_stay(spark, hostile):
    out = STAGES["near_dedup"](spark, hostile[1], SF)
    gone = {10**7 + 5, 10**7 + 8, 10**7 + 12}
    assert out.columns == hostile[1].columns and left(out) == Counter((i, t) for i, t in hostile[0] if i not in gone)


def test_passages_of_the_benchmark_go(spark, hostile):
    out = STAGES["decontaminate"](spark, hostile[1], SF)
    assert out.columns == hostile[1].columns and left(out) == Counter((i, t) for i, t in hostile[0] if i != 10**7 + 9)


def test_personal_data_is_generalised_and_all_rows_stay(spark, hostile):
    out = STAGES["pii"](spark, hostile[1], SF)
    got = left(out)
    assert out.columns == hostile[1].columns and Counter(i for i, _ in got.elements()) == Counter(i for i, _ in hostile[0])
    changed = [t for i, t in got if i == 10**7 + 10]
    assert len(changed) == 1 and "@" not in changed[0] and "[" in changed[0]
    assert all(got[i, t] for i, t in hostile[0] if i != 10**7 + 10 and (not t or len(t) < 10))
    sizes = {r.doc_id: (r.n_chars, r.text) for r in out.collect() if r.doc_id == 10**7 + 10}
    assert all(n == len(t) for n, t in sizes.values())


def test_every_row_is_packed(spark, hostile):
    out = STAGES["packing"](spark, hostile[1], SF)
    encoder = packing.public_encoder()
    want = Counter()
    for i, t in hostile[0]:
        want[i] += len(encoder.exact.encode(t or "", add_special_tokens=False).ids) + 1
    got, places = Counter(), {}
    for r in out.collect():
        got[r.doc_id] += r.length
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    for own in places.values():
        own.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False)) and own[0][0] == 0 and sum(own[-1]) <= 2048
