"""The Merkle manifest against a plain tree."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pointmill.llm import manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row):
    return h(*map(field, row))


def grow(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        first = i - i % 3
        out.append(("".join(level[first:i]), "".join(level[i + 1 : first + 3])))
        i //= 3
    return out


def brute(rows):
    """Counter of (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of rows (doc_id, source, lang, n_chars, text)."""
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append(r)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        sources[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: grow([leaf(r) for r in sources[s]]) for s in names}
    top = grow([trees[s][-1][0] for s in names])
    out = Counter()
    for k, s in enumerate(names):
        for i, r in enumerate(sources[s]):
            steps = path(trees[s], i) + path(top, k)
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            node = leaf((*r[:4], r[4].replace("\n", "")) if bad else r)
            for a, b in steps:
                node = h(a, node, b)
            out[r[0], leaf(r), trees[s][-1][0], top[-1][0], h("".join(a + b for a, b in steps)), node, node == top[-1][0]] += 1
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, node string, tree int"


def ask(spark, rows, place):
    spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5).write.mode("overwrite").parquet(f"{place}/documents.parquet")
    got = manifest.op13_merkle(spark, place)
    return Counter(tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in got.collect())


def test_op13_matches_a_plain_tree(spark, tmp_path):
    rows = [(i, ["hot", None, "ü", "", "-"][0 if i % 3 == 0 else i % 5], None if i % 7 == 0 else "en", None if i % 11 == 0 else i, None if i % 13 == 0 else "a\nb" * (i % 4)) for i in range(300)]
    rows += [(None, "hot", None, None, None), (None, None, "de", 3, "x\ny"), (7, "alone", "en", 1, "y" * 5000 + "\n")]
    rows += [rows[3], rows[3], rows[1], (9, "hot", "en", 9, "tie")]
    want = brute(rows)
    assert ask(spark, rows, str(tmp_path)) == want
    assert {k[-1] for k in want} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 4])
def test_op13_of_few_rows(spark, tmp_path, n):
    rows = [(i, "s", "en", 1, f"{i}\n") for i in range(n)]
    assert ask(spark, rows, str(tmp_path)) == (brute(rows) if n else Counter())


def test_stored_levels_do_not_change_the_root(spark):
    docs = spark.createDataFrame([(i, "s" if i % 4 else "t", "en", 1, f"{i}", "", 0) for i in range(100)], SCHEMA)
    made = {k: manifest.manifest(docs, k) for k in (1, 2, 4)}
    assert len({m.root().first().root for m in made.values()}) == 1
    assert len(made[1].sources.stored) == 5 and len(made[4].sources.stored) == 2
    assert made[2].sources.stored[1].groupBy("tree").agg(F.count("*").alias("n")).orderBy("tree").collect()[0].n == 9
