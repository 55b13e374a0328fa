"""Repeated byte strings against brute force, in both modes, with whole and split groups."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from pointmill.llm import suffix_dedup

rng = random.Random(3)


def brute(rows, window, keep_first):
    """Counter of (doc_id, n_bytes, n_removed, n_spans, kept) for rows (doc_id, text)."""
    texts = [(t or "").encode() for _, t in rows]
    seen = {}
    for k, t in enumerate(texts):
        for i in range(len(t) - window + 1):
            seen.setdefault(t[i : i + window], []).append((k, i))
    out = Counter()
    for k, t in enumerate(texts):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - window + 1):
            places = seen[t[i : i + window]]
            if keep_first:
                hit = any((rows[q][0], j) < (rows[k][0], i) for q, j in places)
            else:
                hit = len(places) > 1
            if hit:
                gone[i : i + window] = True
        spans = int((gone[:-1] & ~np.append(False, gone[:-2])).sum()) if len(t) else 0
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        out[rows[k][0], len(t), int(gone.sum()), spans, kept] += 1
    return out


def ask(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, source string, start int").repartition(3)
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.deduplicate(docs, **options).collect())


def some_rows():
    word = lambda n: "".join(rng.choice("abcdé") for _ in range(n))
    shared, phrase = [word(30), word(14), word(60)], word(9)
    rows = [(i, word(rng.randrange(0, 40)) + (rng.choice(shared) if i % 3 == 0 else "") + word(rng.randrange(40)) + phrase + word(rng.randrange(30))) for i in range(60)]
    rows += [(100, "ab" * 60), (101, "a" * 90), (102, None), (103, ""), (104, shared[0]), (105, shared[0]), (106, "xyz" * 3), (107, word(20) + shared[1] * 3)]
    return rows


@pytest.mark.parametrize("most", [2000, 2])
@pytest.mark.parametrize("keep_first", [False, True])
def test_matches_brute_force(spark, most, keep_first):
    rows = some_rows()
    assert ask(spark, rows, window=12, keep_first=keep_first, most=most) == brute(rows, 12, keep_first)


def test_rows_alike_null_ids_and_empty_tables(spark):
    rows = [(1, "q" * 5 + "lorem ipsum dolor"), (1, "q" * 5 + "lorem ipsum dolor"), (None, "lorem ipsum dolor sit"), (None, None), (3, "short")]
    assert ask(spark, rows, window=10) == brute(rows, 10, False)
    first = ask(spark, rows, window=10, keep_first=True)
    assert first[None, 21, 0, 0, b"lorem ipsum dolor sit"] == 1 and first[1, 22, 17, 1, b"qqqqq"] == 2
    assert ask(spark, [], window=10) == Counter()


def test_long_texts_are_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 50)
    part = "".join(rng.choice("abcdefgh") for _ in range(700))
    rows = [(1, part), (2, "zz" + part[100:650] + "z"), (3, part[::-1])]
    texts = [t.encode() for _, t in rows]
    found = set()
    for block in suffix_dedup.pieces(texts, 40, 10):
        for row, a, z, first, last in block:
            at, _ = suffix_dedup.anchors_of(np.frombuffer(texts[row][a:z], np.uint8), np.array([first - a]), np.array([last - a]), 40, 10)
            found |= {(row, a + int(i)) for i in at}
    whole = {(r, int(i)) for r, t in enumerate(texts) for i in suffix_dedup.anchors_of(np.frombuffer(t, np.uint8), np.array([0]), np.array([len(t) - 39]), 40, 10)[0]}
    assert found == whole
    assert ask(spark, rows, window=40) == brute(rows, 40, False)


@pytest.mark.parametrize("window", [1, 5, 8, 13])
def test_longest_previous_factors_of_one_text(window):
    for size, letters in ((300, 2), (200, 4), (60, 1)):
        data = np.array([rng.randrange(letters) for _ in range(size)], np.uint8)
        room = np.arange(size, 0, -1)
        at, factor, source = suffix_dedup.longest_previous(data, room, np.arange(size), window)
        text = data.tobytes()
        want = {i for i in range(size - window + 1) if text.find(text[i : i + window]) < i}
        assert {int(i) for i, f in zip(at, factor, strict=True) if f >= window} == want
        for i, f, j in zip(at, factor, source, strict=True):
            assert f < window or (j < i and text[j : j + window] == text[i : i + window])


def test_op12(spark, tmp_path):
    passage = "".join(rng.choice("abcdefgh ") for _ in range(900))
    rows = [(i, "".join(rng.choice("klmnop ") for _ in range(rng.randrange(900))) + (passage[i % 50 : 500 + i % 300] if i % 4 == 0 else "")) for i in range(50)]
    rows += [(60, None), (61, ""), (62, passage), (62, passage), (None, passage[:450]), (63, "é" * 500), (64, passage[:399])]
    spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_bytes int").write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r) for r in suffix_dedup.op12_suffix_dedup(spark, str(tmp_path)).collect())
    assert got == Counter({(*k[:4], hashlib.sha256(k[4]).hexdigest()): n for k, n in brute(rows, 400, False).items()})


def test_what_many_rows_share_is_ranked_once(monkeypatch):
    """Rows around one core: the same factors as without that knowledge, and fewer places to sort than there are bytes."""
    letters = lambda n: bytes(rng.choice(b"abcdefgh ") for _ in range(n))
    core, sides = letters(300), [letters(100) for _ in range(8)]
    rows = [rng.choice(sides) + core + rng.choice(sides) for _ in range(60)]
    data = np.frombuffer(b"".join(rows), np.uint8)
    row, offset = np.divmod(np.arange(len(data)), 500)
    shared = np.where(offset >= 100, np.maximum(400 - offset, 0), 0)
    first = np.where(shared > 0, offset, np.arange(len(data)))
    sorted_ones, unique = [], np.unique
    monkeypatch.setattr(suffix_dedup.np, "unique", lambda key, **options: sorted_ones.append(len(key)) or unique(key, **options))
    at, factor, source = suffix_dedup.longest_previous(data, 500 - offset, np.arange(len(data)), 400)
    plain, sorted_ones[:] = sum(sorted_ones), []
    assert plain < 4 * len(data)  # doubling wherever there was room took 5.3 times the bytes
    got = suffix_dedup.longest_previous(data, 500 - offset, np.arange(len(data)), 400, first, shared)
    assert sum(sorted_ones) < 0.6 * plain
    assert [v.tolist() for v in got] == [at.tolist(), factor.tolist(), source.tolist()]
    text, want = data.tobytes(), set()
    for r, k in zip(row, offset, strict=True):
        i = 500 * int(r) + int(k)
        if k <= 100 and any(text[500 * q + k : 500 * q + k + 400] == text[i : i + 400] for q in range(r)):
            want.add(i)
    assert {int(i) for i, f in zip(at, factor, strict=True) if f >= 400} == want
    assert all(text[j : j + 400] == text[i : i + 400] and j < i for i, f, j in zip(at, factor, source, strict=True) if f)
    wanted = row == 7
    some = suffix_dedup.longest_previous(data, 500 - offset, np.arange(len(data)), 400, first, shared, wanted)
    alike = {text[i : i + 400] for i in at[wanted[at]]}
    assert set(some[0].tolist()) == {int(i) for i in at if text[i : i + 400] in alike}


def test_places_that_are_the_same_are_no_copies():
    """Two rows of one text that overlap, and a third text: only its string is a copy of another place."""
    part = bytes(rng.choice(b"abcdefgh") for _ in range(40))
    data = np.frombuffer(part + part[5:] + part[10:35], np.uint8)
    room = np.concatenate([np.arange(k, 0, -1) for k in (40, 35, 25)])
    place = np.concatenate([np.arange(40), np.arange(5, 40), 1000 + np.arange(25)])
    at, factor, source = suffix_dedup.longest_previous(data, room, place, 12)
    assert {int(i) for i in at[factor >= 12]} == {75 + k for k in range(14)}
    assert {int(place[i]) for i in source[factor >= 12]} == set(range(10, 24))


@pytest.mark.parametrize("window", [1, 3, 8, 25, 400])
def test_ranks_by_twos_where_three_do_not_fit(window):
    """A shard of over 2**21 bytes, nearly all without a string, gives the factors of the part that has them."""
    few = "".join(rng.choice("ab") for _ in range(150)) * 6
    data = np.frombuffer(few.encode(), np.uint8)
    room = np.arange(len(data), 0, -1)
    at, factor, source = suffix_dedup.longest_previous(data, room, np.arange(len(data)), window)
    more = 1 << 21
    wide = suffix_dedup.longest_previous(np.append(np.zeros(more, np.uint8), data), np.append(np.zeros(more, np.int64), room), np.arange(more + len(data)), window)
    assert [v.tolist() for v in wide] == [(at + more).tolist(), factor.tolist(), np.where(source >= 0, source + more, -1).tolist()]
    assert {int(i) for i, f in zip(at, factor, strict=True) if f >= window} == {i for i in range(len(few) - window + 1) if few.find(few[i : i + window]) < i}
