"""Repeated passages removed by sharded Aho-Corasick automata.

A passage is a window of 13 words. Every window takes as its anchor the least
hash among its runs of five words, so equal windows have equal anchors. Blocks
of documents tell shards the hashes of their anchors, and shards answer which
occur in two documents; of windows with such anchors the blocks tell the
windows' own hashes, dealt by these, and learn which recur. What is left are
stretches of recurring windows, cut free of the words around them, so copies in
different contexts are alike; each distinct stretch of a block is sent once, to
the shard of its anchor. There full words confirm which windows recur, the word
sequences (rows of windows that stand in one stretch only, as one passage) are
compiled into an automaton (pyahocorasick), all stretches of all documents
stream through it, which locates every occurrence, and the answer is the first
document of each. Blocks then remove the words of windows that an earlier
document holds. Hashes only ever rule windows out; a false one costs time.
Whatever is common to many documents is one entry a block, so no group grows
with its number of copies.

Null texts have no words. A null doc_id is neither earlier than others nor loses
words. Rows sharing a doc_id are one document: they remove nothing from each
other. Each input row gives one output row; empty tables give empty results;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import _POWERS, SPACED, Words, mix, parts, split

WINDOW, ANCHOR = 13, 5
NONE = np.iinfo(np.int64).max


class Runs:
    """Runs of consecutive windows with one anchor in one row: windows start at word start..stop-1."""

    def __init__(self, w: Words, window: int = WINDOW, anchor: int = ANCHOR) -> None:
        n = len(w.hash) - window + 1
        grams, _ = w.grams(anchor)
        low, width = grams, 1
        while width < window - anchor + 1:
            step = min(width, window - anchor + 1 - width)
            low = np.minimum(low[:-step], low[step:])
            width += step
        rows = w.row()
        whole = rows[:n] == rows[window - 1 :] if n > 0 else np.zeros(0, bool)
        low, rows = low[: max(n, 0)], rows[: max(n, 0)]
        head = whole.copy()
        if n > 1:
            head[1:] &= (low[1:] != low[:-1]) | (rows[1:] != rows[:-1]) | ~whole[:-1]
        self.start = np.flatnonzero(head)
        at = np.flatnonzero(whole)
        self.stop = self.start + np.diff(np.append(np.searchsorted(at, self.start), len(at)))
        self.anchor, self.row = low[self.start], rows[self.start]
        up, down = _POWERS.get(len(w.hash) + 1)
        sums = np.zeros(len(w.hash) + 1, np.uint64)
        np.cumsum(w.hash * up[:-1], out=sums[1:])
        self._sums, self._down = sums, down

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the words from start to before end."""
        return mix((self._sums[end] - self._sums[start]) * self._down[start] + (end - start).astype(np.uint64))

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, run) of each window of these runs."""
        size = (self.stop - self.start)[which]
        run = np.repeat(which, size)
        return self.start[run] + np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size), run


def _ends(key: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, a place of each, its least lo, its greatest hi)."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    if not len(first):
        return key, order, lo, hi
    return key[first], order[first], np.minimum.reduceat(lo[order], first), np.maximum.reduceat(hi[order], first)


def _among(sorted_keys: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which keys are in a sorted, distinct list."""
    if not len(sorted_keys):
        return np.zeros(len(key), bool)
    return sorted_keys[np.minimum(np.searchsorted(sorted_keys, key), len(sorted_keys) - 1)] == key


def _table(names: str, kinds: list, columns: list) -> pa.Table:
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names.split())


def _pack(keys: np.ndarray) -> bytes:
    """The low 48 bits of each."""
    return np.ascontiguousarray(keys.view(np.uint16).reshape(-1, 4)[:, :3]).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 4), np.uint16)
    out[:, :3] = np.frombuffer(data, np.uint16).reshape(-1, 3)
    return out.view(np.uint64).ravel()


LOW = np.uint64((1 << 48) - 1)
I64, BIN, STR = pa.int64(), pa.binary(), pa.string()


def deduplicate(docs: DataFrame, block_docs: int = 1000, window: int = WINDOW, anchor: int = ANCHOR, text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the kept words joined by one space) or kept_sha256 per row of docs; doc_id must be an integer."""
    n_blocks = -(-docs.select("doc_id").count() // block_docs) or 1
    hash_shards, shards = -(-n_blocks // 8), -(-n_blocks // 2)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    judged = F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    blocks = slim.where(judged).select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).alias("block"), "doc_id", "text").groupBy("block")

    def read(table) -> tuple[Words, Runs, np.ndarray]:
        w = split(table["text"], SPACED)
        return w, Runs(w, window, anchor), table["doc_id"].combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)

    def shards_of(key: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
        shard = (key % np.uint64(n)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        shard = shard[order]
        edges = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])).tolist() if len(shard) else []
        for a, b in zip(edges, [*edges, len(shard)][1:], strict=True):
            yield int(shard[a]), order[a:b]

    def questions(key: np.ndarray, own: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(shard, distinct keys of one document of the block, those of several) for the keys of documents `own`."""
        keys, _, lo, hi = _ends(key & LOW, own, own)
        for s, i in shards_of(keys, hash_shards):
            many = lo[i] < hi[i]
            yield s, keys[i][~many], keys[i][many]

    def ask(block: int, key: np.ndarray, own: np.ndarray) -> pa.Table:
        out = [(s, block, _pack(one), _pack(many)) for s, one, many in questions(key, own)]
        return _table("shard block one many", [I64, I64, BIN, BIN], list(zip(*out, strict=True)) or [[]] * 4)

    def recurring(turn: int):
        """Bits that say which keys of one document others have too."""

        def answer(table):
            one, many = ([_unpack(x) for x in table[c].to_pylist()] for c in ("one", "many"))
            keys, times = np.unique(np.concatenate(one + many), return_counts=True)
            twice = keys[times > 1]
            out = [(b, s, turn, np.packbits(_among(twice, k)).tobytes()) for b, s, k in zip(table["block"].to_pylist(), table["shard"].to_pylist(), one, strict=True)]
            return _table("to_block shard turn bits", [I64, I64, I64, BIN], list(zip(*out, strict=True)))

        return answer

    def recur(key: np.ndarray, own: np.ndarray, answers: pa.Table, turn: int) -> np.ndarray:
        """Which keys, as asked before, recur."""
        bits = {s: b for s, t, b in zip(*(answers[c].to_pylist() for c in ("shard", "turn", "bits")), strict=True) if t == turn}
        known = [x for s, one, many in questions(key, own) for x in (many, one[np.unpackbits(np.frombuffer(bits[s], np.uint8))[: len(one)] == 1])]
        return _among(np.sort(np.concatenate(known)), key & LOW) if known else np.zeros(len(key), bool)

    def stretches(w: Words, runs: Runs, ids: np.ndarray, answers: pa.Table):
        """(first window, end of windows, anchor, row, hash) of the stretches of recurring windows, each within a run."""
        start, run = runs.windows(np.flatnonzero(recur(runs.anchor, ids[runs.row], answers, 1)))
        good = recur(runs.hash(start, start + window), ids[runs.row[run]], answers, 2)
        start, run = start[good], run[good]
        head = np.flatnonzero(np.append(True, (start[1:] != start[:-1] + 1) | (run[1:] != run[:-1]))) if len(start) else np.zeros(0, np.int64)
        begin, run = start[head], run[head]
        stop = begin + np.diff(np.append(head, len(start)))
        return begin, stop, runs.anchor[run], runs.row[run], runs.hash(begin, stop + window - 1)

    def send_anchors(key, table):
        _, runs, ids = read(table)
        return ask(key[0].as_py(), runs.anchor, ids[runs.row])

    def send_windows(key, table, answers):
        if not table.num_rows:
            return ask(0, np.zeros(0, np.uint64), np.zeros(0, np.int64))
        _, runs, ids = read(table)
        start, run = runs.windows(np.flatnonzero(recur(runs.anchor, ids[runs.row], answers, 1)))
        return ask(key[0].as_py(), runs.hash(start, start + window), ids[runs.row[run]])

    def send_stretches(key, table, answers):
        out = []
        if table.num_rows and answers.num_rows:
            w, runs, ids = read(table)
            begin, stop, anchors, row, name = stretches(w, runs, ids, answers)
            name, at, lo, hi = _ends(name, ids[row], ids[row])
            first, last = w.start[begin[at]], w.end[stop[at] + window - 2]
            raw = w.raw.tobytes()
            for s, i in shards_of(anchors[at], shards):
                text = b"\n".join(b" ".join(raw[a:b].split()) for a, b in zip(first[i].tolist(), last[i].tolist(), strict=True))
                out.append((s, key[0].as_py(), name[i].tobytes(), lo[i].tobytes(), hi[i].tobytes(), text))
        return _table("shard block segments lo hi text", [I64, I64, BIN, BIN, BIN, BIN], list(zip(*out, strict=True)) or [[]] * 6)

    def locate(table):
        blocks_of = table["block"].to_pylist()
        name = [np.frombuffer(x, np.uint64) for x in table["segments"].to_pylist()]
        lo = np.concatenate([np.frombuffer(x, np.int64) for x in table["lo"].to_pylist()])
        hi = np.concatenate([np.frombuffer(x, np.int64) for x in table["hi"].to_pylist()])
        texts: dict[bytes, int] = {}
        which = np.array([texts.setdefault(t, len(texts)) for x in table["text"].to_pylist() for t in x.split(b"\n")])
        first, last = np.full(len(texts), NONE), np.full(len(texts), -NONE)
        np.minimum.at(first, which, lo)
        np.maximum.at(last, which, hi)
        # one character a word (two if a shard has more words than characters), so that texts and passages are strings
        split_up = [t.split(b" ") for t in texts]
        word = {x: i for i, x in enumerate({x for t in split_up for x in t})}
        width = 1 if len(word) < 0x110000 else 2
        word = {x: chr(i) if width == 1 else chr(i >> 20) + chr(i & 0xFFFFF) for x, i in word.items()}
        sequences = ["".join([word[x] for x in t]) for t in split_up]
        del split_up
        size = np.array([len(s) for s in sequences]) // width
        begins = np.cumsum(size) - size
        flat = np.frombuffer("".join(sequences).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        if width == 2:
            flat = (flat[::2] << np.uint64(20)) + flat[1::2]
        owner = np.repeat(np.arange(len(size)), size)
        # confirm: a window recurs if the segments that hold it belong to two documents
        n = len(flat) - window + 1
        h = flat[:n].copy()
        for j in range(1, window):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15)) + flat[j : j + n]
        at = np.flatnonzero(owner[:n] == owner[window - 1 :])
        order = np.argsort(h[at], kind="stable")
        at = at[order]
        first_of = np.flatnonzero(np.append(True, h[at[1:]] != h[at[:-1]]))
        times = np.diff(np.append(first_of, len(at)))
        recurs = np.minimum.reduceat(first[owner[at]], first_of) < np.maximum.reduceat(last[owner[at]], first_of)
        # passages: each window that stands in several places, and each longest row of windows that stand in one segment only
        several = at[first_of[recurs & (times > 1)]]
        single = np.sort(at[first_of[recurs & (times == 1)]])
        row = np.flatnonzero(np.append(True, (np.diff(single) != 1) | np.diff(owner[single]).astype(bool))) if len(single) else np.zeros(0, np.int64)
        starts = np.concatenate([several, single[row]])
        windows = np.concatenate([np.ones(len(several), np.int64), np.diff(np.append(row, len(single)))])
        if not len(starts):
            return _table("to_block segments from till first", [I64, BIN, BIN, BIN, BIN], [[]] * 5)
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for p, (i, o, k) in enumerate(zip((starts - begins[owner[starts]]).tolist(), owner[starts].tolist(), (windows + window - 1).tolist(), strict=True)):
            automaton.add_word(sequences[o][i * width : (i + k) * width], p)
        automaton.make_automaton()
        hits = [(s, end, p) for s, words in enumerate(sequences) for end, p in automaton.iter(words) if width == 1 or end % 2]
        seg, end, passage = (np.array(c, np.int64) for c in zip(*hits, strict=True))
        start = end // width + 1 - (windows + window - 1)[passage]
        earliest = np.full(len(starts), NONE)
        np.minimum.at(earliest, passage, first[seg])
        begun, till = earliest[passage], start + windows[passage]
        order = np.lexsort((start, seg))
        seg, start, till, begun = seg[order], start[order], till[order], begun[order]
        # windows side by side with one first document are one range
        new = np.append(True, (seg[1:] != seg[:-1]) | (start[1:] != till[:-1]) | (begun[1:] != begun[:-1]))
        a = np.flatnonzero(new)
        from_, till, seg, begun = start[a], till[np.append(a[1:], len(seg)) - 1], seg[a], begun[a]
        edge = np.searchsorted(seg, np.arange(len(texts) + 1))
        out, done = [], 0
        for b, names in zip(blocks_of, name, strict=True):
            mine, top = which[done : done + len(names)], hi[done : done + len(names)]
            done += len(names)
            count = edge[mine + 1] - edge[mine]
            which_name = np.repeat(np.arange(len(names)), count)
            r = np.repeat(edge[mine], count) + np.arange(len(which_name)) - np.repeat(np.cumsum(count) - count, count)
            late = begun[r] < top[which_name]
            r, which_name = r[late], which_name[late]
            if len(r):
                out.append((b, names[which_name].tobytes(), from_[r].astype(np.int32).tobytes(), till[r].astype(np.int32).tobytes(), begun[r].tobytes()))
        return _table("to_block segments from till first", [I64, BIN, BIN, BIN, BIN], list(zip(*out, strict=True)) or [[]] * 5)

    def kept_words(w: Words, gone: np.ndarray) -> pa.Table:
        removed = np.diff(np.append(0, np.cumsum(gone))[w.first])
        raw, kept = w.raw.tobytes(), []
        for r, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)):
            words = raw[w.start[a] : w.end[b - 1]].split() if b > a else []
            if removed[r]:
                words = [x for x, g in zip(words, gone[a:b].tolist(), strict=True) if not g]
            joined = b" ".join(words)
            kept.append(joined.decode("utf-8", "replace") if text else hashlib.sha256(joined).hexdigest())
        return _table("n_words n_removed kept", [I64, I64, STR], [w.count(), removed, kept])

    def remove(key, table, answers):
        if not table.num_rows:
            return _table("doc_id n_words n_removed kept", [I64, I64, I64, STR], [[]] * 4)
        w, runs, ids = read(table)
        cover = np.zeros(len(w.hash) + 1, np.int64)
        found = answers.filter(pa.compute.is_valid(answers["segments"]))
        if found.num_rows:
            begin, _, _, row, own = stretches(w, runs, ids, answers)
            name, from_, till, first = (np.concatenate([np.frombuffer(x, k) for x in found[c].to_pylist()]) for c, k in (("segments", np.uint64), ("from", np.int32), ("till", np.int32), ("first", np.int64)))
            order = np.argsort(name, kind="stable")
            name, from_, till, first = name[order], from_[order], till[order], first[order]
            a, b = np.searchsorted(name, own, "left"), np.searchsorted(name, own, "right")
            which = np.repeat(np.arange(len(own)), b - a)
            r = np.repeat(a, b - a) + np.arange(len(which)) - np.repeat(np.cumsum(b - a) - (b - a), b - a)
            late = first[r] < ids[row[which]]
            r, which = r[late], which[late]
            np.add.at(cover, begin[which] + from_[r], 1)
            np.add.at(cover, begin[which] + till[r] + window - 1, -1)
        return kept_words(w, np.cumsum(cover[:-1]) > 0).add_column(0, "doc_id", table["doc_id"])

    def as_they_are(batches):
        for b in parts(batches):
            w = split(b["text"], SPACED)
            yield from kept_words(w, np.zeros(len(w.hash), bool)).add_column(0, "doc_id", b["doc_id"]).to_batches()

    asked, bits, out = "shard long, block long, one binary, many binary", "to_block long, shard long, turn long, bits binary", "doc_id long, n_words long, n_removed long, kept string"
    one = blocks.applyInArrow(send_anchors, asked).groupBy("shard").applyInArrow(recurring(1), bits)
    two = blocks.cogroup(one.groupBy("to_block")).applyInArrow(send_windows, asked).groupBy("shard").applyInArrow(recurring(2), bits)
    both = one.unionByName(two)
    sent = blocks.cogroup(both.groupBy("to_block")).applyInArrow(send_stretches, "shard long, block long, segments binary, lo binary, hi binary, text binary")
    found = sent.groupBy("shard").applyInArrow(locate, "to_block long, segments binary, from binary, till binary, first binary")
    every = both.unionByName(found, allowMissingColumns=True)
    kept = blocks.cogroup(every.groupBy("to_block")).applyInArrow(remove, out).unionByName(slim.where(~judged).mapInArrow(as_they_are, out))
    return kept.withColumnRenamed("kept", "kept" if text else "kept_sha256")


def op5_substring_dedup(spark, sf_dir) -> DataFrame:
    return deduplicate(spark.read.parquet(f"{sf_dir}/documents.parquet"), text=False)


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, i, w[i:i + 12] AS win FROM d, unnest(range(1, len(w) - 11)) AS t(i) WHERE len(w) >= 13),
f AS (SELECT win, min(doc_id) AS first FROM g GROUP BY win HAVING min(doc_id) < max(doc_id)),
c AS (SELECT DISTINCT g.doc_id, p FROM g JOIN f ON g.win = f.win AND f.first < g.doc_id, unnest(range(i, i + 13)) AS t(p)),
k AS (SELECT doc_id, count(*) AS n, list(p) AS ps FROM c GROUP BY doc_id),
e AS (SELECT d.doc_id, w, coalesce(n, 0) AS n_removed, p FROM d LEFT JOIN k USING (doc_id), unnest(range(1, len(w) + 1)) AS t(p)),
r AS (SELECT e.doc_id, string_agg(w[e.p], ' ' ORDER BY e.p) AS kept FROM e LEFT JOIN c ON c.doc_id = e.doc_id AND c.p = e.p WHERE c.p IS NULL GROUP BY e.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(k.n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN r USING (doc_id)
"""
