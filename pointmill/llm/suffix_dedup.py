"""Repeated byte strings by longest-previous-factor arrays over sharded suffix arrays.

A string of `window` bytes repeats if it also starts elsewhere, in the same text
or another. Of every `window - gram + 1` neighbouring grams the leftmost one of
least hash is an anchor, so equal strings hold equal anchors at equal places. An anchor's segment is its text
from `window - gram` bytes before it to `window` bytes after its start; every
string that holds it lies in there. Segments alike are one entry with a count, so
copies never gather: where a segment occurs several times all its strings repeat,
without a look at the text. The strings of a segment fall into two halves, by how
far before the anchor they start; those of a half share a core, and only halves
whose core another segment has need more. They are cut out of the texts and dealt
over shards by core. A shard leaves out what has no string with the same hash at
another place, and sorts the suffixes of the rest, ties by place. Common prefixes
count only if they reach `window` bytes, so a suffix's longest previous factor is
that with the one before it in that order, and there is its earlier match, if the
two share so many bytes. Suffixes with a factor of `window` bytes are later copies,
the places that they point to have later copies.

A core with more than `most` different segments around it is split: both halves of
its strings have longer cores, and what is alike between the outermost of these
strings is one entry again. A round halves the context that can differ, and with
none left all are alike, so every group becomes small. Hashes only deal text out,
except that stretches with equal 128-bit hashes count as equal.

Bytes are those of the UTF-8 text. Null texts and texts shorter than a string
have none. Rows alike in doc_id and text count as often as they occur, and lose
the same bytes. With `keep_first` the earliest copy stays: by doc_id (null before
all), then a hash of the text, then place; rows alike in both keep it together.
Ties do not occur otherwise. Empty tables give empty results; every row gives one
row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .spark_tools import bit_filter, cut, in_filter, join_counted
from .words import _POWERS, mix

WINDOW = 400
BLOCK = 1 << 19
#: What each byte counts as in a hash.
VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
WHO = "did bigint, tk bigint"


class Hashes:
    """64-bit hashes of any stretch of some bytes."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = _POWERS.get(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(VALUES[data] * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def anchors_of(data: np.ndarray, first: np.ndarray, last: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, Hashes]:
    """Where some string that starts in first <= i < last (for any pair of these) has its anchor."""
    hashes = Hashes(data)
    at = np.arange(max(len(data) - gram + 1, 0))
    if len(data) < window:
        return at[:0], hashes
    bits = np.uint64(21)  # places within a block take the low bits, so the leftmost of equal ones is the least
    low = (hashes.of(at, at + gram) >> bits << bits) | at.astype(np.uint64)
    width = 1
    while width < window - gram + 1:
        step = min(width, window - gram + 1 - width)
        low = np.minimum(low[:-step], low[step:])
        width += step
    change = np.zeros(len(data) + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, last, -1)
    starts = np.flatnonzero(np.cumsum(change[:-1]) > 0)
    hit = np.zeros(len(data), bool)
    hit[(low[starts] & np.uint64((1 << 21) - 1)).astype(np.int64)] = True
    return np.flatnonzero(hit), hashes


def pieces(texts: list[bytes], window: int, gram: int) -> Iterator[list[tuple[int, int, int, int, int]]]:
    """Lists of (text, from, to, first start, last start + 1) of about BLOCK bytes; long texts in overlapping pieces."""
    held, size = [], 0
    for row, text in enumerate(texts):
        for begin in range(0, max(len(text) - window + 1, 0), BLOCK):
            stop = min(begin + BLOCK, len(text) - window + 1)
            piece = (row, max(0, begin - window), min(len(text), stop + 2 * window), begin, stop)
            held.append(piece)
            size += piece[2] - piece[1]
            if size >= BLOCK:
                yield held
                held, size = [], 0
    if held:
        yield held


def halves(window: int, gram: int) -> list[tuple[int, int]]:
    """How far before its anchor a string of either half starts, from and to."""
    middle = (window - gram) // 2
    return [(0, middle), (middle + 1, window - gram)] if gram < window else [(0, 0)]


def occurrences(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """h, seg (hashes of anchor and segment), did, tk, pos, stride, n (places of the anchor, evenly spaced), left, right (the segment's bytes before and from the anchor), cores (a hash for each half; 0: it has no strings)."""
    schema = f"h bigint, seg bigint, {WHO}, pos bigint, stride bigint, n bigint, left int, right int, cores array<int>"
    parts = halves(window, gram)
    names = [c.split()[0] for c in schema.split(", ")]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            did, tk = (b.column(k).to_numpy() for k in (0, 1))
            texts = b.column(2).cast(pa.binary()).to_pylist()
            size = np.array([len(t) for t in texts], np.int64)
            for block in pieces(texts, window, gram):
                row, begin, end, first, last = np.array(block, np.int64).T
                base = np.append(0, np.cumsum(end - begin))
                data = np.frombuffer(b"".join(texts[r][a:z] for r, a, z, *_ in block), np.uint8)
                at, hashes = anchors_of(data, base[:-1] + first - begin, base[:-1] + last - begin, window, gram)
                piece = np.searchsorted(base, at, "right") - 1
                pos, who = at - base[piece] + begin[piece], row[piece]
                left, right = np.minimum(pos, window - gram), np.minimum(size[who] - pos, window)
                h = hashes.of(at, at + gram)
                seg = mix(hashes.of(at - left, at + right) + left.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
                order = np.lexsort((pos, seg, h, who))
                who, h, seg, pos, left, right = (v[order] for v in (who, h, seg, pos, left, right))
                if not len(who):
                    continue
                same = np.append(False, (who[1:] == who[:-1]) & (h[1:] == h[:-1]) & (seg[1:] == seg[:-1]))
                step = np.append(0, np.diff(pos))
                bent = same & np.append(False, same[:-1]) & (step != np.append(0, step[:-1]))
                head = np.flatnonzero(~same | bent)
                n = np.diff(np.append(head, len(who)))
                stride = np.where(n > 1, step[np.minimum(head + 1, len(who) - 1)], 0)
                k = head
                here, before, after = at[order][k], left[k], right[k]
                cores = np.zeros((len(k), len(parts)), np.int32)
                for c, (a, z) in enumerate(parts):
                    some = np.maximum(a, window - after) <= np.minimum(z, before)
                    cores[some, c] = (hashes.of(here[some] - a, here[some] - z + window) >> np.uint64(33)).astype(np.int32) | 1
                cores = pa.ListArray.from_arrays(pa.array(np.arange(0, cores.size + 1, len(parts), dtype=np.int32)), pa.array(cores.ravel()))
                columns = [h[k].view(np.int64), seg[k].view(np.int64), did[who[k]], tk[who[k]], pos[k], stride, n, left[k].astype(np.int32), right[k].astype(np.int32), cores]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    return docs.where(F.octet_length("text") >= window).select("did", "tk", "text").mapInArrow(find, schema)


def only_in(rows: DataFrame, bits: bytes, key: str = "h") -> DataFrame:
    """The rows whose hash may be in a bitmap of fixed size."""
    at = rows.columns.index(key)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits, np.uint8)
        for b in batches:
            yield b.filter(pa.array(in_filter(table, b.column(at).to_numpy().view(np.uint64))))

    return rows.mapInArrow(keep, rows.schema)


# suffix order within a shard


def _ranks(data: np.ndarray, starts: np.ndarray, window: int, first: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """The order of the suffixes at `starts` by their first `window` bytes, equal where these are.

    Ranks of short strings are joined to ranks of strings three times as long (or
    twice, where three don't fit 64 bits), only at the places that the longer ones
    need. `shared[i]` bytes from i on are those from `first[i]` on, and ranked there.
    """
    n, width = len(data), 1
    while width * 2 <= min(8, window):
        width *= 2
    times = 3 if n**3 < 1 << 63 else 2
    there = lambda at, width: np.where(shared[at] >= width, first[at], at)
    packed, plan = np.ndarray(n - width + 1, f">u{width}", data.tobytes(), strides=(1,)), []
    while not plan or plan[-1][1] < window:
        longer = min(width * times, window)
        plan.append((width, longer, sorted({min(k * width, longer - width) for k in range(times)})))
        width = longer
    places = [starts]
    for width, _, parts in reversed(plan):
        needed = np.zeros(n, bool)
        for part in parts:
            needed[there(places[-1] + part, width)] = True
        places.append(np.flatnonzero(needed))
    rank = np.zeros(n, np.int64)
    at = places.pop()
    rank[at] = np.unique(packed[at].astype(np.uint64), return_inverse=True)[1]
    for (width, _, parts), at in zip(plan, reversed(places), strict=True):
        key = reduce(lambda key, part, at=at, width=width: key * n + rank[there(at + part, width)], parts, np.zeros(len(at), np.int64))
        rank[at] = np.unique(key, return_inverse=True)[1]
    return rank[starts]


def _elsewhere(key: np.ndarray, place: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which entries have a key that occurs in different places, in one of them as a wanted entry."""
    order = np.argsort(key)
    head = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
    least, most = (f.reduceat(place[order], head) for f in (np.minimum, np.maximum))
    keep = (least < most) & np.logical_or.reduceat(wanted[order], head)
    out = np.zeros(len(key), bool)
    out[order] = np.repeat(keep, np.diff(np.append(head, len(key))))
    return out


def longest_previous(
    data: np.ndarray, room: np.ndarray, place: np.ndarray, window: int, first: np.ndarray | None = None, shared: np.ndarray | None = None, wanted: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffix, its longest previous factor, the suffix there) for the suffixes that share `window` bytes with another.

    data: bytes of texts laid end to end; room: bytes left in the text from each on;
    place: the order of places, equal where two texts are of the same place; first and
    shared: an earlier position for each, and how many bytes from there on are alike;
    wanted: what shares its bytes with no wanted suffix may be left out. Factors longer
    than `window` count as `window`, shorter ones as 0: so suffixes that share
    `window` bytes, which stand together, are put in order of their places, and the
    previous smaller place is the one before.
    """
    none = np.zeros(0, np.int64)
    starts = np.flatnonzero(room >= window)
    if len(starts) < 2:
        return none, none, none
    hit = _elsewhere(Hashes(data).of(starts, starts + window), place[starts], np.ones(len(starts), bool) if wanted is None else wanted[starts])
    starts = starts[hit]
    if not len(starts):
        return none, none, none
    if first is None or shared is None:
        first, shared = np.arange(len(data)), np.zeros(len(data), np.int64)
    rank = _ranks(data, starts, window, first, shared)
    order = np.lexsort((place[starts], rank))
    suffix, rank, place = starts[order], rank[order], place[starts][order]
    new = np.append(True, rank[1:] != rank[:-1])
    k = np.arange(len(suffix))
    group = np.maximum.accumulate(np.where(new, k, 0))
    same = np.maximum.accumulate(np.where(new | np.append(True, place[1:] != place[:-1]), k, 0))
    later = same > group
    return suffix, np.where(later, window, 0), np.where(later, suffix[same - 1], -1)


def judged(rows: DataFrame, n_shards: int, window: int, keep_first: bool) -> DataFrame:
    """did, tk, start, end: stretches of repeated strings, from rows (key, did, tk, pos, left, n, low, high, body)."""
    schema = f"{WHO}, start bigint, end bigint"

    def search(table: pa.Table) -> pa.Table:
        did, tk, pos, left, n, low, high = (table[c].combine_chunks().to_numpy().astype(np.int64) for c in ("did", "tk", "pos", "left", "n", "low", "high"))
        bodies = table["body"].to_pylist()
        size = np.array([len(b) for b in bodies], np.int64)
        data = np.frombuffer(b"".join(bodies), np.uint8)
        segment = np.repeat(np.arange(len(bodies)), size)
        base = np.cumsum(size) - size
        offset = np.arange(len(data)) - np.repeat(base, size)
        order = np.lexsort((tk, did))
        text = np.zeros(len(order), np.int64)
        text[order] = np.cumsum(np.append(False, (did[order][1:] != did[order][:-1]) | (tk[order][1:] != tk[order][:-1])))
        place = np.repeat((text << 36) + pos - left, size) + offset
        # what all strings of a row hold is the same in many rows, and ranked in the first of them
        begin, end, known = left - low, left - high + window, {}
        head = np.array([known.setdefault(b[a:z], i) for i, (b, a, z) in enumerate(zip(bodies, begin, end, strict=True))], np.int64)
        shared = np.where(offset >= np.repeat(begin, size), np.maximum(np.repeat(end, size) - offset, 0), 0)
        first = np.arange(len(data)) + np.where(shared > 0, np.repeat((base + begin)[head] - base - begin, size), 0)
        single = np.repeat(n == 1, size)  # segments that occur several times are repeated as a whole
        at, factor, source = longest_previous(data, size[segment] - offset, place, window, first, shared, None if keep_first else single)
        later = factor >= window
        hit = np.zeros(len(data), bool)
        hit[at[later]] = True
        if not keep_first:
            hit[source[later]] = True
            hit &= single
        marked = np.flatnonzero(hit)
        head = np.append(True, (np.diff(marked) != 1) | (np.diff(segment[marked]) != 0)) if len(marked) else np.zeros(0, bool)
        begin = marked[head]
        stop = marked[np.append(head[1:], True)] if len(marked) else begin
        who = segment[begin]
        start = (pos - left)[who] + offset[begin]
        columns = [did[who], tk[who], start, start + stop - begin + window]
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["did", "tk", "start", "end"])

    return rows.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(n_shards))).groupBy("shard").applyInArrow(search, schema)


COLUMNS = f"key bigint, {WHO}, pos bigint, left int, n bigint, low int, high int, m bigint, body binary"


def segments(texts: DataFrame, asked: DataFrame, window: int) -> DataFrame:
    """COLUMNS for what `asked` lists for each text: the bytes of the strings that start low..high bytes before pos."""
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bodies = b.column(2).cast(pa.binary()).to_pylist()
            size = b.column(3).value_lengths().to_numpy()
            who, flat = np.repeat(np.arange(b.num_rows), size), b.column(3).flatten()
            key, pos, low, high, n, m = (flat.field(f).to_numpy().astype(np.int64) for f in ("key", "pos", "low", "high", "n", "m"))
            left = np.minimum(pos, high)
            end = np.minimum(pos - low + window, np.array([len(t) for t in bodies], np.int64)[who])
            for at in range(0, len(who), 10_000):
                k = slice(at, at + 10_000)
                body = [bodies[w][a:z] for w, a, z in zip(who[k], (pos - left)[k], end[k], strict=True)]
                ids = [b.column(j).to_numpy()[who[k]] for j in (0, 1)]
                columns = [key[k], *ids, pos[k], left[k].astype(np.int32), n[k], low[k].astype(np.int32), high[k].astype(np.int32), m[k], pa.array(body, pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return texts.join(asked, ["did", "tk"]).select("did", "tk", "text", "asked").mapInArrow(take, COLUMNS)


def split(rows: DataFrame, window: int) -> DataFrame:
    """Each row twice, by the longer cores of the two halves of its strings; body is cut to what these cover, alike is its hash."""
    names = [*rows.columns, "alike"]

    def cut_in_two(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            which, new = [], {c: [] for c in ("key", "left", "low", "high", "body", "alike")}
            columns = [b.column(names.index(c)).to_pylist() for c in ("key", "left", "low", "high", "body")]
            for i, (key, left, low, high, body) in enumerate(zip(*columns, strict=True)):
                middle = (low + high) // 2
                for a, z in ((low, middle), (middle + 1, high)):
                    if max(a, left + window - len(body)) > min(z, left):
                        continue  # near a text's end not all strings exist
                    hashed = lambda data: int.from_bytes(hashlib.blake2b(b"%d %d %d " % (key, a, z) + data, digest_size=8).digest(), "little", signed=True)  # noqa: B023, E731
                    start = max(left - z, 0)
                    part = body[start : left - a + window]
                    values = (hashed(body[left - a : left - z + window]), left - start, a, z, part, hashed(b"%d " % (left - start) + part))
                    which.append(i)
                    for c, v in zip(new, values, strict=True):
                        new[c].append(v)
            kinds = {"left": pa.int32(), "low": pa.int32(), "high": pa.int32(), "body": pa.binary()}
            out = b.take(pa.array(which, pa.int64()))
            made = {c: pa.array(v, kinds.get(c, pa.int64())) for c, v in new.items()}
            yield pa.RecordBatch.from_arrays([made[c] if c in made else out.column(k) for k, c in enumerate(names)], names)

    return rows.mapInArrow(cut_in_two, f"{COLUMNS}, alike bigint")


def named(docs: DataFrame) -> DataFrame:
    """doc_id, did (without nulls), tk (hash of the text), text."""
    text = F.col("text").cast("string")
    did = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    return docs.select("doc_id", did.alias("did"), F.xxhash64(text).alias("tk"), text.alias("text"))


def repeats(docs: DataFrame, window: int = WINDOW, keep_first: bool = False, most: int = 2000, gram: int | None = None) -> DataFrame:
    """did, tk, start, end: byte stretches of repeated strings (of later copies only, with keep_first); they may overlap."""
    gram = gram or max(1, window // 2)
    slim = named(docs).drop("doc_id")
    found = cut(occurrences(slim, window, gram))
    several = found.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1")
    found = cut(only_in(found, bit_filter(several.select("h"), 24)))
    first = F.min(F.struct("did", "tk", "pos")).alias("first")
    kinds = cut(found.groupBy("h", "seg").agg(F.sum("n").alias("n"), first, *[F.first(c).alias(c) for c in ("left", "right", "cores")]))

    # segments that occur several times
    copies = cut(kinds.where("n > 1").select("h", "seg", "first", F.col("n").alias("total")))
    held = join_counted(found, copies, ["h", "seg"], "total")
    begin = F.when((F.struct("did", "tk", "pos") == F.col("first")) & F.lit(keep_first), 1).otherwise(0)
    held = held.withColumn("begin", begin.cast("bigint")).where("n > begin").withColumn("near", F.col("stride") <= window)
    turns = F.when(F.col("near"), F.array("begin")).otherwise(F.sequence("begin", F.col("n") - 1))
    held = held.withColumn("turn", F.explode(turns)).withColumn("end_turn", F.expr("if(near, n - 1, turn)"))
    out = [held.selectExpr("did", "tk", "pos - left + turn * stride AS start", "pos + right + end_turn * stride AS end")]

    # halves whose core several different segments have
    limits = F.array(*[F.struct(F.lit(a).alias("low"), F.lit(z).alias("high")) for a, z in halves(window, gram)])
    cores = F.explode(F.filter(F.arrays_zip(F.col("cores").alias("core"), limits.alias("limit")), lambda x: x["core"] != 0)).alias("c")
    sides = cut(kinds.select("n", "first.*", cores, "h").select("n", "did", "tk", "pos", "c.limit.*", F.xxhash64("h", "c.core", "c.limit.low").alias("key")))
    shared = cut(sides.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"))
    sides = join_counted(sides, shared, "key", "m")
    asked = cut(sides.groupBy("did", "tk").agg(F.collect_list(F.struct("key", "pos", "low", "high", "n", "m")).alias("asked")))
    texts = only_in(slim.where("text IS NOT NULL"), bit_filter(asked.select(F.col("tk").alias("h")), 24), "tk")
    rows = cut(segments(texts.groupBy("did", "tk").agg(F.first("text").alias("text")), asked, window))
    small, large = [rows.where(F.col("m") <= most)], rows.where(F.col("m") > most)
    while not large.isEmpty():
        dealt = cut(split(large, window).drop("m"))
        kinds = cut(dealt.groupBy("key", "alike").agg(F.sum("n").alias("total"), first))
        dealt = cut(join_counted(dealt, kinds, ["key", "alike"], "total"))
        is_first = F.struct("did", "tk", "pos") == F.col("first")
        gone = dealt.where(F.col("total") > 1).where(~is_first if keep_first else F.col("n") == 1)
        out.append(gone.select("did", "tk", (F.col("pos") - F.col("left")).alias("start"), (F.col("pos") - F.col("left") + F.length("body")).alias("end")))
        shared = cut(kinds.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"))
        left = join_counted(dealt.where(is_first).withColumn("n", F.col("total")), shared, "key", "m").select(rows.columns)
        left = cut(left)
        small.append(left.where(F.col("m") <= most))
        large = left.where(F.col("m") > most)
    small = reduce(DataFrame.unionByName, small)
    n_shards = small.count() * (window + gram // 2) // 500_000 + 1
    return reduce(DataFrame.unionByName, [*out, judged(small, n_shards, window, keep_first)])


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of stretches as disjoint ones that do not touch."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    head = np.append(True, start[1:] > end[:-1])
    return start[head], end[np.append(head[1:], True)]


def deduplicate(docs: DataFrame, window: int = WINDOW, keep_first: bool = False, most: int = 2000, kept: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (stretches removed) and kept (the remaining bytes) or, without, kept_sha256."""
    stretches = repeats(docs, window, keep_first, most).groupBy("did", "tk").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    stretches = cut(stretches)
    rows = named(docs)
    name, kind = ("kept", "binary") if kept else ("kept_sha256", "string")
    doc_id = docs.schema["doc_id"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, spans in zip(b.column(1).cast(pa.binary()), b.column(2), strict=True):
                data = text.as_py()
                start, end = merged(*(spans.values.field(f).to_numpy() for f in ("start", "end")))
                rest = b"".join(data[a:z] for a, z in zip([0, *end], [*start, len(data)], strict=True))
                out.append((len(data), len(data) - len(rest), len(start), rest if kept else hashlib.sha256(rest).hexdigest()))
            columns = [b.column(0), *[pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary() if kept else pa.string()), strict=True)]]
            if out:
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", name])

    hit = only_in(rows.where("text IS NOT NULL"), bit_filter(stretches.select(F.col("tk").alias("h")), 24), "tk").join(stretches, ["did", "tk"])
    changed = hit.select("doc_id", "text", "spans").mapInArrow(apply, f"doc_id {doc_id}, n_bytes bigint, n_removed bigint, n_spans bigint, {name} {kind}")
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    as_is = rows.select("doc_id", "did", "tk", F.octet_length(data).cast("long").alias("n_bytes"), (data if kept else F.sha2(data, 256)).alias(name))
    # an outer join: an anti-join would be pushed below the digests, and whole texts shuffled
    as_is = as_is.join(stretches.select("did", "tk", F.lit(True).alias("hit")), ["did", "tk"], "left").where("hit IS NULL")
    zero = F.lit(0).cast("long")
    return changed.unionByName(as_is.select("doc_id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), name))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy goes, the first too: the places that factors point to are repeated as well."""
    return deduplicate(spark.read.parquet(f"{sf_dir}/documents.parquet"), kept=False)


ORACLE_SQL = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
w AS (SELECT rid, i, md5(substr(hx, 2 * i + 1, {2 * WINDOW})) AS k FROM d, unnest(range(0, greatest(len(hx) // 2 - {WINDOW - 1}, 0))) AS t(i)),
dup AS (SELECT rid, i FROM w QUALIFY count(*) OVER (PARTITION BY k) > 1),
gap AS (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY rid ORDER BY i) <= {WINDOW} THEN 0 ELSE 1 END AS new FROM dup),
run AS (SELECT rid, min(i) AS a, max(i) + {WINDOW} AS b FROM (SELECT *, sum(new) OVER (PARTITION BY rid ORDER BY i) AS run FROM gap) GROUP BY rid, run),
part AS (SELECT run.*, hx, lag(b, 1, 0) OVER (PARTITION BY rid ORDER BY a) AS prior FROM run JOIN d USING (rid)),
cutout AS (SELECT rid, sum(b - a) AS n_removed, count(*) AS n_spans, string_agg(substr(hx, 2 * prior + 1, 2 * (a - prior)), '' ORDER BY a) || substr(any_value(hx), 2 * max(b) + 1) AS kept FROM part GROUP BY rid)
SELECT doc_id, len(hx) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, hx))) AS kept_sha256 FROM d LEFT JOIN cutout USING (rid)"""
