"""Best-fit packing of token sequences by a configuration linear program.

Texts are tokenised whole, closed with id 0, and cut into pieces of at most
`size` tokens, the shorter piece first. The histogram of piece lengths, of at
most `size` bins whatever the corpus, defines the program: cover each length's
count with as few configurations (multisets of lengths of at most `size` tokens)
as possible. Multiplicative weights price the lengths; a knapsack dynamic program
finds, for every length, the best configuration that holds it; the fractional
counts are rounded and filled with actual lengths, what is left goes through the
program again, and only the last pieces and the small ones are placed best fit.
Pieces get their places by rank within their length. Ranks come from salted
groups and the groups' running counts, themselves summed by blocks of groups, so
one very common length is no hot spot.

Null and empty texts are the single id 0. Each row is a document of its own,
repeated rows and null ids included; empty tables give empty results; other
columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .spark_tools import cut
from .words import parts

SIZE = 2048


class Encoder:
    """Ids of a byte-level vocabulary. Two public libraries hold it; the faster one serves texts without its special tokens."""

    def __init__(self, vocabulary: str, ranks: str | None, pattern: str | None) -> None:
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.exact.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast and not any(s in text for s in self.special):
            try:
                return self.fast.encode_ordinary(text)
            except BaseException as e:  # its regex gives up on some very long runs; the error is no Exception
                if type(e).__name__ != "PanicException":
                    raise
        return self.exact.encode(text, add_special_tokens=False).ids


def public_encoder() -> Encoder:
    import public_tokenizers as P

    return Encoder(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def cuts(n: int, size: int = SIZE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: only the first may be short."""
    head = n % size
    return ([(0, head)] if head else []) + [(at, size) for at in range(head, n, size)]


def pieces(docs: DataFrame, encoder=public_encoder, size: int = SIZE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 per piece."""

    def run(batches):
        own = encoder()
        for b in parts(batches):
            row, out = [], []
            for r, text in enumerate(b["text"].to_pylist()):
                ids = array("I", own.ids(text) if text else [])
                ids.append(0)
                data = memoryview(ids).cast("B")
                for p, (at, n) in enumerate(cuts(len(ids), size)):
                    row.append(r)
                    out.append((p, at, n, zlib.crc32(data[4 * at : 4 * (at + n)])))
            columns = list(zip(*out, strict=True)) if out else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"].take(pa.array(row, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True))],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint")


def knapsack(lengths: np.ndarray, most: np.ndarray, price: np.ndarray, size: int) -> tuple[float, list[tuple[int, ...]]]:
    """(greatest value of a configuration, for each length the numbers of the lengths in a best configuration that holds it)."""
    chunks = []  # a length's copies as 1, 2, 4, ... at a time
    for j, n in enumerate(np.minimum(most, size // lengths).tolist()):
        k = 1
        while n > 0:
            chunks.append((j, min(k, n)))
            n -= k
            k *= 2
    best, taken = np.zeros(size + 1), np.zeros((len(chunks), size + 1), bool)
    for i, (j, k) in enumerate(chunks):
        room = int(lengths[j]) * k
        value = best[: size + 1 - room] + price[j] * k
        taken[i, room:] = value > best[room:] + 1e-12
        best[room:] = np.where(taken[i, room:], value, best[room:])
    room = size - lengths
    held = [[j] for j in range(len(lengths))]
    for i in range(len(chunks) - 1, -1, -1):
        j, k = chunks[i]
        for r in np.flatnonzero(taken[i, room]).tolist():
            held[r] += [j] * k
            room[r] -= lengths[j] * k
    return float(best[size]), [tuple(sorted(h)) for h in held]


def program(lengths: np.ndarray, counts: np.ndarray, size: int, rounds: int = 40) -> tuple[list[tuple[int, ...]], np.ndarray, float]:
    """(configurations of length numbers, their fractional counts, a lower bound on any cover's size).

    A configuration's count is the product of its lengths' weights, less for unused
    room. A weight is multiplied by need over cover until each length is covered as
    often as it occurs. Log weights, scaled by a temperature that falls from round
    to round, are the prices at which the knapsack looks for better configurations;
    prices over the greatest configuration's value are a dual solution, hence the bound.
    """
    need, weight, bound, heat = counts.astype(float), np.zeros(len(lengths)), 0.0, 0.1
    pool = dict.fromkeys((j,) * int(min(size // lengths[j], counts[j])) for j in range(len(lengths)))
    for _ in range(rounds):
        price = np.maximum(lengths / size + heat * weight, 1e-6)
        top, found = knapsack(lengths, counts, price, size)
        bound = max(bound, float(need @ price) / top)
        before = len(pool)
        pool.update(dict.fromkeys(c for c in found if all(n <= counts[j] for j, n in Counter(c).items())))
        item = np.concatenate([np.array(c) for c in pool])
        column = np.repeat(np.arange(len(pool)), [len(c) for c in pool])
        unused = 1 - np.bincount(column, lengths[item]) / size
        if len(pool) == before and heat <= 0.005:
            break
        cooler = max(heat * 0.8, 0.005)
        weight, heat = weight * heat / cooler, cooler
        for _ in range(300):
            amount = np.exp(np.clip(np.bincount(column, weight[item]) - unused / heat, -300, 50))
            off = np.log(need / np.maximum(np.bincount(item, amount[column], len(lengths)), 1e-300))
            if np.abs(off).max() < 1e-3:
                break
            weight += np.clip(off, -2, 2) / 3
    return list(pool), amount, bound


def members(items: tuple[int, ...], times: int, classes: list[list[int]], left: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Sequences of one configuration of classes that actual lengths fill to the last token (or as the program says, if each class is one length), taken from `left`."""
    out = []
    spare = size if all(len(classes[g]) == 1 for g in items) else 0
    while times > 0:
        use: Counter = Counter()
        for g in items[:-2]:  # what is most frequent
            use[max(classes[g], key=lambda x: left[x] - use[x])] += 1
        room = size - sum(x * n for x, n in use.items())
        a, b = ([x for x in classes[g] if left[x] > use[x]] for g in ((items[-2], items[-1]) if len(items) > 1 else (items[0], items[0])))
        if len(items) == 1:
            sums = np.where(np.array(a) <= room, np.array(a), -1)[:, None]
        else:  # the two last fit best
            sums = np.array(a)[:, None] + np.array(b)[None]
            same = np.equal.outer(a, b) & np.array([left[x] - use[x] < 2 for x in a], bool)[:, None]
            sums = np.where((sums <= room) & ~same, sums, -1)
        if not sums.size or sums.max() < max(room - spare, 0) or any(n > left[x] for x, n in use.items()):
            break
        i, j = np.unravel_index(int(sums.argmax()), sums.shape)
        use.update([a[i]] if len(items) == 1 else [a[i], b[j]])
        n = min(times, *(left[x] // k for x, k in use.items()))
        for x, k in use.items():
            left[x] -= n * k
        out.append((tuple(sorted(use.elements(), reverse=True)), n))
        times -= n
    return out


def programmed(left: dict[int, int], size: int, classes: int = 64, rounds: int = 8) -> list[tuple[tuple[int, ...], int]]:
    """Sequences that the configuration program decides; takes their pieces from `left`.

    Neighbouring lengths are merged into classes of like counts (none if there are
    few lengths), the program is solved over the classes' mean lengths, and its
    rounded counts are filled with actual lengths. What finds no exact filling goes
    into the next round's program. Pieces under a sixteenth of a sequence stay: they fill gaps.
    """
    out = [((size,), left.pop(size))] if left.get(size) else []
    for _ in range(rounds):
        lengths = np.array([x for x in sorted(left) if left[x] > 0 and 16 * x >= size], np.int64)
        if not len(lengths):
            break
        counts = np.array([left[x] for x in lengths.tolist()])
        total, most = int(counts.sum()), max(1, min(classes, int(counts.sum()) // 4))
        which = np.arange(len(lengths)) if len(lengths) <= classes else np.unique((np.cumsum(counts) - 1) * most // total, return_inverse=True)[1]
        n = np.bincount(which, counts).astype(np.int64)
        own = [lengths[which == g].tolist() for g in range(len(n))]
        chosen, amount, _ = program(np.bincount(which, lengths * counts).astype(np.int64) // n, n, size)
        new = []
        for i in sorted(range(len(chosen)), key=lambda i: (-amount[i], chosen[i])):
            new += members(chosen[i][::-1], int(amount[i] + 0.5), own, left, size)
        out += new
        if 20 * sum(n * len(items) for items, n in new) < total:
            break
    return out


def place_rest(left: dict[int, int], size: int, begun: list[tuple[tuple[int, ...], int]] = ()) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, whole groups of like sequences at a time, also into those begun: (lengths of a sequence, number of such sequences)."""
    rooms: dict[int, list[list]] = {}
    for items, n in begun:
        rooms.setdefault(size - sum(items), []).append([items, n])
    for x in sorted((x for x in left if left[x] > 0), reverse=True):
        todo = left[x]
        while todo:
            room = min((r for r in rooms if r >= x), default=0)
            if room:
                group = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room]
                n = min(todo, group[1])
                if n < group[1]:
                    rooms.setdefault(room, []).append([group[0], group[1] - n])
                rooms.setdefault(room - x, []).append([(*group[0], x), n])
                todo -= n
            else:
                per = size // x
                n, per = (todo // per, per) if todo >= per else (1, todo)
                rooms.setdefault(size - x * per, []).append([(x,) * per, n])
                todo -= n * per
    return [(tuple(g[0]), g[1]) for groups in rooms.values() for g in groups]


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences), together holding each length exactly as often as counted."""
    left = dict(counts)
    return place_rest(left, size, programmed(left, size))


def slots(groups: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), by length and rank."""
    taken: Counter = Counter()
    rows, sequence = [], 0
    for items, n in groups:
        offset = 0
        for x in items:
            rows.append((x, taken[x], sequence, offset))
            taken[x] += n
            offset += x
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(docs: DataFrame, encoder=public_encoder, size: int = SIZE, group_rows: int = 1000) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset per piece."""
    cut_up = cut(pieces(docs, encoder, size))
    counts = {r.length: r.n for r in cut_up.groupBy("length").agg(F.count("*").alias("n")).collect()}
    salts = -(-sum(counts.values()) // group_rows) or 1
    table = docs.sparkSession.sparkContext.broadcast(slots(plan(counts, size)))
    salted = cut_up.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(salts)))
    groups = salted.groupBy("length", "__salt").agg(F.count("*").alias("n")).withColumn("block", F.expr("__salt div 1024"))
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = groups.groupBy("length", "block").agg(F.sum("n").alias("n"))
    blocks = blocks.select("length", "block", earlier(Window.partitionBy("length").orderBy("block")).alias("first"))
    before = groups.withColumn("before", earlier(Window.partitionBy("length", "block").orderBy("__salt"))).join(blocks, ["length", "block"])
    before = before.select(F.col("length").alias("l"), F.col("__salt").alias("s"), (F.col("first") + F.col("before")).alias("before"))
    nth = F.row_number().over(Window.partitionBy("length", "__salt").orderBy("doc_id", "piece", "start", "ids_crc32"))
    ranked = salted.withColumn("nth", nth).join(before, (F.col("length") == F.col("l")) & (F.col("__salt") == F.col("s")))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth") - 1).cast("long").alias("rank"))

    def place(batches):
        rows = table.value
        key = rows[:, 0] * (1 << 48) + rows[:, 1]
        for b in batches:
            length, rank = b["length"].to_numpy(), b["rank"].to_numpy()
            at = np.searchsorted(key, length * (1 << 48) + rank, side="right") - 1
            own = rows[at] if len(at) else np.zeros((0, 4), np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(own[:, 2] + rank - own[:, 1]), pa.array(own[:, 3])], [*b.schema.names[:5], "sequence_id", "offset"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(place, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def op3_packing(spark, sf_dir) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
