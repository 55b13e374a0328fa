"""Toxicity scores from subword-bag embeddings and a linear softmax.

A word's subwords are its byte 3- to 6-grams, with marks at both ends, hashed
into buckets; a bucket has an embedding. A passage of words is the average of
its words' embeddings (a word being the average of its subwords), and a linear
softmax scores it. Embeddings and softmax are trained jointly in numpy with
Adam. A document is toxic if some passage is, so passages pool through a
log-sum-exp; a long text is not washed out by its harmless rest.

Few documents have many n-grams, so a free embedding for each learns the rows by
heart. Only buckets whose counts of documents differ between the labels more than
one of all buckets would by chance have an embedding; the others stay at zero.

The classifier is fitted on a bounded sample of labelled rows (`max_docs` of them
and `max_bytes` of text, by a hash of the id); every row is scored on its whole text. Texts without words (null
and empty ones among them) score 0. Rows are scored alone, so ties, repeated
rows, null ids and empty tables need nothing special; without labelled rows of
both kinds every other score is the rate of label 1 (0.0 without labels). Other
columns are ignored.
"""

import heapq
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import ALNUM, mix, parts, release, split, utf8

ORDERS, LOG2_BUCKETS, DIM, PASSAGE = (3, 4, 5, 6), 17, 4, 24
TAU = 0.5
#: One of 2^17 buckets whose counts are independent of the labels has a G statistic above this (chi-square, one degree).
GATE = 20.0
#: The logit of a text without words.
NOTHING = -1000.0


def _distinct_words(w):
    """(word number of each word, first place of each number)."""
    _, at, number = np.unique(w.hash, return_index=True, return_inverse=True)
    return number, at


def _bags(w, at) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words at these places, concatenated, and their bounds; all n-grams of an order at once."""
    lengths = (w.end - w.start)[at] + 2
    ends = np.cumsum(lengths)
    begin = ends - lengths
    marked = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    marked[begin], marked[ends - 1] = ord("<"), ord(">")
    inner = np.ones(len(marked), bool)
    inner[begin] = inner[ends - 1] = False
    take = np.repeat(w.start[at] - (begin + 1), lengths - 2) + np.flatnonzero(inner)
    marked[inner] = np.frombuffer(w.rule.shown, np.uint8)[w.raw[take]]
    marked = marked.astype(np.uint64)
    left = np.repeat(ends, lengths) - np.arange(len(marked))
    owner = np.repeat(np.arange(len(at), dtype=np.int32), lengths)
    buckets, owners = [], []
    for n in ORDERS:
        ok = left >= n
        if len(marked) < n:
            continue
        h = marked[: len(marked) - n + 1].copy()
        for j in range(1, n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + marked[j : len(marked) - n + 1 + j]
        ok = ok[: len(h)]
        buckets.append((mix(h[ok] + np.uint64(n)) >> np.uint64(64 - LOG2_BUCKETS)).astype(np.int32))
        owners.append(owner[: len(h)][ok])
    if not buckets:
        return np.zeros(0, np.int32), np.zeros(len(at) + 1, np.int64)
    owners, buckets = np.concatenate(owners), np.concatenate(buckets)
    order = np.argsort(owners, kind="stable")
    return buckets[order], np.searchsorted(owners[order], np.arange(len(at) + 1))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i+1]], empty ranges giving 0."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.float64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _passages(w, passage: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word of each passage and the end, row of each passage); rows without words have none."""
    count = w.count()
    per = -(-count // passage)
    row = np.repeat(np.arange(len(count)), per)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    return np.append(w.first[:-1][row] + nth * passage, w.first[-1]), row


class Model:
    """What scoring needs: each bucket's logit (its embedding times the softmax weights) and the bias."""

    def __init__(self, logit: np.ndarray, bias: float, passage: int = PASSAGE) -> None:
        self.logit, self.bias, self.passage = logit, bias, passage

    def dumps(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, logit=self.logit.astype(np.float32), bias=self.bias, passage=self.passage)
        return out.getvalue()

    @staticmethod
    def loads(data: bytes) -> "Model":
        x = np.load(io.BytesIO(data))
        return Model(x["logit"].astype(np.float64), float(x["bias"]), int(x["passage"]))

    def score(self, texts: pa.Array) -> np.ndarray:
        """0..1 for each text."""
        out = np.full(len(texts), NOTHING, np.float64)
        for lo, hi in slices(texts):
            w = split(texts[lo:hi], ALNUM)
            if not len(w.hash):
                continue
            number, at = _distinct_words(w)
            buckets, bounds = _bags(w, at)
            word = _sums(self.logit[buckets], bounds) / np.maximum(np.diff(bounds), 1)
            first, row = _passages(w, self.passage)
            z = _sums(word[number], first) / np.diff(first) + self.bias
            out[lo:hi] = pool(z, row, hi - lo)
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def slices(texts: pa.Array, size: int = 1 << 20):
    """Ranges of rows of about so many bytes."""
    _, offsets = utf8(texts)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size)))
        yield lo, min(hi, len(texts))
        lo = min(hi, len(texts))


def pool(z: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Soft maximum of the passages of each row; NOTHING without any."""
    top = np.full(n, -np.inf)
    np.maximum.at(top, row, z)
    some = np.isfinite(top)
    total = np.bincount(row, np.exp((z - top[row]) / TAU), n)
    return np.where(some, np.where(some, top, 0) + TAU * np.log(np.maximum(total, 1e-300)), NOTHING)


def telling(bags: np.ndarray, bounds: np.ndarray, docs: list[np.ndarray], labels: np.ndarray, n_buckets: int) -> np.ndarray:
    """Which buckets tell the labels apart: the G statistic of the numbers of documents with and without one is above GATE.

    docs holds the word numbers of each document.
    """
    held = np.zeros((2, n_buckets))
    for words, y in zip(docs, labels, strict=True):
        words = np.unique(words)
        count = bounds[words + 1] - bounds[words]
        at = np.repeat(bounds[words], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        held[int(y), np.unique(bags[at])] += 1
    size = np.bincount(labels.astype(int), minlength=2)[:, None]
    seen = np.stack([held, size - held])
    expected = seen.sum(1, keepdims=True) * size / size.sum()
    return 2 * (seen * np.log(np.maximum(seen, 1e-300) / np.maximum(expected, 1e-300))).sum((0, 1)) > GATE


def train(texts: pa.Array, labels: np.ndarray, steps: int = 100, rate: float = 0.15, seed: int = 7, decay: float = 1e-5) -> Model:
    """Fit embeddings and softmax together; full-batch Adam on the mean log loss."""
    n_buckets = 1 << LOG2_BUCKETS
    y = labels.astype(np.float64)
    if not len(y) or y.min() == y.max():
        p = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(n_buckets), float(np.log(max(p, 1e-9) / max(1 - p, 1e-9))))
    w = split(texts, ALNUM)
    number, at = _distinct_words(w)
    buckets, bounds = _bags(w, at)
    first, row = _passages(w, PASSAGE)
    kept = telling(buckets, bounds, [number[a:z] for a, z in zip(w.first[:-1], w.first[1:], strict=True)], y, n_buckets)
    del w
    used = np.flatnonzero(kept)
    # the kept n-grams of words that have some, and the places of these words
    live = kept[buckets]
    word_of = np.repeat(np.arange(len(at)), np.diff(bounds))[live]
    slot = np.searchsorted(used, buckets[live])
    share = 1 / np.diff(bounds)[word_of]
    has = np.isin(number, word_of)
    passage_of = np.repeat(np.arange(len(row)), np.diff(first))[has]
    number, length = number[has], np.diff(first).astype(np.float64)
    rng = np.random.default_rng(seed)
    emb, soft = rng.normal(0, 0.1, (DIM, len(used))), rng.normal(0, 0.5, (2, DIM))
    bias = np.array([0.0, np.log(y.mean() / (1 - y.mean())) - 1.0])
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (emb, soft, bias)]
    for step in range(1, steps + 1):
        words = [np.bincount(word_of, e[slot] * share, len(at)) for e in emb]
        bags = np.stack([np.bincount(passage_of, v[number], len(row)) for v in words]) / length
        logits = soft @ bags
        z = logits[1] - logits[0] + bias[1] - bias[0]
        p = 1 / (1 + np.exp(-np.clip(pool(z, row, len(y)), -50, 50)))
        g_doc = (p - y) / len(y)
        top = np.full(len(y), -np.inf)
        np.maximum.at(top, row, z)
        e = np.exp((z - top[row]) / TAU)
        g_z = g_doc[row] * e / np.bincount(row, e, len(y))[row]
        total = g_z.sum()
        g_word = np.bincount(number, (g_z / length)[passage_of], len(at))
        g_slot = np.bincount(slot, g_word[word_of] * share, len(used))
        g_soft = bags @ g_z
        grads = [(soft[1] - soft[0])[:, None] * g_slot + decay * emb, np.stack([-g_soft, g_soft]) + decay * soft, np.array([-total, total])]
        for x, g, m in zip((emb, soft, bias), grads, moments, strict=True):
            m[0] += 0.1 * (g - m[0])
            m[1] += 0.01 * (g * g - m[1])
            x -= rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8)
    logit = np.zeros(n_buckets)
    logit[used] = (soft[1] - soft[0]) @ emb
    return Model(logit, float(bias[1] - bias[0]))


def first_within(batches, size: int) -> list[tuple]:
    """The longest run of rows (order, id, label, text), by order and id, whose texts have at most so many bytes; no more than a batch beyond that is held."""
    heap, total, limit = [], 0, None
    for b in batches:
        for order, i, y, text in zip(*[b[c].to_pylist() for c in ("h", "id", "y", "text")], strict=True):
            if limit is not None and (order, i) > limit:
                continue
            raw = (text or "").encode()
            heapq.heappush(heap, (-order, -i, y, raw))
            total += len(raw)
            while total > size:
                away = heapq.heappop(heap)
                total -= len(away[3])
                limit = min(limit or (-away[0], -away[1]), (-away[0], -away[1]))
    return sorted((-h, -i, y, raw.decode()) for h, i, y, raw in heap if limit is None or (-h, -i) < limit)


def fit(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, target: str = "toxic", max_docs: int = 4500, max_bytes: int = 48_000_000) -> Model:
    """Fit on at most max_docs labelled rows with at most max_bytes of text: by hash, up to a third of them of label 1.

    An id with several texts counts with the least of them, one with both labels as
    0. The sample's ids are bounded, so they are broadcast and other texts are not
    shuffled; one task trains on the sample's texts and returns the model.
    """
    known = labels.select(F.col("doc_id").alias("id"), F.col(target).cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)")
    if held_out is not None:
        known = known.where(~held_out)
    by = F.xxhash64(F.col("id").cast("string"))
    sample = [r for y, n in ((1, max_docs // 3), (0, max_docs - max_docs // 3)) for r in known.where(F.col("y") == y).distinct().orderBy(by, "id").limit(n).collect()]
    label = {r.id: r.y for r in sample}
    chosen = docs.sparkSession.createDataFrame(list(label.items()), "id bigint, y int")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).groupBy("id", "y").agg(F.min("text").alias("text")).select(by.alias("h"), "id", "y", "text")

    def learn(batches):
        sample = first_within(batches, max_bytes)
        model = train(pa.array([r[3] for r in sample], pa.string()), np.array([r[2] for r in sample], dtype=int))
        release()
        yield pa.RecordBatch.from_arrays([pa.array([model.dumps()], pa.binary())], ["model"])

    learnt = rows.repartition(1).mapInArrow(learn, "model binary").first() if label else None
    return Model.loads(learnt.model) if learnt else train(pa.array([], pa.string()), np.zeros(0))


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score per row of docs; the model is of a fixed size."""
    shared = docs.sparkSession.sparkContext.broadcast(model.dumps())

    def run(batches):
        own = Model.loads(shared.value)
        for b in parts(batches):
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(own.score(b["text"]))], ["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def held_out(column: str, kinds: int, which: int) -> Column:
    """Whether crc32 of the id as text has this remainder."""
    return (F.crc32(F.col(column).cast("string").cast("binary")) % kinds) == which


def op8_toxicity(spark, sf_dir) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    scored = scores(docs, fit(docs, labels, held_out("id", 4, 2)))
    return scored.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of docs scored below the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model.dumps())

    def run(batches):
        own = Model.loads(shared.value)
        for b in parts(batches):
            yield b.filter(pa.array(own.score(b["text"].cast(pa.string())) < threshold))

    return docs.mapInArrow(run, docs.schema)
