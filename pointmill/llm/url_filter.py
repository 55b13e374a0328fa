"""URL filters: host and path rules, and gradient-boosted trees for the rest.

Rules name a host (with all its subdomains) and a path prefix; the longest that
fits decides. Where none fits, boosted trees over lexical features decide:
lengths, depth, digit ratio, entropy, parameter counts and corpus-wide
statistics of the host's suffix. They are trained on URLs that rules label, a
bounded sample of them (`max_rows`, by a hash of the URL); the suffix statistics
cover all URLs, but for a labelled one the labels of the other four folds only.

A null URL, or one without "://", has an empty host and path and is judged by
the trees like any other. Repeated rows and null ids are kept, one output row
each; without labels of both kinds the trees give the majority (allow if there
is none); empty tables give empty results; other columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spark_tools import cut, join_counted

FOLDS = 5
RULES = (
    ("block", "com/en/"),
    ("allow", "example.com/en/7"),
    ("allow", "net/de/"),
    ("block", "example.net/de/8"),
    ("block", "org/es/"),
)
NAMES = ("entropy", "length", "host_length", "path_length", "depth", "labels", "digits", "host_digits", "params", "query_length", "fragment", "hyphens", "longest_part", "suffix_log_n", "suffix_rate", "suffix_known")


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path, suffix (the host's last two labels)."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    df = pages.select("page_id", url.alias("url"))
    df = df.withColumn("rest", F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(""))
    df = df.withColumn("raw", F.regexp_extract("rest", "^[^/?#]*", 0))
    df = df.withColumn("path", F.regexp_extract(F.expr("substring(rest, length(raw) + 1)"), "^[^?#]*", 0))
    host = F.translate("raw", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return df.select("page_id", "url", host.alias("host"), "path", F.substring_index(host, ".", -2).alias("suffix"))


def rule_column(rules=RULES) -> tuple[Column, Column]:
    """(the rule that decides, its verdict); nulls where none fits. For rule lists that a user writes by hand."""
    name = verdict = F.lit(None).cast("string")
    for said, rule in sorted(rules, key=lambda x: (len(x[1]), x[1])):  # the last that fits stands outermost
        host, path = rule.partition("/")[0], "/" + rule.partition("/")[2]
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, said).otherwise(verdict)
    return name, verdict


def lexical() -> list[Column]:
    """The columns of NAMES but the entropy, of a parsed URL with its suffix's n, rate and known."""
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    count = lambda text, c: F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))
    digits = lambda text: F.length(F.regexp_replace(text, "[^0-9]", ""))
    query = F.regexp_extract(url, r"^[^?]*\?([^#]*)", 1)
    columns = {
        "length": F.length(url),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": count(path, "/"),
        "labels": F.when(host == "", 0).otherwise(count(host, ".") + 1),
        "digits": digits(url) / F.greatest(F.octet_length(url), F.lit(1)),
        "host_digits": digits(host),
        "params": F.when(query == "", 0).otherwise(count(query, "&") + 1),
        "query_length": F.length(query),
        "fragment": F.contains(url, F.lit("#")),
        "hyphens": count(url, "-"),
        "longest_part": F.array_max(F.transform(F.split(path, "/"), F.length)),
        "suffix_log_n": F.log1p("n"),
        "suffix_rate": F.col("rate"),
        "suffix_known": F.log1p("known"),
    }
    return [columns[name].cast("double").alias(f"x_{name}") for name in NAMES[1:]]


def entropy(url) -> np.ndarray:
    """Bits a byte of each URL."""
    raw = [u.encode("utf-8", "replace") for u in url]
    size = np.array([len(r) for r in raw], np.int64)
    owner = np.repeat(np.arange(len(raw)), size)
    pair, n = np.unique(owner * 256 + np.frombuffer(b"".join(raw), np.uint8), return_counts=True)
    share = n / size[pair // 256]
    return np.bincount(pair // 256, -share * np.log2(share), len(raw))


class Trees:
    """Boosted regression trees on the log loss, over quantile bins; a tree is a full binary one of fixed depth, a split leaves a curvature of `least` on both sides."""

    def __init__(self, depth: int = 4, rounds: int = 40, rate: float = 0.1, bins: int = 32, least: float = 5.0) -> None:
        self.depth, self.rounds, self.rate, self.bins, self.least = depth, rounds, rate, bins, least
        self.base, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Trees":
        if not len(y) or y.min() == y.max():
            self.base = 10.0 if len(y) and y[0] else -10.0
            return self
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], 1)
        self.base = float(np.log(y.mean() / (1 - y.mean())))
        f = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-f))
            g, h = y - p, p * (1 - p)
            node = np.zeros(len(y), np.int64)
            feature, cutoff = np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, np.inf)
            for level in range(self.depth):
                width, base = 2**level, 2**level - 1
                best = np.full(width, 1e-6)
                for j in range(x.shape[1]):
                    key = node * self.bins + binned[:, j]
                    gs, hs = (np.bincount(key, v, width * self.bins).reshape(width, self.bins) for v in (g, h))
                    gl, hl = gs.cumsum(1)[:, :-1], hs.cumsum(1)[:, :-1]
                    gt, ht = gs.sum(1, keepdims=True), hs.sum(1, keepdims=True)
                    score = lambda a, b: a * a / (b + 1.0)
                    gain = np.where((hl > self.least) & (ht - hl > self.least), score(gl, hl) + score(gt - gl, ht - hl) - score(gt, ht), 0)
                    k = gain.argmax(1)
                    top = gain[np.arange(width), k]
                    for q in np.flatnonzero(top > best):
                        if k[q] < len(edges[j]):
                            best[q], feature[base + q], cutoff[base + q] = top[q], j, edges[j][k[q]]
                node = 2 * node + (x[np.arange(len(y)), feature[base + node]] > cutoff[base + node])
            leaf = np.bincount(node, g, 2**self.depth) / (np.bincount(node, h, 2**self.depth) + 1.0)
            f += self.rate * leaf[node]
            self.trees.append((feature, cutoff, self.rate * leaf))
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.base)
        for feature, cutoff, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                at = 2**level - 1 + node
                node = 2 * node + (x[np.arange(len(x)), feature[at]] > cutoff[at])
            f += leaf[node]
        return 1 / (1 + np.exp(-f))


def with_features(pages: DataFrame, rules=RULES, prior: float = 20.0, hidden: Column | None = None) -> DataFrame:
    """page_id, url, host, path, rule, said (the rule's verdict) and the columns of `lexical`; the labels of a labelled URL's own fold, of five, are not part of its suffix's rate.

    hidden: a condition on url, host and path under which `said` is withheld, for held-out figures.
    """
    rule, said = rule_column(rules)
    urls = parsed(pages).withColumn("rule", rule).withColumn("said", said if hidden is None else F.when(~hidden, said))
    urls = urls.withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(FOLDS)).cast("int"))
    tally = [F.count("*").alias("n")]
    for f in range(FOLDS):
        tally += [F.count_if(F.col("said").isNotNull() & (F.col("fold") == f)).alias(f"known_{f}"), F.count_if((F.col("said") == "block") & (F.col("fold") == f)).alias(f"block_{f}")]
    joined = join_counted(urls, cut(urls.groupBy("suffix").agg(*tally)), "suffix", "n")
    apart = lambda c: sum((F.when(F.col("said").isNotNull() & (F.col("fold") == f), 0).otherwise(F.col(f"{c}_{f}")) for f in range(FOLDS)), F.lit(0))
    joined = joined.withColumn("known", apart("known")).withColumn("rate", (apart("block") + prior / 2) / (F.col("known") + prior))
    return joined.select("page_id", "url", "host", "path", "rule", "said", *lexical())


def fit(features: DataFrame, max_rows: int) -> Trees:
    """Trees over at most max_rows of the labelled URLs, by a hash of the URL."""
    inputs = [f"x_{n}" for n in NAMES[1:]]
    rows = features.where("said IS NOT NULL").select("url", *inputs, (F.col("said") == "block").cast("double").alias("y"))
    sample = rows.orderBy(F.xxhash64("url"), "url", "y", *inputs).limit(max_rows).toPandas()
    return Trees().fit(np.column_stack([entropy(sample["url"]), sample[inputs].to_numpy(float)]), sample["y"].to_numpy(float))


def judged(features: DataFrame, trees: Trees) -> DataFrame:
    """features with p_block, what the trees say of each URL."""
    model = features.sparkSession.sparkContext.broadcast(trees)

    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for url, *x in batches:
            yield pd.Series(model.value.predict(np.column_stack([entropy(url), *(c.to_numpy(float) for c in x)])))

    return features.withColumn("p_block", F.pandas_udf(score, "double")("url", *[f"x_{n}" for n in NAMES[1:]]))


def filter_urls(pages: DataFrame, rules=RULES, max_rows: int = 20_000, prior: float = 20.0) -> DataFrame:
    """page_id, host, path, rule, verdict, p_block (of the trees) per row."""
    features = with_features(pages, rules, prior)
    verdict = F.coalesce("said", F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")).alias("verdict")
    return judged(features, fit(features, max_rows)).select("page_id", "host", "path", "rule", verdict, "p_block")


def op10_url_filter(spark, sf_dir) -> DataFrame:
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
