"""Personal data and information-theoretic sanitisation, in DataFrame operations only.

Base spans (e-mail, IP, card and phone numbers) come from regular expressions
over whole texts. A match's place is the running length of what stands before
it, summed by a window over the pieces and matches of its document. Terms that
reveal a protected value are found from the whole corpus: for a term and a value
that share documents, the share of the term's documents that hold the value,
P(value | term), against the value's own share, P(value). Terms seen with a
value in `min_docs` documents or more, with P(value | term) of at least
`disclosure` and log2(P(value | term) / P(value)) of at least `bits`, become
spans too, wherever in the corpus they occur. `sanitise` generalises base spans to their kind and removes terms.

Null and empty texts have no spans. Rows alike in id and text share their spans;
each input row gives one output row, null ids included; empty tables give empty
results; other columns are ignored (sanitise keeps them). Positions are code
points, ends exclusive. The patterns start only where a match can start, and use
possessive loops, so no text costs more than its length or overflows the stack.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .spark_tools import cut, text_key

KINDS = ("email", "ip", "card", "phone", "term")
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = (
    rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++(?:\.[0-9]++){2}\.[0-9]++",
    #: A whole chain of digits; shorter chains than twelve digits would be dropped anyway.
    r"[0-9](?:[\x20-]?[0-9]){11}(?:[\x20-]?[0-9])*+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
HINTS = ("@", ".", None, "+")
TERM = r"\p{L}{4,}"
#: A term, or a whole address, whose words are not terms.
WORD = rf"{PATTERNS[0]}|{TERM}"
KEYS = ("doc_id", "__key")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int") * (1 + F.pmod(F.length(digits) - i, F.lit(2)))
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def acceptable(kind: Column, value: Column) -> Column:
    """The tests that follow a match."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    # leading zeros do not count, however many
    number = lambda p: F.when(p == "", 0).when(F.length(p) <= 3, p.cast("int")).otherwise(999)
    small = F.forall(F.split(value, r"\."), lambda p: number(F.ltrim(p, F.lit("0"))) <= 255)
    return (
        F.when(kind == 0, True)
        .when(kind == 1, small)
        .when(kind == 2, F.when(n.between(12, 19), luhn(digits)).otherwise(False))
        .otherwise(n.between(9, 15))
    )


def matches(docs: DataFrame) -> DataFrame:
    """doc_id, __key, kind, start, end, value."""
    slim = docs.select("doc_id", text_key().alias("__key"), F.col("text").cast("string").alias("text"))
    found = []
    for kind, (pattern, hint) in enumerate(zip(PATTERNS, HINTS, strict=True)):
        likely = F.col("text").contains(hint) if hint else F.lit(True)
        m = F.when(likely, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
        found.append(F.struct(F.lit(kind).alias("kind"), F.coalesce(m, F.array().cast("array<string>")).alias("m")))
    some = slim.where(F.col("text").rlike("[0-9@]")).select(*KEYS, "text", F.explode(F.array(*found)).alias("f")).where(F.size("f.m") > 0)
    pattern = F.get(F.array(*[F.lit(p) for p in PATTERNS]), F.col("f.kind"))
    pieces = some.select(*KEYS, F.col("f.kind").alias("kind"), F.col("f.m").alias("m"), F.split("text", pattern, -1).alias("p"))

    each = F.transform(
        F.sequence(F.lit(0), F.size("m") - 1),
        lambda i: F.struct(
            i.alias("i"),
            F.get("m", i).alias("value"),
            F.length(F.get("p", i)).alias("before"),
        ),
    )
    rows = pieces.select(*KEYS, "kind", F.explode(each).alias("e")).select(*KEYS, "kind", "e.*")
    group = [*KEYS, "kind"]
    # rows alike in id and text are one
    rows = rows.groupBy(*group, "i").agg(*[F.first(c).alias(c) for c in ("value", "before")])
    w = Window.partitionBy(*group).orderBy("i")
    end = F.sum(F.col("before") + F.length("value")).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")
    placed = rows.select(*group, "value", (end - F.length("value")).alias("start"), end.alias("end"))
    return placed.where(acceptable(F.col("kind"), F.col("value")))


def _terms(text: Column) -> Column:
    """The distinct terms of a text, in lower case."""
    words = F.filter(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: ~F.contains(w, F.lit("@")))
    return F.array_distinct(F.transform(words, F.lower))


def _if_few(rows: DataFrame, max_broadcast: int) -> DataFrame:
    return F.broadcast(rows) if rows.limit(max_broadcast + 1).count() <= max_broadcast else rows.hint("merge")


def _holding(docs: DataFrame, keys: DataFrame, max_broadcast: int) -> DataFrame:
    """doc_id, __key and text of the documents whose keys are given."""
    slim = docs.select("doc_id", text_key().alias("__key"), F.col("text").cast("string").alias("text")).alias("d")
    return slim.join(_if_few(keys, max_broadcast).alias("k"), F.expr("d.doc_id <=> k.doc_id AND d.__key = k.__key"), "left_semi")


def occurrences(docs: DataFrame, terms: DataFrame, max_broadcast: int) -> DataFrame:
    """doc_id, __key, start, end of every place of the terms in all documents; only documents that hold one are cut into words."""
    terms = _if_few(terms, max_broadcast)
    said = docs.select("doc_id", text_key().alias("__key"), F.explode(_terms(F.col("text").cast("string"))).alias("term"))
    having = cut(said.join(terms, "term", "left_semi").select(*KEYS).distinct())
    # rows alike in id and text are one
    texts = _holding(docs, having, max_broadcast).dropDuplicates(KEYS)
    pieces = texts.select(*KEYS, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("m"), F.split("text", WORD, -1).alias("p"))
    each = F.transform(F.sequence(F.lit(0), F.size("m") - 1), lambda i: F.struct(i.alias("i"), F.get("m", i).alias("word"), F.length(F.get("p", i)).alias("before")))
    rows = pieces.select(*KEYS, F.explode(each).alias("e")).select(*KEYS, "e.*")
    w = Window.partitionBy(*KEYS).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("before") + F.length("word")).over(w).cast("int")
    placed = rows.select(*KEYS, F.lower("word").alias("term"), (end - F.length("word")).alias("start"), end.alias("end"))
    return placed.join(terms, "term", "left_semi").select(*KEYS, "start", "end")


def revealing_terms(docs: DataFrame, found: DataFrame, min_docs: int = 2, disclosure: float = 0.5, bits: float = 4.0, max_broadcast: int = 200_000) -> DataFrame:
    """doc_id, __key, start, end of every occurrence, in all documents, of the terms that reveal a value.

    A term and a value meet where one document holds both, however far apart.
    Before they are paired, values and terms go whose counts alone rule out any
    passing pair: n_both is at most n_value, and P(value | term) at most 1. Up to
    max_broadcast rows of documents, terms or values are broadcast; more of them
    are joined by a shuffle.
    """
    n_docs = docs.agg(F.count("*").alias("n_docs"))
    holders = found.select(F.xxhash64("kind", "value").alias("value"), *KEYS).distinct()
    values = holders.groupBy("value").agg(F.count("*").alias("n_value")).where(F.col("n_value") >= min_docs)
    values = values.join(F.broadcast(n_docs)).where(F.log2(F.col("n_docs") / F.col("n_value")) >= bits)  # one row
    held = cut(holders.join(values, "value"))
    texts = _holding(docs, cut(held.select(*KEYS).distinct()), max_broadcast)
    theirs = cut(texts.select(*KEYS, F.explode(_terms(F.col("text"))).alias("term")).distinct())
    wanted = cut(theirs.groupBy("term").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("term"))
    # every such term's documents, over the whole corpus
    terms = docs.select(F.explode(_terms(F.col("text").cast("string"))).alias("term"))
    if wanted.limit(max_broadcast + 1).count() <= max_broadcast:
        with_term = terms.join(F.broadcast(wanted), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n_term"))
    else:
        with_term = terms.groupBy("term").agg(F.count("*").alias("n_term")).join(wanted.hint("merge"), "term", "left_semi")
    share = lambda n: F.col(n) / F.greatest("n_term", n)
    most = held.agg(F.max("n_value").alias("most"))
    rare = cut(with_term.join(F.broadcast(most)).where(share("most") >= disclosure).select("term", "n_term"))  # one row
    said = theirs.join(_if_few(rare, max_broadcast), "term").alias("d")
    pairs = said.join(_if_few(held, max_broadcast).alias("k"), F.expr("d.doc_id <=> k.doc_id AND d.__key = k.__key")).where(share("n_value") >= disclosure)
    together = pairs.groupBy("value", "term", "n_value", "n_term", "n_docs").agg(F.count("*").alias("n_both")).where(F.col("n_both") >= min_docs)
    telling = together.where((share("n_both") >= disclosure) & (F.log2(share("n_both") * F.col("n_docs") / F.col("n_value")) >= bits))
    return occurrences(docs, cut(telling.select("term").distinct()), max_broadcast)


def find_spans(docs: DataFrame, **thresholds) -> DataFrame:
    """doc_id, __key, spans array<struct<start,kind,end>> of the documents that have any."""
    found = cut(matches(docs))
    terms = revealing_terms(docs, found, **thresholds)
    every = found.select(*KEYS, "start", "kind", "end").union(terms.select(*KEYS, "start", F.lit(len(KINDS) - 1), "end")).distinct()
    # a term goes if a base span covers a part of it: one that begins no later, or one that begins inside
    base = F.col("kind") < len(KINDS) - 1
    up, down = Window.partitionBy(*KEYS).orderBy("start"), Window.partitionBy(*KEYS).orderBy(F.desc("start"))
    reach = F.max(F.when(base, F.col("end"))).over(up.rangeBetween(Window.unboundedPreceding, 0))
    next_one = F.min(F.when(base, F.col("start"))).over(down.rangeBetween(Window.unboundedPreceding, 0))
    covered = (F.coalesce(reach, F.lit(0)) > F.col("start")) | (F.coalesce(next_one, F.col("end")) < F.col("end"))
    apart = every.withColumn("covered", covered).where(base | ~F.col("covered"))
    return apart.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))


def op9_pii(spark, sf_dir) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find_spans(docs)
    rows = docs.select("doc_id", text_key().alias("__key")).alias("d").join(found.alias("f"), F.expr("d.doc_id <=> f.doc_id AND d.__key = f.__key"), "left")
    names = F.array(*[F.lit(k) for k in KINDS])
    said = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")
    spans = F.coalesce("spans", F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    rows = rows.select("d.doc_id", spans.alias("spans"))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    return rows.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:4])],
        F.sha2(said(F.filter("spans", lambda x: x["kind"] < 4)), 256).alias("base_sha256"),
        said(F.col("spans")).alias("spans"),
        count(4).alias("n_term"),
    )


def sanitise(docs: DataFrame, **thresholds) -> DataFrame:
    """docs with all their columns; base spans replaced by their kind in brackets, revealing terms removed; n_chars, if there, follows."""
    found = find_spans(docs, **thresholds)
    # overlapping spans become one, named after the first
    w = Window.partitionBy(*KEYS).orderBy("s.start", "s.kind", "s.end")
    rows = found.select(*KEYS, F.explode("spans").alias("s")).withColumn("reach", F.max("s.end").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("nth", F.sum(F.when(F.col("s.start") < F.col("reach"), 0).otherwise(1)).over(w))
    one = rows.groupBy(*KEYS, "nth").agg(F.min("s").alias("s"), F.max("s.end").alias("end"))
    joined = one.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct(F.col("s.start").alias("start"), "end", F.col("s.kind").alias("kind")))).alias("spans"))
    out = docs.alias("d").join(joined.alias("j"), F.col("d.doc_id").eqNullSafe(F.col("j.doc_id")) & (text_key("d.text") == F.col("j.__key")), "left")
    text, spans = F.col("d.text").cast("string"), F.col("j.spans")
    labels = F.array(*[F.lit(f"[{k.upper()}]" if k != "term" else "") for k in KINDS])
    begin = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(spans, i - 1)["end"])
    part = lambda i: F.concat(F.substring(text, begin(i) + 1, F.get(spans, i)["start"] - begin(i)), F.get(labels, F.get(spans, i)["kind"]))
    n = F.size(spans)
    new = F.concat(F.array_join(F.transform(F.sequence(F.lit(0), n - 1), part), ""), F.substring(text, begin(n) + 1, F.length(text)))
    own = {c: F.col(f"d.`{c}`") for c in docs.columns}
    put = {"text": F.when(spans.isNotNull(), new).otherwise(text)}
    if "n_chars" in own:
        put["n_chars"] = F.when(spans.isNotNull(), F.length(new).cast(docs.schema["n_chars"].dataType)).otherwise(own["n_chars"])
    return out.select(*[put.get(c, x).alias(c) for c, x in own.items()])
