"""A Merkle manifest of a document table: checkpoint and recompute.

Each row is a leaf; per source the leaves ascend by doc_id and every three
consecutive nodes become one, level by level, until one is left; these subroots,
ordered by source, make a tree of the same kind. Only the leaves and every
`every`-th level above them are written to the shared folder. A stored node
covers an aligned subtree of 3**every nodes of the stored level below, so a group
is bounded whatever a source holds. Proofs go from the top down: a stored node's
siblings up to the root are known before its subtree is entered; the subtree's
missing interior nodes are made again from the stored level below it, give the
siblings of its members, and are dropped. Digests are those of SHA-256, as hex
text, all in Spark's own functions.

Nulls: a null field counts as `-`; a null source is a source of its own, the
first; null doc_ids come first in their source. Ties of doc_id go by digest, and
rows alike in all five fields are leaves of their own next to each other, so each
row gives one row. Empty texts are values, not nulls. Tampering leaves rows
without an id alone. An empty table has no root and gives no rows. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .spark_tools import cut

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column | str) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def tree_key(source: Column) -> Column:
    """A source without nulls, in the order of sources, null first."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


@dataclass(frozen=True)
class Forest:
    """Trees by key: stored[j] has (tree, pos, node, m), the nodes of level j * every with their number m in the tree."""

    stored: list[DataFrame]
    every: int

    def roots(self) -> DataFrame:
        return self.stored[-1].select("tree", F.col("node").alias("root"))


@dataclass(frozen=True)
class Manifest:
    sources: Forest
    top: Forest

    def root(self) -> DataFrame:
        """One row with the root, or none for an empty table."""
        return self.top.roots().select("root")


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds pos (from 0, by `order` within `tree`) and m, the tree's number of rows.

    One range sort over all trees, so that a tree may span any number of tasks; a
    part's share of a tree is counted and the counts, a row for each part and tree,
    give the places.
    """
    by = ["tree", *order]
    # rows alike in all of `order` may be many: their row numbers let the range sort part them
    ranged = rows.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(*by, "__row").sortWithinPartitions(*by, "__row")
    ranged = cut(ranged.drop("__row").withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", 33).alias("__part")
    counts = ranged.groupBy("tree", part).agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    whole, before = Window.partitionBy("tree"), Window.partitionBy("tree").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("tree", "__part", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"), F.sum("__n").over(whole).alias("m"))
    at = ranged.withColumn("__part", F.shiftright("__at", 33)).join(counts, ["tree", "__part"])
    return at.withColumn("pos", F.col("__base") + F.col("__at") - F.col("__first")).drop("__part", "__at", "__first", "__base")


def _parents(nodes: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / ARITY).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(nodes, i * ARITY + 1, ARITY), ""), 256))


def _steps(m: Column, every: int) -> Column:
    """How many of the next `every` levels a tree of m nodes has: while several remain."""
    return F.size(F.filter(F.array(*[F.lit(ARITY**k) for k in range(every)]), lambda p: p < m))


def _levels(nodes: Column, steps: Column, every: int) -> Column:
    """The levels of a subtree over its lowest nodes, as an array of arrays."""
    rounds = F.slice(F.sequence(F.lit(1), F.lit(every)), 1, steps)
    return F.aggregate(rounds, F.array(nodes), lambda levels, _: F.concat(levels, F.array(_parents(F.element_at(levels, -1)))))


def _subtrees(nodes: DataFrame, every: int, keep: list[str] = ()) -> DataFrame:
    """One row for each aligned subtree: tree, pos (of its root, `every` levels up), m, members by place, levels."""
    up = F.expr(f"pos div {ARITY**every}").alias("up")
    groups = nodes.groupBy("tree", up).agg(F.first("m").alias("m"), F.sort_array(F.collect_list(F.struct("pos", "node", *keep))).alias("members"))
    levels = _levels(F.col("members.node"), _steps(F.col("m"), every), every)
    return groups.select("tree", F.col("up").alias("pos"), "m", "members", levels.alias("levels"))


def forest(leaves: DataFrame, every: int = 5) -> Forest:
    """leaves: a written table of (tree, pos, node, m). Writes every `every`-th level until each tree has one node."""
    stored = [leaves]
    most = leaves.agg(F.max("m")).first()[0] or 0
    while most > 1:
        root = F.element_at(F.element_at("levels", -1), 1)
        m = F.expr(f"(m + {ARITY**every - 1}) div {ARITY**every}")
        stored.append(cut(_subtrees(stored[-1].select("tree", "pos", "node", "m"), every).select("tree", "pos", root.alias("node"), m.alias("m"))))
        most = -(-most // ARITY**every)
    return Forest(stored, every)


def _siblings(levels: Column, i: Column, every: int) -> Column:
    """Of member i of a subtree: (left, right) of its run on each level, from the lowest."""
    powers = F.array(*[F.lit(ARITY**k) for k in range(every)])

    def at(k: Column) -> Column:
        place = F.floor(i / F.get(powers, k)).cast("int")
        level, turn = F.get(levels, k), place % ARITY
        left = F.slice(level, place - turn + 1, turn)
        right = F.slice(level, place + 2, F.lit(ARITY - 1) - turn)
        return F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))

    return F.transform(F.slice(F.sequence(F.lit(0), F.lit(every - 1)), 1, F.size(levels) - 1), at)


def proofs(trees: Forest, above: DataFrame, finish, keep: list[str] = ()) -> DataFrame:
    """finish(member, path) for each leaf: a struct whose fields become the columns, beside tree.

    above: (tree, path, ...), what lies over each tree's root, other columns come along.
    A path is an array of (left, right), the siblings of each level up to the root.
    """
    extra = [c for c in above.columns if c not in ("tree", "path")]
    known = trees.stored[-1].select("tree", "pos").join(above, "tree")
    whole = lambda levels, i: F.concat(_siblings(levels, i, trees.every), F.col("path"))
    for nodes in trees.stored[-2:0:-1]:
        inner = _subtrees(nodes, trees.every).join(known, ["tree", "pos"])
        paths = F.transform("members", lambda x, i: F.struct(x["pos"].alias("pos"), whole(F.col("levels"), i).alias("path")))
        known = cut(inner.select("tree", *extra, F.explode(paths).alias("p")).select("tree", *extra, "p.*"))
    leaves = trees.stored[0]
    if len(trees.stored) == 1:
        alone = leaves.join(known, ["tree", "pos"])
        return alone.select("tree", *extra, finish(F.struct("pos", "node", *keep), F.col("path")).alias("p")).select("tree", *extra, "p.*")
    inner = _subtrees(leaves, trees.every, keep).join(known, ["tree", "pos"])
    ends = F.transform("members", lambda x, i: finish(x, whole(F.col("levels"), i)))
    return inner.select("tree", *extra, F.explode(ends).alias("p")).select("tree", *extra, "p.*")


def folded(node: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, node, lambda below, s: digest(s["left"], below, s["right"]))


def leaves_of(docs: DataFrame, **variants: Column) -> DataFrame:
    """doc_id, tree, node and, for each variant, the digest of the row with that text instead."""
    rows = docs.select(*[F.col(c).alias(c) for c in FIELDS])
    of = lambda text: digest(*[field(F.col(c)) for c in FIELDS[:-1]], field(text))
    return rows.select("doc_id", tree_key(F.col("source")).alias("tree"), of(F.col("text")).alias("node"), *[of(v).alias(k) for k, v in variants.items()])


def build(leaves: DataFrame, every: int = 5) -> Manifest:
    """The manifest of rows (tree, doc_id, node, ...), whose other columns stay with the leaves."""
    sources = forest(cut(placed(cut(leaves), ["doc_id", "node"])), every)
    subroots = sources.roots().select(F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("root").alias("node"))
    return Manifest(sources, forest(cut(placed(subroots, ["source"])), every))


def manifest(docs: DataFrame, every: int = 5) -> Manifest:
    return build(leaves_of(docs), every)


def prove(made: Manifest, finish, keep: list[str] = ()) -> DataFrame:
    """finish(member, path) of every leaf, with its tree, subroot and root."""
    root = made.root()
    ends = lambda x, path: F.struct(x["source"].alias("key"), x["node"].alias("subroot"), path.alias("path"))
    none = F.array().cast("array<struct<left:string,right:string>>")
    top = proofs(made.top, made.top.roots().select("tree", none.alias("path")), ends, ["source"])
    above = cut(top.join(F.broadcast(root)).select(F.col("key").alias("tree"), "path", "subroot", "root"))  # root: one row
    return proofs(made.sources, above, finish, keep)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tampers = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    leaves = leaves_of(docs, changed=F.when(tampers, F.translate("text", "\n", "")).otherwise(F.col("text")))

    def finish(member: Column, path: Column) -> Column:
        siblings = F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")
        return F.struct(
            member["doc_id"].alias("doc_id"),
            member["node"].alias("leaf"),
            F.sha2(siblings, 256).alias("proof_sha256"),
            folded(member["changed"], path).alias("folded_root"),
        )

    rows = prove(build(leaves), finish, ["doc_id", "changed"])
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql() -> str:
    one = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c} END"
    row = lambda text: "sha256(" + " || ".join([*(one(c) for c in FIELDS[:-1]), one(text)]) + ")"
    levels = lambda name, start: f"""{name} AS ({start}
  UNION ALL SELECT tree, k + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3 FROM {name} WHERE n > 1 GROUP BY tree, k, pos // 3, n)"""  # noqa: E731
    path = lambda table, stage: f"""SELECT l.rid, {stage} AS stage, s.k, string_agg(s.node, '' ORDER BY s.pos) FILTER (s.pos < l.{table}_pos // CAST(3 ** s.k AS BIGINT)) AS a,
  string_agg(s.node, '' ORDER BY s.pos) FILTER (s.pos > l.{table}_pos // CAST(3 ** s.k AS BIGINT)) AS b
  FROM leaf l JOIN {table} s ON s.tree = l.{table}_tree AND s.n > 1 AND s.pos // 3 = l.{table}_pos // CAST(3 ** (s.k + 1) AS BIGINT) GROUP BY l.rid, s.k"""  # noqa: E731
    crc = "list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, o: CASE WHEN o >= 0 THEN xor(c, o) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    return f"""WITH RECURSIVE d AS (SELECT *, CASE WHEN xor({crc}, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other FROM documents),
h AS (SELECT doc_id, coalesce('=' || source, '-') AS tree, {row('text')} AS node, {row('other')} AS changed FROM d),
p AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, node) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM h),
{levels('src', 'SELECT tree, 0 AS k, pos, node, n FROM p')},
sub AS (SELECT tree, node, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM src WHERE n = 1),
{levels('top', "SELECT '' AS tree, 0 AS k, pos, node, n FROM sub")},
leaf AS (SELECT row_number() OVER () AS rid, p.doc_id, p.node, p.changed, p.tree AS src_tree, p.pos AS src_pos, sub.node AS subroot, '' AS top_tree, sub.pos AS top_pos FROM p JOIN sub USING (tree)),
steps AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY stage, k) AS step FROM ({path('src', 0)} UNION ALL {path('top', 1)})),
fold AS (SELECT rid, CAST(1 AS BIGINT) AS step, changed AS node FROM leaf UNION ALL SELECT f.rid, f.step + 1, sha256(coalesce(a, '') || f.node || coalesce(b, '')) FROM fold f JOIN steps s ON s.rid = f.rid AND s.step = f.step),
ends AS (SELECT rid, max_by(node, step) AS folded FROM fold GROUP BY rid), whole AS (SELECT rid, string_agg(coalesce(a, '') || coalesce(b, ''), '' ORDER BY step) AS siblings FROM steps GROUP BY rid)
SELECT doc_id, leaf.node AS leaf, subroot, t.node AS root, sha256(coalesce(siblings, '')) AS proof_sha256, folded AS folded_root, folded = t.node AS verified FROM leaf JOIN ends USING (rid) LEFT JOIN whole USING (rid), (SELECT node FROM top WHERE n = 1) t"""


ORACLE_SQL = _sql()
