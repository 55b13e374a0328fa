"""A corpus pipeline of five of the corpus operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of docs, in their order, whatever their names. A stage's
output is written as Parquet and read again as the next one's docs. Every stage
takes nulls in any column, empty and very long texts, ties, repeated rows and
empty tables; what becomes of them is said in the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pointmill.llm import decontaminate, near_dedup, packing, pii, toxicity
from pointmill.llm.spark_tools import cut


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity, learnt from all labels; documents scored 0.3 or more go.

    Null and empty texts, and texts without words, score 0 and stay. Repeated rows
    score alike and go or stay together, however long; null ids are judged like
    others but teach nothing. Without labels of both kinds each text with words
    scores the rate of label 1. No rows give no rows.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8: one document of each group stays.

    The smallest doc_id of a group stays, with all rows that share it, repeated rows
    too. Null and empty texts link with nothing and stay, as do rows with a null id;
    texts of under five words are one shingle. Sets are those of whole texts. No rows
    give no rows.
    """
    return near_dedup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go.

    Null and empty texts hold none and stay; repeated rows and null ids are judged by
    their own texts, whole ones. Null items and ids of items are no items; without
    items all documents stay. No rows give no rows.
    """
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data generalised, revealing terms removed.

    Every row stays, null and empty texts as they are; n_chars follows a changed text.
    Rows alike in id and text change alike and count as the rows they are. Overlapping
    spans become one, named after the first, ties by kind. No rows give no rows.
    """
    return pii.sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 2048.

    Null and empty texts are the one id 0; each row, repeated or without an id, is a
    document of its own; only texts of more than 2048 ids are cut. Ties among equal
    lengths go by id, piece, start and checksum. Only doc_id and text are read, other
    columns are not returned. No rows give no rows.
    """
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pii", sanitise),
    ("packing", pack),
]

#: Learnt scores and packing are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
