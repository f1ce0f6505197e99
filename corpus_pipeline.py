"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept; all but the last return the columns of ``documents``.  ``run`` applies
them in turn, each written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.llm.common import materialise, table
from lattica.llm.jaccard import similarity_components
from lattica.llm.line_dedup import line_dedup
from lattica.llm.packing import pack, word_bpe
from lattica.llm.pii import replace_pii
from lattica.llm.quality import classify_quality

#: The secret of the surrogates; most document ids that are broadcast.
PII_KEY, BROADCAST_IDS = b"corpus-pipeline-key", 500_000


def _recounted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs``, n_chars as the text now has."""
    length = F.length("text").cast("long").alias("n_chars")
    return docs.select(*[length if c == "n_chars" else F.col(c) for c in columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior of being good is below one half go."""
    return classify_quality(docs, table(spark, sf_dir, "labels")).where("keep").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line matches go, and documents of which no line is left."""
    left = line_dedup(docs, count_col="__removed").where("text is null or text <> '' or __removed = 0")
    return _recounted(left, docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 0.8 of their five-word shingles one stays: that of smallest id.

    Where ids repeat or lack, rows are told apart by a number of their own and the
    first of a group stays, so that rows of one id and different texts both do.
    A blank or null text, and one that links with nothing, stays.
    """
    repeated = docs.groupBy("doc_id").count().where("doc_id is null or count > 1")
    rows, key = docs, "doc_id"
    if not repeated.isEmpty():
        rows, key = materialise(docs.withColumn("__row", F.monotonically_increasing_id()), "pipeline-numbered"), "__row"
    found = materialise(similarity_components(rows, num=80, den=100, words=5, id_col=key), "pipeline-components")
    gone = materialise(found.where("component_id <> doc_id").select(F.col("doc_id").alias(key)).distinct(), "pipeline-gone")
    few = gone.count() <= BROADCAST_IDS
    return rows.join(F.broadcast(gone) if few else gone, key, "left_anti").select(*docs.columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes surrogates."""
    return _recounted(replace_pii(docs, PII_KEY), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2,048 ids."""
    return pack(docs, word_bpe(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("pii", pii), ("packing", packing)]

#: SQL can express neither the fitted model nor the tokenizer; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
