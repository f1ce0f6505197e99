"""Token counts kept by content: a text is encoded once for each version of a tokenizer.

A count is stored under two digests, that of the normalised content and that of
the tokenizer with its version.  Documents are joined to what is stored; of the
contents that are not, each distinct one is encoded, and its count appended.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, discard, materialise

#: Most missing contents whose digests are broadcast, so that the texts already known are not moved.
BROADCAST_MISSES = 200_000
SCHEMA = "digest binary, n_tokens long, tokenizer string"
SPACE = "▁"


@lru_cache(maxsize=2)
def _library(path: str):
    """(function from texts to counts, version of the library); one for each worker process."""
    if path.endswith(".json"):
        import tokenizers

        read = tokenizers.Tokenizer.from_file(path)
        read.no_truncation()
        read.no_padding()
        return (lambda texts: [len(e.ids) for e in read.encode_batch(texts, add_special_tokens=False)]), f"tokenizers {tokenizers.__version__}"
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return (lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]), f"sentencepiece {sentencepiece.__version__}"


def tokenizer_version(path: str) -> str:
    """SHA-256 of the tokenizer's file, its library's version and how it is called: what a stored count depends on."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + f"\n{_library(path)[1]}\nno added tokens, truncation or padding".encode()).hexdigest()


@lru_cache(maxsize=8)
def _spaces_are_marks(path: str) -> bool:
    """Whether the model does nothing to a text but to write its mark for every space."""
    if not path.endswith(".model"):
        return False
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return model.normalize(f" a  {SPACE}b\tﬁ ") == f"{SPACE}{SPACE}a{SPACE}{SPACE}{SPACE}b\tﬁ{SPACE}"


def normalised(text: Column, path: str) -> Column:
    """The content that a count depends on: a null is empty; spaces are the model's mark, if it reads them so."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.replace(text, F.lit(" "), F.lit(SPACE)) if _spaces_are_marks(path) else text


class TokenCache:
    """A Parquet table of counts in a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _exists(self) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(path)

    def stored(self, version: str) -> DataFrame:
        """digest, n_tokens: the counts of one tokenizer version, one a content, though two appends may have met."""
        if not self._exists():
            return self.spark.createDataFrame([], "digest binary, n_tokens long")
        kept = self.spark.read.schema(SCHEMA).parquet(self.folder).where(F.col("tokenizer") == version)
        return kept.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))

    def append(self, counts: DataFrame, version: str) -> None:
        """Add counts; those of a job that fails are not seen, and of one that fails while it commits only whole files are."""
        counts.select("digest", "n_tokens", F.lit(version).alias("tokenizer")).write.partitionBy("tokenizer").mode("append").parquet(self.folder)


def encode_counts(texts: DataFrame, path: str) -> DataFrame:
    """digest, n_tokens of every row of digest, text."""
    arrow_rows(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _library(path)[0]
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count(batch.column(1).to_pylist()), pa.int64())], ["digest", "n_tokens"])

    return texts.mapInArrow(run, "digest binary, n_tokens long")


def token_counts(docs: DataFrame, path: str, folder: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, n_bytes, n_tokens, over_limit, with the cache in ``folder``.

    Whole texts, encoded as the library does by default, without added tokens.
    A null text is empty: no bytes, no tokens.  Bytes that are no UTF-8 are
    counted, and encoded as the replacement mark.  Rows that repeat are rows
    of the result; a null id stays null; other columns are not read.  An empty
    table has no rows and appends none.  ``path`` is read by every worker.
    """
    cache, version = TokenCache(docs.sparkSession, folder), tokenizer_version(path)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), F.make_valid_utf8(text).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2(normalised(F.col("text"), path), 256)))
    missing = materialise(rows.select("digest").distinct().join(cache.stored(version), "digest", "left_anti"), "token-misses")
    misses = missing.count()
    if misses:
        few = misses <= BROADCAST_MISSES
        texts = rows.join(F.broadcast(missing), "digest", "left_semi") if few else rows
        texts = texts.groupBy("digest").agg(F.first("text").alias("text"))
        cache.append(encode_counts(texts if few else texts.join(missing, "digest", "left_semi"), path), version)
    discard(missing)
    counted = rows.drop("text").join(cache.stored(version), "digest", "left")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
