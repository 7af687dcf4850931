"""From raw documents to tokens, in five stages.

Every stage takes ``(spark, docs, sf_dir)``; what it returns is written as Parquet and
read again for the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from rankdex.llm import bpe, decontamination, line_spread, near_duplicates, quality
from rankdex.llm.queries import held_out, word_vocabulary
from rankdex.scratch import materialise

#: Rows that an executor and its Python workers hand to each other at once. Spark's default
#: of 10,000 is a whole task of documents, held on both sides of every worker.
BATCH_ROWS = 1000
_BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: And bytes, or one row: a batch is held several times over, outside of the executor's heap
#: and in the worker, and what that took is not all given back to the system.
BATCH_BYTES = 1 << 20
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Rows that a Parquet scan decodes at once, whole texts among them.
SCAN_ROWS = 1000
_SCANS = "spark.sql.parquet.columnarReaderBatchSize"


def bound_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batches to ``BATCH_ROWS`` rows and ``BATCH_BYTES``, and its
    Parquet batches to ``SCAN_ROWS`` rows, unless they are smaller. Every stage calls this;
    no result depends on it."""
    for name, most in ((_BATCHES, BATCH_ROWS), (_BYTES, BATCH_BYTES), (_SCANS, SCAN_ROWS)):
        now = spark.conf.get(name)
        size = _bytes(now)
        if size <= 0 or size > most:  # 0 and less: no bound
            spark.conf.set(name, most)


def _bytes(size: str) -> int:
    """The bytes of a size as Spark writes it, like ``64m`` or ``67108864b``."""
    number, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines are good by the conditional random field, which learns from
    the labelled documents outside of the held-out third."""
    bound_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels, ~held_out(F.col("doc_id")))
    return quality.good_documents(docs, model)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sites share, with ``n_chars`` counted anew."""
    bound_batches(spark)
    return line_spread.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, by five-word shingles."""
    bound_batches(spark)
    return near_duplicates.one_of_each(docs, words=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    bound_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.without_contaminated(docs, benchmark)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, and digests of them and of the decoded text."""
    bound_batches(spark)
    return bpe.round_trip(docs, word_vocabulary()).select(
        "doc_id",
        "n_tokens",
        "token_ids",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", good_quality),
    ("lines", without_boilerplate),
    ("near_duplicates", one_of_near_duplicates),
    ("benchmark", without_benchmark),
    ("tokens", tokens),
]

# Sketches, a trained model and BPE are beyond SQL: see the tests instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
