"""The inverted index: one row per keyword and document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rankdex.functions.text import distinct_stems, words
from rankdex.scratch import materialise

PAGE_SIZE = 15  # Fixed value: hits on a page.
PAGES = 5  # Fixed value: pages that a search offers.
DEPTH = PAGE_SIZE * PAGES
# Parts of a keyword when heads are stored.
HEAD_PARTS = 64


def inverted_index(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    stem: bool = True,
    unique_key: bool = True,
) -> DataFrame:
    """Distinct ``(keyword, doc_id)`` pairs of whole texts.

    A document's words are made distinct, and stemmed, inside its row, so building
    needs no shuffle. Only where several rows share a key (``unique_key=False``) are
    pairs made distinct across rows.
    """
    documents = documents.select(key, text)
    keywords = words(F.col(text))
    if stem:
        pairs = distinct_stems(documents, keywords, key)
    else:
        pairs = documents.select(F.explode(keywords).alias("keyword"), F.col(key).alias("doc_id"))
    return pairs if unique_key else pairs.distinct()


def posting_heads(postings: DataFrame, depth: int = DEPTH, parts: int = 1) -> DataFrame:
    """The ``depth`` lowest document ids of each keyword, as one ascending array.

    This is all that the first ``depth`` hits of any query can need: a document
    beyond the first ``depth`` of its first matching word has ``depth`` hits
    before it. Each task keeps ``depth`` rows per keyword before the shuffle. With
    ``parts``, a keyword of very many tasks is first cut in so many parts, so that no
    task gets ``depth`` rows from each of them.
    """
    if parts > 1:
        part = F.pmod(F.xxhash64("doc_id"), F.lit(parts))
        in_part = Window.partitionBy("keyword", part).orderBy("doc_id")
        postings = postings.withColumn("_n", F.row_number().over(in_part)).where(F.col("_n") <= depth)
    by_id = Window.partitionBy("keyword").orderBy("doc_id")
    first = postings.withColumn("_n", F.row_number().over(by_id)).where(F.col("_n") <= depth)
    return first.groupBy("keyword").agg(F.sort_array(F.collect_list("doc_id")).alias("doc_ids"))


def write_index(postings: DataFrame, path: str) -> None:
    """Store an index: all postings, then the heads that searches read.

    Both are partitioned by ranges of keywords and sorted within their files, so a
    search reads only files and row groups whose range holds one of its words. A
    keyword of a third of all documents spreads over many files of postings. The
    postings are stored before they are sorted, because finding the ranges takes a pass
    of its own, which should not read and stem all texts again; heads are made from
    the sorted ones. They come last, so an index without them is not finished.
    """
    by_keyword = ("keyword", "doc_id")
    materialise(postings, "postings").repartitionByRange(*by_keyword).sortWithinPartitions(
        *by_keyword
    ).write.parquet(f"{path}/postings")
    heads = materialise(posting_heads(read_postings(postings.sparkSession, path), parts=HEAD_PARTS), "heads")
    heads.repartitionByRange("keyword").sortWithinPartitions("keyword").write.parquet(f"{path}/heads")


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/postings")


def read_heads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/heads")
