"""Keyword search for a table of queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rankdex.functions.text import query_words, stem_words
from rankdex.operators.lookup import LIMITS, Limits, measure, only_asked, spread_join
from rankdex.operators.posting_blocks import block_heads
from rankdex.operators.postings import DEPTH, PAGE_SIZE, posting_heads
from rankdex.scratch import materialise


def query_terms(
    queries: DataFrame, query_id: str = "query_id", query: str = "query", stem: bool = True
) -> DataFrame:
    """One row per word that is looked up: the query, the word's position and the
    keyword. A query without words keeps one row without keyword."""
    keywords = query_words(F.col(query))
    if stem:
        keywords = stem_words(keywords)
    return queries.select(F.col(query_id), F.posexplode_outer(keywords).alias("pos", "keyword"))


def query_bags(
    queries: DataFrame,
    index: DataFrame,
    depth: int,
    query_id: str = "query_id",
    query: str = "query",
    stem: bool = True,
    limits: Limits = LIMITS,
) -> DataFrame:
    """One row per query: the documents of its first word in id order, then those of
    the second, and so on, repeats kept, at most ``depth`` of each word.

    ``index`` holds postings, blocks of them, or their heads. The terms of the queries are stored
    first and measured; see ``only_asked`` for what that saves on the index. A query
    id that occurs twice is an error.
    """
    terms = materialise(query_terms(queries, query_id, query, stem), "terms")
    starts = terms.where(F.col("pos").isNull() | (F.col("pos") == 0)).groupBy(query_id).count()
    if not starts.where("count > 1").isEmpty():
        raise ValueError(f"{query_id} is not unique")
    rows, size = measure(terms)
    index = only_asked(index, terms, "keyword", rows, size, limits)
    if "gaps" in index.columns:
        heads = block_heads(index, depth)
    elif "doc_ids" not in index.columns:
        heads = posting_heads(index, depth)
    elif depth <= DEPTH:
        heads = index.withColumn("doc_ids", F.slice("doc_ids", 1, depth))
    else:
        raise ValueError(f"stored heads hold {DEPTH} documents per keyword, not {depth}")
    # The heads of all terms take at most depth ids per term, and their keywords.
    asked = terms.where(F.col("keyword").isNotNull())
    if rows * depth * 8 + size <= limits.broadcast_bytes:
        found = asked.join(F.broadcast(heads), "keyword", "left")
    else:
        found = spread_join(asked, heads, "keyword", query_id, rows, "left", limits)
    # Queries without words are not joined: their rows have no keyword to spread by.
    nothing = F.lit(None).cast(heads.schema["doc_ids"].dataType)
    none = terms.where(F.col("keyword").isNull()).withColumn("doc_ids", nothing)
    found = found.unionByName(none)
    found = found.withColumn("doc_ids", F.coalesce("doc_ids", F.array()))
    # A query has at most 15 rows, one per word looked up, of at most depth ids each.
    by_word = F.sort_array(F.collect_list(F.struct("pos", "doc_ids")))
    return found.groupBy(query_id).agg(
        F.flatten(F.transform(by_word, lambda word: word["doc_ids"])).alias("bag")
    )


def result_pages(
    bags: DataFrame, page: int, page_size: int = PAGE_SIZE, compat: bool = False
) -> DataFrame:
    """One row per query: the labels ``low`` and ``high`` of page ``page`` and its
    documents in rank order.

    Hits are the distinct documents of the bag in order of first occurrence, cut
    into pages. With ``compat``, page 2 and later start after ``page_size * (page -
    1) - 1`` documents of the bag, repeats counted, so the last hit of a page may
    come back on the next one. The depth of the bag has to be ``page_size * page``
    or more, for both.
    """
    skipped = page_size * (page - 1)
    if compat and page > 1:
        rest = F.slice("bag", skipped, F.greatest(F.size("bag"), F.lit(1)))
        hits = F.slice(F.array_distinct(rest), 1, page_size)
    else:
        hits = F.slice(F.array_distinct("bag"), skipped + 1, page_size)
    return bags.withColumn("hits", hits).select(
        *(c for c in bags.columns if c != "bag"),
        F.lit(page).alias("page"),
        F.lit(skipped + 1).alias("low"),
        (F.size("hits") + skipped).alias("high"),
        "hits",
    )


def page_hits(pages: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per hit, with its rank."""
    return pages.select(
        *(c for c in pages.columns if c != "hits"),
        F.posexplode("hits").alias("_at", key),
    ).withColumn("rank", F.col("low") + F.col("_at")).drop("_at")
