"""A table of queries against an index and its documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rankdex.functions.text import valid_query
from rankdex.operators.lookup import fetch
from rankdex.operators.postings import PAGE_SIZE, PAGES
from rankdex.operators.search import page_hits, query_bags, result_pages
from rankdex.scratch import materialise


def search_pages(
    queries: DataFrame,
    index: DataFrame,
    page: int = 1,
    query_id: str = "query_id",
    query: str = "query",
    stem: bool = True,
    compat: bool = False,
    only_valid: bool = False,
) -> DataFrame:
    """One row per query with the labels and hits of one page; see ``result_pages``.

    ``index`` holds postings, blocks or heads; there are ``PAGES`` pages with any.
    ``query_id`` is unique.
    ``only_valid`` leaves out queries that are empty or hold anything but ASCII
    letters and spaces.
    """
    if not 1 <= page <= PAGES:
        raise ValueError(f"pages are 1 to {PAGES}, not {page}")
    if only_valid:
        queries = queries.where(valid_query(F.col(query)))
    bags = query_bags(queries, index, PAGE_SIZE * page, query_id, query, stem)
    return result_pages(bags, page, PAGE_SIZE, compat)


def search(
    queries: DataFrame,
    index: DataFrame,
    documents: DataFrame,
    page: int = 1,
    key: str = "doc_id",
    query_id: str = "query_id",
    query: str = "query",
    stem: bool = True,
    compat: bool = False,
    only_valid: bool = False,
) -> DataFrame:
    """The hits of one page with their documents, in any row order: ``rank`` tells
    the place. The hits, ids only, are found and stored first; then their documents
    are fetched. A hit without document is left out and leaves its rank empty; count
    those with ``rankdex.operators.lookup.missing``."""
    pages = search_pages(queries, index, page, query_id, query, stem, compat, only_valid)
    hits = materialise(page_hits(pages, key), "hits")
    return fetch(hits, documents, key, query_id)
