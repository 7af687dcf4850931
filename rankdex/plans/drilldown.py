"""From documents on: their topics, their related documents, single documents."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F

from rankdex.functions.literals import normalise, related_entries
from rankdex.functions.numbers import prefix_long
from rankdex.operators.lookup import fetch
from rankdex.plans.keyword_search import search
from rankdex.scratch import materialise


def topic_queries(documents: DataFrame, topics: str = "topics") -> DataFrame:
    """Each distinct topic of the array column ``topics`` as a query."""
    topic = documents.select(F.explode(topics).alias("topic")).distinct()
    return topic.select("topic", F.col("topic").alias("query"))


def search_topics(
    documents: DataFrame,
    postings: DataFrame,
    topics: str = "topics",
    key: str = "doc_id",
    page: int = 1,
    stem: bool = True,
) -> DataFrame:
    """One page of hits for every topic of ``documents``, by ``topic``."""
    queries = materialise(topic_queries(documents, topics), "topics")
    return search(queries, postings, documents, page, key, "topic", "query", stem)


def expand_related(
    documents: DataFrame, targets: DataFrame, key: str = "doc_id", related: str = "related"
) -> DataFrame:
    """Every entry of the map column ``related`` with the document of ``targets``
    that it links to, its columns prefixed ``target_``. ``targets`` has the key and
    the columns to show; links to documents it lacks are left out."""
    links = materialise(related_entries(documents, key, related), "links")
    shown = targets.select(
        F.col(key).alias("related_id"),
        *(F.col(c).alias(f"target_{c}") for c in targets.columns if c != key),
    )
    return fetch(links, shown, "related_id", key)


def detail_lookup(
    requests: DataFrame,
    documents: DataFrame,
    request_id: str = "request_id",
    raw_id: str = "raw_id",
    key: str = "doc_id",
    lists: Iterable[str] = (),
    maps: Iterable[str] = (),
    hosts: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """The document of each request, whose raw id is read like ``12abc`` -> 12.
    Requests without a leading integer, or for no document, are left out. The text
    columns ``lists``, ``maps`` and ``hosts`` are parsed once fetched, see ``normalise``."""
    wanted = requests.select(request_id, prefix_long(F.col(raw_id)).alias(key))
    wanted = materialise(wanted.where(F.col(key).isNotNull()), "requests")
    return normalise(fetch(wanted, documents, key, request_id), lists, maps, hosts)
