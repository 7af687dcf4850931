"""Documents and network nodes, paired by popularity."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rankdex.operators.pairing import pair_in_order
from rankdex.operators.ranking import follower_count
from rankdex.scratch import materialise
from rankdex.sources.keyed_table import KeyedTable


def pair_by_popularity(
    documents: DataFrame,
    edges: DataFrame,
    key: str = "talk_id",
    views: str = "views",
    followed: str = "followed",
    lexical: bool = False,
) -> DataFrame:
    """``(ix, key, social_id)``: the most viewed document with the most followed
    node, and so on; ties by id. Only ids and sort keys move, and of the longer side
    only about as many as the shorter one has."""
    value = F.col(views).cast("string") if lexical else F.col(views)
    ranked = documents.select(key, value.alias("_views"))
    nodes = follower_count(edges, followed).withColumnsRenamed({"node_id": "social_id", "followers": "_followers"})
    paired = pair_in_order(
        ranked, [("_views", False), (key, True)], nodes, [("_followers", False), ("social_id", True)]
    )
    return paired.select("ix", key, "social_id")


def load_popularity(
    table: KeyedTable,
    documents: DataFrame,
    edges: DataFrame,
    views: str = "views",
    followed: str = "followed",
    lexical: bool = False,
) -> None:
    """Put ``documents`` into ``table`` with the node paired with each in ``social_id``,
    as one version.

    Of documents with the same key the one with the fewest views is kept, ties by the
    other columns, and the nodes of all of them are summed; a ``social_id`` that
    documents bring is added to. They are stored once at the start, so a source that
    is slow to read is read once.
    """
    documents = materialise(documents, "documents")
    value = F.col(views).cast("string") if lexical else F.col(views)
    paired = pair_by_popularity(documents, edges, table.key, views, followed, lexical)
    sums = paired.groupBy(table.key).agg(F.sum("social_id").alias("_sum"))
    sums = materialise(sums, "paired")
    own = F.col("social_id") if "social_id" in documents.columns else F.lit(None).cast("long")
    total = F.when(F.col("_sum").isNull(), own).otherwise(F.coalesce(own, F.lit(0)) + F.col("_sum"))
    joined = documents.join(sums, table.key, "left").withColumn("social_id", total).drop("_sum")
    table.put(joined.select(*dict.fromkeys([*documents.columns, "social_id"])), order_by=[value], keep="first")
