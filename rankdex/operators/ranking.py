"""Follower counts and dense global ranks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from rankdex.scratch import materialise

# monotonically_increasing_id() is the partition number times 2**33 plus the row's
# place in its partition.
_PLACE_BITS = 33


def follower_count(edges: DataFrame, followed: str = "followed") -> DataFrame:
    """Edges per followed node; repeated edges count, nodes without one are absent.
    Rows are counted before the shuffle, so a node with a third of all edges sends
    one row per task."""
    return edges.groupBy(F.col(followed).alias("node_id")).agg(
        F.count(F.lit(1)).alias("followers")
    )


def dense_index(df: DataFrame, order: Iterable[Column], index: str = "ix") -> DataFrame:
    """``df`` with the 0-based place of each row in ``order``.

    ``order`` should end in a unique column, which makes the result a function of
    the data alone. It also lets the range shuffle split equal leading values over
    many tasks, so ties do not pile up anywhere.

    The sorted rows are written once with their partition and place. Only the size
    of each partition is then summed up in one task; those few offsets turn places
    into global indexes. Carry narrow rows here (ids and sort keys) and join wide
    columns later.
    """
    placed = materialise(
        df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "index"
    )
    part = F.shiftright("_at", _PLACE_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per sort partition: bounded by spark.sql.shuffle.partitions.
    before = F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")
    offsets = sizes.select("_part", before.alias("_before"))
    place = F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (F.col("_before") + place).alias(index))
    )


def rank_nodes(degrees: DataFrame, index: str = "ix") -> DataFrame:
    """Nodes by followers, most first; equal counts by ``node_id``."""
    return dense_index(degrees, [F.desc("followers"), F.asc("node_id")], index)


def rank_documents(
    documents: DataFrame, key: str, views: str, lexical: bool = False, index: str = "ix"
) -> DataFrame:
    """Document keys by views, most first; equal views by key. ``lexical`` compares
    views as text, so that ``999`` precedes ``65051954``."""
    value = F.col(views).cast("string") if lexical else F.col(views)
    return dense_index(documents.select(key, views), [value.desc(), F.asc(key)], index)
