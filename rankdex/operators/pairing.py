"""Pairing by position, and cogroup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rankdex.operators.ranking import dense_index
from rankdex.operators.selection import SLACK_ROWS, Order, first_rows, sort_columns
from rankdex.scratch import materialise


def pair_by_index(left: DataFrame, right: DataFrame, index: str = "ix") -> DataFrame:
    """The i-th row of ``left`` with the i-th row of ``right``; the longer side's
    rest is left out. Indexes are unique, so the join cannot be skewed."""
    return left.join(right, index)


def pair_in_order(
    left: DataFrame, left_order: Order, right: DataFrame, right_order: Order, index: str = "ix", slack: int = SLACK_ROWS
) -> DataFrame:
    """The i-th row of ``left`` in its order with the i-th row of ``right`` in its own,
    and ``index``. Orders are of ``(column, ascending)`` and should end in unique columns.

    There are as many pairs as the shorter side has rows, so only so many rows of the
    longer one are sorted and moved, and about a quarter more (``first_rows``). Both
    sides are stored first: give narrow ones.
    """
    left, right = materialise(left, "left"), materialise(right, "right")
    sizes = left.count(), right.count()
    sides = []
    for rows, order, size in ((left, left_order, sizes[0]), (right, right_order, sizes[1])):
        first = first_rows(rows, order, min(sizes), size, slack)
        sides.append(dense_index(first, sort_columns(order), index))
    return pair_by_index(*sides, index)


def side_sizes(left: DataFrame, right: DataFrame) -> DataFrame:
    """Row counts of both sides, as ``side`` and ``n``."""
    sides = left.select(F.lit("left").alias("side")).unionAll(
        right.select(F.lit("right").alias("side"))
    )
    return sides.groupBy("side").agg(F.count(F.lit(1)).alias("n"))


def cogroup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_value: str,
    right_value: str,
    chunk_rows: int = 100_000,
) -> DataFrame:
    """All left values and all right values of each key, as ascending arrays, NULLs
    first: one row per key, with ``chunk`` 0.

    A key's values may be a third of all rows, so a key with more than ``chunk_rows``
    of them comes in chunks of so many, in order of side and value. Read its rows in
    order of ``chunk`` for the whole group. Keys found on one side only have an empty
    array on the other; NULL is a key like others.

    Keys are counted first, combined before the shuffle. Small ones are then grouped;
    only the values of large ones are sorted, numbered apart where they are equal, so
    that no value piles up in one task either.
    """
    rows = left.select(
        F.col(key).alias("_key"),
        F.lit(0).alias("_side"),
        F.col(left_value).alias("_left"),
        F.lit(None).cast(right.schema[right_value].dataType).alias("_right"),
    ).unionAll(
        right.select(
            F.col(key).alias("_key"),
            F.lit(1).alias("_side"),
            F.lit(None).cast(left.schema[left_value].dataType).alias("_left"),
            F.col(right_value).alias("_right"),
        )
    )
    counts = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    large = materialise(counts.where(F.col("_n") > chunk_rows).select(F.col("_key").alias("_large")), "large")
    value = ["_key", "_side", "_left", "_right"]

    def lists(grouped: DataFrame) -> DataFrame:
        def values(side: int, column: str) -> Column:
            own = F.collect_list(F.when(F.col("_side") == side, F.struct(column)))
            return F.transform(F.sort_array(own), lambda x: x[column])

        return grouped.groupBy("_key", "chunk").agg(
            values(0, "_left").alias("left_values"), values(1, "_right").alias("right_values")
        ).select(F.col("_key").alias(key), "chunk", "left_values", "right_values")

    if large.isEmpty():
        return lists(rows.withColumn("chunk", F.lit(0).cast("long")))
    is_large = F.col("_key").eqNullSafe(F.col("_large"))
    small = rows.join(large, is_large, "left_anti").withColumn("chunk", F.lit(0).cast("long"))
    equal = rows.join(large, is_large, "left_semi").groupBy(*value).agg(F.count(F.lit(1)).alias("_n"))
    apart = equal.withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("long"), "_n"))).drop("_n")
    numbered = dense_index(apart, [F.col(c).asc() for c in (*value, "_nth")])
    first = numbered.groupBy(F.col("_key").alias("_large")).agg(F.min("ix").alias("_first"))
    first = materialise(first, "first")
    chunk = F.floor((F.col("ix") - F.col("_first")) / chunk_rows).alias("chunk")
    cut = numbered.join(first, is_large).select(*value, chunk)
    return lists(small).unionAll(lists(cut))
