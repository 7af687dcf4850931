"""Keyed put and keyed add, as plans over whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def keyed_put(
    base: DataFrame,
    updates: DataFrame,
    key: str,
    order_by: Sequence[Column] = (),
    keep: str = "last",
    unique: bool = False,
) -> DataFrame:
    """``base`` with every row of ``updates`` put by ``key``.

    An existing row is replaced whole: columns that ``updates`` lacks become NULL.
    When ``updates`` repeats a key, its ``last`` or ``first`` row in ``order_by``
    wins, and of rows that are equal in that the one that is so in all columns (but
    maps): the result depends on the data alone. Repeats are reduced before the
    shuffle. With ``unique``, for updates known to hold a key once, their rows go
    straight into the join. NULL keys match nothing; ``KeyedTable`` refuses them.
    """
    values = [c for c in updates.columns if c != key]
    row = F.struct(F.lit(True).alias("_put"), *values)
    if unique:
        puts = updates.select(key, row.alias("_new"))
    else:
        ties = [c for c in values if not isinstance(updates.schema[c].dataType, T.MapType)]
        place = F.struct(*order_by, *ties) if order_by or ties else F.lit(0)
        place = {"last": place.desc(), "first": place.asc()}[keep]
        number = F.row_number().over(Window.partitionBy(key).orderBy(place))
        kept = updates.withColumn("_number", number).where("_number = 1").drop("_number")
        puts = kept.select(key, row.alias("_new"))
    joined = base.join(puts, key, "full_outer")
    is_put = F.col("_new").isNotNull()

    def merged(column: str) -> Column:
        if column == key:
            return F.col(key)
        new = F.col("_new")[column] if column in values else F.lit(None)
        old = F.col(column) if column in base.columns else F.lit(None)
        return F.when(is_put, new).otherwise(old).alias(column)

    added = [c for c in values if c not in base.columns]
    return joined.select(*(merged(c) for c in [*base.columns, *added]))


def keyed_add(base: DataFrame, deltas: DataFrame, key: str, column: str) -> DataFrame:
    """``base`` with the sum of each key's deltas added to ``column``.

    A missing value counts as 0 and a key that ``base`` lacks becomes a new row. A NULL
    delta adds nothing, not even a row. The column keeps its type.
    The result is a plan over ``base``: a task that runs twice adds nothing twice.
    """
    deltas = deltas.where(F.col(column).isNotNull())
    sums = deltas.groupBy(key).agg(F.sum(column).alias("_delta"))
    joined = base.join(sums, key, "full_outer")
    old = F.col(column) if column in base.columns else F.lit(None).cast("long")
    total = F.when(
        F.col("_delta").isNotNull(), F.coalesce(old, F.lit(0)) + F.col("_delta")
    ).otherwise(old)
    if column in base.columns:
        total = total.cast(base.schema[column].dataType)
    columns = [c for c in base.columns if c != column]
    at = base.columns.index(column) if column in base.columns else len(columns)
    columns.insert(at, column)
    return joined.select(*(total.alias(c) if c == column else F.col(c) for c in columns))
