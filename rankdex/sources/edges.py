"""Edge lists as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rankdex.functions.numbers import lenient_long

_SURE = "[+-]?0*[0-9]{1,18}"


def read_edges(spark: SparkSession, path: str, mode: str = "strict") -> DataFrame:
    """``followed follower …`` lines as two longs; further fields are ignored.

    A line without two integers, separated by one space, fails the job in
    ``strict`` mode and is left out in ``drop`` mode. Repeated edges and
    self-loops are kept.
    """
    if mode not in ("strict", "drop"):
        raise ValueError(f"mode is strict or drop, not {mode}")
    value = F.col("value")
    fields = F.split(value, " ", 3)
    # Up to 18 digits always fit a long: one pattern settles nearly every line. The
    # rest (19 digits, or no edge at all) is looked at field by field.
    good = value.rlike(rf"^{_SURE} {_SURE}( |\z)") | (
        lenient_long(F.get(fields, F.lit(0))).isNotNull()
        & lenient_long(F.get(fields, F.lit(1))).isNotNull()
    )
    if mode == "strict":
        # A filter, so that a bad line is found even when no column is used.
        message = F.concat(F.lit("not an edge: "), value)
        good = F.when(good, True).otherwise(F.raise_error(message).cast("boolean"))
    first_two = F.substring_index(value, " ", 2)
    return (
        spark.read.text(path)
        .where(good)
        .select(
            F.substring_index(value, " ", 1).try_cast("long").alias("followed"),
            F.substring_index(first_two, " ", -1).try_cast("long").alias("follower"),
        )
    )
