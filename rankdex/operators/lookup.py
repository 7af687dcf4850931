"""Joins of many rows to the one row of their key."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F, types as T

from rankdex.scratch import materialise


class Limits(NamedTuple):
    """Sizes that decide how rows are joined; results do not depend on them."""

    #: A key with more rows than this is spread over several tasks.
    rows_per_key: int = 10_000
    #: Bounds on what is sent to every executor, and on the keys put into a filter.
    broadcast_rows: int = 100_000
    broadcast_bytes: int = 64 << 20
    broadcast_ids: int = 4_000_000
    filter_keys: int = 200


LIMITS = Limits()


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows of ``df``, and about as many bytes as they take. One pass over it."""
    width = F.lit(0).cast("long")
    for field in df.schema.fields:
        width = width + 16
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.octet_length(F.to_json(F.struct(field.name)))
    found = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")).first()
    return found["rows"], found["bytes"] or 0


def only_asked(
    one: DataFrame, many: DataFrame, key: str, rows: int, size: int, limits: Limits = LIMITS
) -> DataFrame:
    """The rows of ``one`` whose key is found in ``many``, a table of ``rows`` rows and
    ``size`` bytes, if the distinct keys are few enough to send along; otherwise
    ``one`` itself.

    Up to ``limits.filter_keys`` keys become a filter, which reaches the files: buckets, row
    groups and dictionaries without such a key are not read. More are broadcast.
    """
    asked = many.select(key).where(F.col(key).isNotNull()).distinct()
    if size <= limits.broadcast_bytes:
        keys = [row[0] for row in asked.limit(limits.filter_keys + 1).collect()]
        if len(keys) <= limits.filter_keys:
            return one.where(F.col(key).isin(keys))
    if rows > limits.broadcast_ids or size > limits.broadcast_bytes:
        rows, size = measure(asked)
    if rows <= limits.broadcast_ids and size <= limits.broadcast_bytes:
        return one.join(F.broadcast(asked), key, "left_semi")
    return one


def spread_join(
    many: DataFrame,
    one: DataFrame,
    key: str,
    spread_by: str,
    many_rows: int,
    how: str = "inner",
    limits: Limits = LIMITS,
) -> DataFrame:
    """Join ``many`` to ``one``, whose ``key`` is unique, when a key may hold a large
    part of ``many``. ``how`` is ``inner`` or ``left``; a NULL key finds nothing.

    Keys with more than ``limits.rows_per_key`` rows are found first; counting combines
    before its shuffle. Without such a key this is a plain join. Otherwise there are
    two: the other keys join ``one`` as it is stored, so that buckets hold and wide
    rows stay. The few rows of ``one`` for the hot keys are copied once per
    ``rows_per_key`` rows of ``many``, whose rows choose a copy by the hash of
    ``spread_by``. The list of hot keys is broadcast: the threshold rises until it has
    less than a million keys and ``limits.broadcast_bytes``. ``many`` is read more than
    once: pass a stored one.
    """
    threshold = max(limits.rows_per_key, many_rows // 1_000_000)
    counts = many.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot = materialise(counts.where(F.col("_n") > threshold), "hot")
    if hot.isEmpty():
        return many.join(one, key, how)
    while (size := measure(hot)[1]) > max(limits.broadcast_bytes, 1 << 20):
        threshold *= max(2, size // max(limits.broadcast_bytes, 1 << 20))
        hot = hot.where(F.col("_n") > threshold)
    copies = F.ceil(F.col("_n") / threshold)
    keys = F.broadcast(hot.select(key))
    cold = many.join(keys, key, "left_anti").join(one, key, how)
    left = many.join(F.broadcast(hot), key).withColumn("_copy", F.pmod(F.xxhash64(spread_by), copies))
    right = one.join(F.broadcast(hot), key).withColumn(
        "_copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1))
    )
    spread = left.drop("_n").join(right.drop("_n"), [key, "_copy"], how).drop("_copy")
    return cold.unionByName(spread)


def fetch(
    many: DataFrame, one: DataFrame, key: str, spread_by: str, limits: Limits = LIMITS
) -> DataFrame:
    """Each row of ``many`` with the row of ``one`` that it names; rows that name
    none are left out. ``one`` may be wide and as large as a collection.

    ``many`` is measured first, so pass a stored or cheap one. Rows of ``one`` that
    nobody asks for are dropped where it is scanned, as ``only_asked`` says. A small
    ``many`` is then broadcast and ``one`` not shuffled at all; otherwise both are,
    with hot keys spread.
    """
    rows, size = measure(many)
    one = only_asked(one, many, key, rows, size, limits)
    if rows <= limits.broadcast_rows and size <= limits.broadcast_bytes:
        joined = one.join(F.broadcast(many), key)
    else:
        joined = spread_join(many, one, key, spread_by, rows, limits=limits)
    own, found = ([c for c in df.columns if c != key] for df in (many, one))
    return joined.select(key, *own, *found)


def missing(many: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """How often each key of ``many``, a stored or cheap table, is asked for that
    ``one`` lacks."""
    many = many.select(key)
    present = only_asked(one.select(key), many, key, *measure(many))
    asked = many.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return asked.join(present, key, "left_anti")
