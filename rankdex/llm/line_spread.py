"""Cross-site boilerplate: lines found on many distinct sites, in DataFrame functions.

Every line hash gets a HyperLogLog sketch of its sites, merged by aggregation. Lines
whose estimate is clearly above the threshold are boilerplate, those clearly below are
not, and those near it get an exact distinct count. A boilerplate line stays where it
occurs first, so that nothing vanishes from the collection, and goes elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rankdex.scratch import materialise

MIN_SITES = 10
#: log2 of a sketch's registers; the estimate's standard error is 3 %.
LOG_REGISTERS = 10
#: Estimates within this share of the threshold are replaced by exact counts.
NEAR = 0.2
#: Line hashes that may be broadcast, of 16 bytes each, and places of lines to remove,
#: of 4 bytes each and 24 for their row.
BROADCAST_LINES = 1_000_000
BROADCAST_PLACES = 5_000_000

_LINE = ["_h1", "_h2"]


def split_lines(text: Column) -> Column:
    return F.split(text, "\n")


def _few(lines: DataFrame) -> DataFrame:
    """``lines``, a stored list of line hashes, to be broadcast if it is short."""
    return F.broadcast(lines) if lines.count() <= BROADCAST_LINES else lines


def line_table(documents: DataFrame, key: str, text: str, site: str) -> DataFrame:
    """One row per line that is not blank: row, place, site and a hash of 128 bits."""
    row = F.xxhash64(key, text)
    lines = documents.select(
        F.col(key).alias("_key"), row.alias("_row"), F.col(site).cast("string").alias("_site"),
        F.posexplode(split_lines(F.col(text))).alias("_at", "_line"),
    )
    line = F.trim("_line")
    return lines.where(line != "").select(
        "_key", "_row", "_site", "_at",
        F.xxhash64(line).alias("_h1"), F.xxhash64(F.lit(1), line, F.length(line)).alias("_h2"),
    )


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The hashes of stored ``lines`` found on ``min_sites`` distinct sites or more.

    Sketches are made before the shuffle, so a line of a third of all rows sends one
    sketch per task. Rows without site count for no site.
    """
    sketches = lines.groupBy(*_LINE).agg(
        F.count(F.lit(1)).alias("_n"), F.hll_sketch_agg("_site", LOG_REGISTERS).alias("_sketch")
    )
    # A line seen fewer times than that is on fewer sites.
    estimated = sketches.where(F.col("_n") >= min_sites).select(
        *_LINE, F.hll_sketch_estimate("_sketch").alias("_sites")
    )
    estimated = materialise(estimated, "estimates")
    low, high = min_sites * (1 - NEAR), min_sites * (1 + NEAR)
    sure = estimated.where(F.col("_sites") > high).select(*_LINE)
    near = materialise(estimated.where(F.col("_sites").between(low, high)).select(*_LINE), "near")
    exact = (
        lines.select(*_LINE, "_site")
        .join(_few(near), _LINE, "left_semi")
        .groupBy(*_LINE)
        .agg(F.count_distinct("_site").alias("_sites"))
        .where(F.col("_sites") >= min_sites)
    )
    return sure.unionAll(exact.select(*_LINE))


def dedup_lines(
    documents: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source",
    min_sites: int = MIN_SITES, counts: bool = False,
) -> DataFrame:
    """``documents`` without lines that occur on ``min_sites`` sites or more, but for
    each one's first occurrence: that of the smallest key, and in it the first.

    All columns stay and no row goes; a text may end up empty. With ``counts``,
    ``n_lines`` and ``n_removed`` are added, in place of columns of that name. Lines
    are compared without blanks at their ends; blank lines stay. A NULL text stays
    NULL and has no lines, an empty one has one. Rows without key come last in the
    order of first occurrence; rows that repeat key and text are treated alike.

    Lines move as hashes and places. Texts are joined with the places to remove, by
    broadcast if those are few, and else move once.
    """
    lines = materialise(line_table(documents, key, text, site), "lines")
    common = materialise(boilerplate(lines, min_sites), "boilerplate")
    common = _few(common)
    place = F.struct(F.col("_key").isNull().alias("none"), "_key", "_row", "_at")
    found = lines.join(common, _LINE).select(*_LINE, place.alias("_place"))
    first = materialise(found.groupBy(*_LINE).agg(F.min("_place").alias("_first")), "first")
    repeats = found.join(_few(first), _LINE).where(F.col("_place") != F.col("_first"))
    gone = repeats.groupBy(F.col("_place._row").alias("_row"), F.col("_place._key").alias("_key")).agg(
        F.collect_set("_place._at").alias("_gone")
    )
    gone = materialise(gone, "gone")
    n_rows, n_places = gone.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("_gone")), F.lit(0))).first()
    if n_rows <= BROADCAST_LINES and n_places <= BROADCAST_PLACES:
        gone = F.broadcast(gone)
    rows = documents.select(F.struct("*").alias("_doc"), F.xxhash64(key, text).alias("_row"))
    joined = rows.join(
        gone.withColumnRenamed("_row", "_row_"),
        (F.col("_row") == F.col("_row_")) & F.col(f"_doc.{key}").eqNullSafe(F.col("_key")),
        "left",
    ).select("_doc", "_gone", split_lines(F.col(f"_doc.{text}")).alias("_lines"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    cleaned = F.when(
        F.col("_gone").isNotNull(), F.array_join(F.transform(kept, lambda at: F.get("_lines", at)), "\n")
    ).otherwise(F.col(f"_doc.{text}"))
    columns = {c: F.col(f"_doc.`{c}`") for c in documents.columns} | {text: cleaned}
    if counts:
        columns["n_lines"] = F.when(F.col(f"_doc.{text}").isNull(), F.lit(0)).otherwise(F.size("_lines")).cast("long")
        columns["n_removed"] = F.when(F.col("_gone").isNull(), F.lit(0)).otherwise(F.size("_gone")).cast("long")
    return joined.select(*(c.alias(name) for name, c in columns.items()))
