"""Quoted CSV with line breaks inside fields, read by many tasks a file.

A byte range of such a file does not say whether it starts inside of quotes. But either
way each of its lines has a known effect, and the lines of a range add up to a map from
the state at its start to the state at its end. So one scan takes the two-state map of
every range; a prefix scan over these maps, in file order, gives each range its true
state; and a second scan then finds the records of every range on its own. Records that
cross ranges are put together from their parts, of which a range has two at most.

Ranges are Spark's own splits of the files as text lines, so any store that Spark reads
will do. A range is read by one task; a task reads several ranges where those are small,
as starting one costs Python more than reading a small range.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rankdex.scratch import materialise

DELIMITER, QUOTE = ",", '"'

#: Bytes that a task reads at least, and tasks per core below which ranges are not put together.
TASK_BYTES = 16 << 20
TASKS_PER_CORE = 4

_SPLITS = "file long, start long, from_record boolean, from_quoted boolean, cuts boolean, filled boolean, cr boolean"


def line_state(escape: str) -> Callable[[str, bool], bool]:
    """A function of a line and whether it starts inside of quotes, which tells whether it
    ends inside of quotes.

    A quote opens a field only as its first character. Within quotes, the escape
    character before a quote (or itself) escapes it; where the escape is the quote, two
    of them do. What follows a closing quote up to the next delimiter belongs to the
    field, quotes included.
    """
    if escape == QUOTE:
        closing = re.compile(f"(?:[^{QUOTE}]++|{QUOTE}{QUOTE})*+{QUOTE}")
    else:
        mark = re.escape(escape)
        closing = re.compile(f"(?:[^{QUOTE}{mark}]++|{mark}(?:.|$))*+{QUOTE}", re.DOTALL)
    opening = DELIMITER + QUOTE

    def ends_quoted(line: str, quoted: bool) -> bool:
        at = 0
        if not quoted and line.startswith(QUOTE):
            quoted, at = True, 1
        while True:
            if quoted:
                close = closing.match(line, at)
                if not close:
                    return True
                at = line.find(DELIMITER, close.end())
            else:
                at = line.find(opening, at)
            if at < 0:
                return False
            quoted = line.startswith(QUOTE, at + 1)
            at += 2 if quoted else 1

    return ends_quoted


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, start, value``: the lines of all ranges, those of a range in order within
    one partition. A file goes by the hash of its path."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.make_valid_utf8("value").alias("value"),
    )
    splits = lines.rdd.getNumPartitions()
    return lines.coalesce(max(1, tasks(spark, splits)))


def tasks(spark: SparkSession, splits: int) -> int:
    """How many tasks read so many splits."""
    size = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    together = max(1, TASK_BYTES // max(1, size))
    fewest = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    return min(splits, max(fewest, -(-splits // together)))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """The batches cut where a range ends, and whether each cut begins a new range."""
    last = None
    for batch in batches:
        ranges = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        at = 0
        while at < len(ranges):
            to = at + 1
            while to < len(ranges) and ranges[to] == ranges[at]:
                to += 1
            yield ranges[at] != last, batch.slice(at, to - at)
            last, at = ranges[at], to


def _without_mark(line: str) -> str:
    return line.removeprefix("﻿")


def range_maps(lines: DataFrame, escape: str) -> DataFrame:
    """One row a range: whether it ends inside of quotes if it starts at a record
    (``from_record``) or inside of quotes (``from_quoted``); whether a record ends in it
    in the latter case (``cuts``); whether it has any line that is not empty
    (``filled``); and, of the first range of a file, whether its first line ends in a
    carriage return (``cr``)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends_quoted, names = line_state(escape), [c.split()[0] for c in _SPLITS.split(", ")]
        row: list | None = None
        for new, run in _runs(batches):
            if new:
                if row:
                    yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=names)
                file, start, first = (run.column(i)[0].as_py() for i in range(3))
                row = [file, start, False, True, False, False, first.endswith("\r")]
                if start == 0 and "\r" in first[:-1]:
                    raise ValueError("lines end in carriage returns alone")
            values = run.column(2)
            row[5] = row[5] or bool(pc.any(pc.greater(pc.binary_length(values), 1)).as_py())
            row[5] = row[5] or bool(set(values.to_pylist()) - {"", "\r"})
            first_line = new and start == 0
            # A line without quotes leaves either state as it is.
            for i in pc.indices_nonzero(pc.match_substring(values, QUOTE)).to_pylist():
                line = values[i].as_py()
                if first_line and i == 0:
                    line = _without_mark(line)
                apart = row[2] != row[3]
                row[2] = ends_quoted(line, row[2])
                row[3] = ends_quoted(line, row[3]) if apart else row[2]
                row[4] = row[4] or not row[3]
        if row:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=names)

    return lines.mapInArrow(scan, _SPLITS)


def range_states(maps: DataFrame) -> DataFrame:
    """``file, start, flags, owner``: the state of every range, by composing the maps of
    the ranges before it.

    A map is one state whatever came before, or else the same state or the other one.
    So a state is that of the last map of the first kind (a file starts at a record),
    changed as often as maps of the last kind follow. ``owner`` is the range in which the
    record that reaches into this one began. Of the ``flags``, 1 is a start inside of
    quotes, 2 a file whose lines end in a carriage return and line feed, 4 the range that
    holds the start of a file's header. One narrow row a range goes through the window.
    """
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    here = Window.partitionBy("file").orderBy("start")
    fixed = F.col("from_record") == F.col("from_quoted")
    turns = F.when(~fixed & F.col("from_record"), 1).otherwise(0)
    maps = maps.withColumn("turned", F.sum(turns).over(here.rowsBetween(Window.unboundedPreceding, 0)))
    known = F.last(F.when(fixed, F.struct(F.col("from_record").alias("state"), "turned")), ignorenulls=True).over(before)
    so_far = F.coalesce(F.max("turned").over(before), F.lit(0))
    odd = (so_far - F.coalesce(known["turned"], F.lit(0))) % 2 == 1
    quoted = F.coalesce(known["state"], F.lit(False)) != odd
    twice = F.lag("start").over(here) == F.col("start")
    once = F.when(twice, F.raise_error(F.lit("a file is read twice, or two paths have one hash")).cast("boolean"))
    states = maps.withColumn("quoted", F.coalesce(once, quoted))
    ends = F.when(F.col("quoted"), F.col("from_quoted")).otherwise(F.col("from_record"))
    begins = ends & (~F.col("quoted") | F.col("cuts"))
    owner = F.last(F.when(begins, F.col("start")), ignorenulls=True).over(before)
    cr = F.max(F.when(F.col("start") == 0, F.col("cr"))).over(whole)
    header = F.min(F.when(F.col("filled"), F.col("start"))).over(whole) == F.col("start")
    flag = lambda c, bit: F.when(c, bit).otherwise(0)
    flags = flag(F.col("quoted"), 1) + flag(cr, 2) + flag(header, 4)
    return states.select("file", "start", flags.alias("flags"), owner.alias("owner"))


def _placed(lines: DataFrame, states: DataFrame) -> DataFrame:
    """Lines with the ``flags`` and ``owner`` of their range. There is one state a range
    that the driver plans as a task, so they fit where the plan does."""
    known = F.broadcast(states.withColumnsRenamed({"file": "_file", "start": "_start"}))
    joined = lines.join(known, (F.col("file") == F.col("_file")) & (F.col("start") == F.col("_start")), "left")
    changed = F.raise_error(F.lit("files or the size of their splits changed since they were looked at")).cast("int")
    return joined.select("file", "start", "value", F.coalesce("flags", changed).alias("flags"), "owner")


def _found(placed: DataFrame, escape: str, parts: bool) -> DataFrame:
    """``file, owner, start, header, value``: the records that lie within a range, or else
    the ``parts`` of those that do not, each with the range in which its record began."""
    schema = "file long, owner long, start long, header boolean, value string"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends_quoted, names = line_state(escape), ["file", "owner", "start", "header", "value"]
        rows: list[tuple] = []
        held: list[str] = []
        quoted = reaches_in = header = cr = False
        file = start = owner = None

        def close(complete: bool) -> None:
            nonlocal held, reaches_in, header
            text = "\n".join(held)
            held = []
            if (complete and not reaches_in) != parts and (text or parts):
                rows.append((file, owner if reaches_in else start, start, header and not reaches_in, text))
            header = header and (reaches_in or not text)
            reaches_in = False

        def leave_range() -> None:
            if held:
                close(False)

        for new, run in _runs(batches):
            if new:
                leave_range()
                file, start, flags, owner = (run.column(i)[0].as_py() for i in (0, 1, 3, 4))
                quoted, cr, header = bool(flags & 1), bool(flags & 2), bool(flags & 4)
                reaches_in = quoted
            values = run.column(2).to_pylist()
            if cr:
                values = [v.removesuffix("\r") for v in values]
            if new and start == 0:
                values[0] = _without_mark(values[0])
            for line in values:
                held.append(line)
                if QUOTE in line:
                    quoted = ends_quoted(line, quoted)
                if not quoted:
                    close(True)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=names)
                rows = []
        leave_range()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=names)

    return placed.mapInArrow(find, schema)


_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]


def csv_records(spark: SparkSession, path: str | list[str], escape: str = QUOTE) -> DataFrame:
    """``header, value``: the text of every record, without its line end, ``header`` for
    the first one of each file. Records are split at delimiters and quotes as Spark's
    reader does with ``multiLine``; empty lines are left out.

    Lines end as the first one of their file does, in a line feed with or without a
    carriage return before it, which quoted line breaks lose as well. Text is UTF-8, with or without byte order mark. A quote that is
    never closed takes the rest of its file into one record.

    Two scans run at once and store what is known of every range, and the records that
    cross ranges; reading the result is one more scan. It fails if files, or the sizes
    of Spark's splits, have changed in between.
    """
    lines = _lines(spark, path)
    states = materialise(range_states(range_maps(lines, escape)), "ranges")
    placed = _placed(lines, states)
    parts = _found(placed, escape, parts=True).groupBy("file", "owner").agg(
        F.max("header").alias("header"), F.sort_array(F.collect_list(F.struct("start", "value"))).alias("parts")
    )
    text = F.array_join(F.transform("parts", lambda x: x["value"]), "\n")
    crossing = materialise(parts.select("header", text.alias("value")), "crossing")
    return _found(placed, escape, parts=False).select("header", "value").unionAll(crossing)


def _is_header(expected: list[str], fields: list[Column]) -> Column:
    """Whether a header names the columns that are expected. Spark names those without a
    name by their place, and puts it behind a name that repeats."""
    good = F.lit(True)
    for i, (name, field) in enumerate(zip(expected, fields)):
        found = F.coalesce(field, F.lit(""))
        same = F.lower(found) == name.lower()
        good = good & (same | F.lit(name == f"_c{i}") | (F.concat(found, F.lit(str(i))) == name))
    return good


def read_csv(spark: SparkSession, path: str | list[str], escape: str = QUOTE, mode: str = "FAILFAST") -> DataFrame:
    """The text columns of quoted CSV with a header, as Spark's reader gives them with
    ``multiLine``, but with many tasks a file; see ``csv_records``.

    Every file has to carry the same header. ``mode='PERMISSIVE'`` adds
    ``_corrupt_record``, the text of broken records.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", escape)
    columns = reader.csv(path).columns  # reads no more than the header
    permissive = mode.upper() == "PERMISSIVE"
    places = [f"_{i}" for i in range(len(columns))]
    schema = ", ".join(f"{c} string" for c in [*places, *["_corrupt_record"] * permissive])
    records = csv_records(spark, path, escape)
    parse = lambda options: F.from_csv("value", schema, {"escape": escape, **options})
    # A header is text like any other, but a broken one names no columns.
    named = parse({"mode": "PERMISSIVE"})
    wrong = F.raise_error(F.concat(F.lit("a file has another header: "), F.col("value"))).cast("boolean")
    good = _is_header(columns, [named[c] for c in places])
    kept = records.where(F.when(~F.col("header"), True).when(good, False).otherwise(wrong))
    found = kept.select(parse({"mode": mode}).alias("_r"))
    return found.select(
        *(F.col(f"_r.{place}").alias(name) for place, name in zip(places, columns)),
        *([F.col("_r._corrupt_record")] if permissive else []),
    )
