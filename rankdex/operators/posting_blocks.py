"""Postings in blocks: many ascending document ids of a keyword in one row, as gaps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from rankdex.scratch import materialise

#: Ids of a full block.
BLOCK_IDS = 128
SCHEMA = "keyword string, first_id long, last_id long, n int, gaps array<long>"


def _starts(rows: pa.Table, size: int) -> np.ndarray:
    """Where blocks start in sorted rows, the first of which starts one."""
    keywords = rows["keyword"].chunk(0)
    place = np.arange(len(keywords))
    new = np.ones(len(keywords), bool)
    new[1:] = pc.not_equal(keywords.slice(1), keywords.slice(0, len(keywords) - 1))
    of_keyword = place - np.maximum.accumulate(np.where(new, place, 0))
    return np.flatnonzero(of_keyword % size == 0)


def _pack(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
    ids = rows["doc_id"].to_numpy()
    gaps = np.diff(ids, prepend=ids[:1])
    gaps[starts] = 0
    bounds = np.append(starts, len(ids)).astype(np.int32)
    columns = [
        rows["keyword"].chunk(0).take(pa.array(starts)),
        pa.array(ids[starts]),
        pa.array(ids[bounds[1:] - 1]),
        pa.array(np.diff(bounds)),
        pa.ListArray.from_arrays(pa.array(bounds), pa.array(gaps)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["keyword", "first_id", "last_id", "n", "gaps"])


def _cut(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the rows of the last block, which the next batch may go on with
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = (pa.concat_tables([held, rows]) if held else rows).combine_chunks()
            if not rows.num_rows:
                continue
            starts = _starts(rows, size)
            if len(starts) > 1:
                yield _pack(rows.slice(0, starts[-1]), starts[:-1])
            held = rows.slice(starts[-1]).combine_chunks()
        if held:
            yield _pack(held, np.zeros(1, np.int64))

    return run


def to_blocks(postings: DataFrame, size: int = BLOCK_IDS) -> DataFrame:
    """``keyword, first_id, last_id, n, gaps``: each keyword's ids in ascending order, ``size`` to
    a row, as differences from the id before (0 for a block's first).

    Postings are sorted by ranges of keyword and id, so a keyword of a third of all
    documents is cut into blocks by many tasks; where ranges meet, a block may have
    fewer ids. A task holds one Arrow batch and one block. Blocks of a keyword do not
    overlap. Pairs that repeat stay; rows without keyword or id are left out. Ids are
    whole numbers. Sorting reads ``postings`` twice: pass stored ones.
    """
    kind = postings.schema["doc_id"].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"ids in blocks are whole numbers, not {kind.simpleString()}")
    rows = postings.select("keyword", F.col("doc_id").cast("long")).dropna()
    order = ("keyword", "doc_id")
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_cut(size), SCHEMA)


@F.arrow_udf(T.ArrayType(T.LongType()))
def block_ids(first_id: pa.Array, gaps: pa.Array) -> pa.Array:
    """The ids of blocks."""
    sums = np.cumsum(gaps.flatten().to_numpy())
    counts = pc.list_value_length(gaps).to_numpy()
    ends = np.cumsum(counts)
    # A block's first gap is 0: the sum there is that of all blocks before.
    ids = sums + np.repeat(first_id.to_numpy() - sums[ends - counts], counts)
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids))


def from_blocks(blocks: DataFrame) -> DataFrame:
    """The postings of blocks, ``keyword, doc_id``."""
    return blocks.select("keyword", F.explode(block_ids("first_id", "gaps")).alias("doc_id"))


def block_heads(blocks: DataFrame, depth: int) -> DataFrame:
    """The ``depth`` lowest ids of each keyword, as one ascending array.

    A block that holds one of them starts below it, and so does every block before in
    order of first ids; each of those has one lower id at least. So the first ``depth``
    blocks are enough, even where blocks overlap, and each task sends no more than so
    many on. Where blocks do not overlap all but the first few are dropped as well,
    before ids are put together.
    """
    by_first = Window.partitionBy("keyword").orderBy("first_id", "n")
    near = blocks.withColumn("_at", F.row_number().over(by_first)).where(F.col("_at") <= depth)
    before = by_first.rowsBetween(Window.unboundedPreceding, -1)
    near = near.withColumns({"_before": F.sum("n").over(before), "_reach": F.max("last_id").over(before)})
    # Enough ids lie in the blocks before, all of them lower than this block's.
    enough = (F.col("_before") >= depth) & (F.col("_reach") < F.col("first_id"))
    near = near.where(F.col("_reach").isNull() | ~enough)
    near = near.select("keyword", block_ids("first_id", "gaps").alias("_ids"))
    ids = F.sort_array(F.flatten(F.collect_list("_ids")))
    return near.groupBy("keyword").agg(F.slice(ids, 1, depth).alias("doc_ids"))


def write_blocks(postings: DataFrame, path: str, size: int = BLOCK_IDS) -> None:
    """Store ``postings`` in blocks, in files by ranges of keywords. Gaps are small
    numbers, which the files pack by the bit."""
    blocks = to_blocks(materialise(postings, "postings"), size)
    blocks.write.option("parquet.writer.version", "v2").option("compression", "zstd").parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)
