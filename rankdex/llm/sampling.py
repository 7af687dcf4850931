"""Bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

#: Bound on the different labels of a sample.
MAX_LABELS = 1_000
#: Rows looked at for each row sampled, on average.
SPARE = 3


def sample_per_label(labelled: DataFrame, key: str, label: str, per_label: int) -> DataFrame:
    """``key, label`` of up to ``per_label`` rows of each label, those with the lowest
    hash of their key: the same ones at every run. Rows without key or label are left
    out; of rows that repeat a key and label one counts.

    Labels are counted first, at most ``MAX_LABELS`` of them. The counts give a bound
    below which about ``SPARE * per_label`` hashes of each label lie, so only so many
    rows are shuffled and sorted, whatever the number of rows or tasks. Keys that
    repeat very often may leave a label a smaller sample.
    """
    rows = labelled.select(key, label).where(F.col(key).isNotNull() & F.col(label).isNotNull())
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).limit(MAX_LABELS + 1).collect()
    if len(counts) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    if not counts:
        return rows
    bounds = F.create_map(
        *(
            F.lit(x)
            for name, n in counts
            for x in (name, int(min(1.0, SPARE * per_label / n) * (2**64 - 2**12)) - 2**63)
        )
    )
    hashed = F.xxhash64(key)
    few = rows.where(hashed <= F.element_at(bounds, F.col(label))).distinct()
    order = Window.partitionBy(label).orderBy(hashed, key)
    return few.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_label).drop("_n")
