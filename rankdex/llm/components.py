"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rankdex.scratch import materialise

#: Rows of links that a task of a round takes, and tasks that a round has at least. Rounds over
#: few links are many short stages, whose time is that of starting a task a shuffle partition.
TASK_LINKS = 100_000
FEWEST_TASKS = 8


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(neighbours: DataFrame, keep_larger: bool, tasks: int) -> DataFrame:
    """Link the neighbours of every node to the smallest node among them and itself:
    its larger neighbours, or else its smaller ones and itself."""
    least = neighbours.groupBy("a").agg(F.min("b").alias("_least"))
    # Stored, so that the join can split the rows of a node with very many links.
    least = materialise(least.select("a", F.least("a", "_least").alias("_least")).coalesce(tasks), "least")
    joined = neighbours.join(least, "a")
    if keep_larger:
        found = joined.where("b > a").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    else:
        found = joined.select(F.col("b").alias("a"), F.col("_least").alias("b")).unionAll(
            least.select("a", F.col("_least").alias("b"))
        )
    return found.where("a != b").distinct().coalesce(tasks)


def components(links: DataFrame) -> DataFrame:
    """``(id, component)``: for every node of ``links(a, b)`` the smallest node that
    can be reached from it.

    Alternates large and small stars until nothing changes: each round moves links,
    never whole components, and a node with very many links is split by the join.
    Rounds grow with the logarithm of the longest chain. Every round is stored, by as
    many tasks as its links need.
    """
    links = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = materialise(links.distinct(), "links")
    state = None
    while True:
        found = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == (state := tuple(found)) or not state[0]:
            break
        tasks = max(FEWEST_TASKS, 2 * state[0] // TASK_LINKS)
        large = materialise(_star(_both_ways(links), keep_larger=True, tasks=tasks), "large")
        links = materialise(_star(large, keep_larger=False, tasks=tasks), "small")
    ends = links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(ends)
