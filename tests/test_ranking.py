import pytest
from pyspark.sql import functions as F

from rankdex.operators.pairing import cogroup, pair_by_index, side_sizes
from rankdex.operators.ranking import dense_index, follower_count, rank_documents, rank_nodes
from rankdex.plans.popularity import pair_by_popularity


def documents(spark):
    views = [(1, 999), (2, 65051954), (3, 7000), (4, 10)]
    return spark.createDataFrame(views, "talk_id long, views long")


@pytest.mark.parametrize(
    "lexical, expected", [(False, [2, 3, 1, 4]), (True, [1, 3, 2, 4])]
)
def test_rank_documents(spark, lexical, expected):
    ranked = rank_documents(documents(spark), "talk_id", "views", lexical)
    assert [r["talk_id"] for r in ranked.orderBy("ix").collect()] == expected


@pytest.mark.parametrize("partitions", [1, 7])
@pytest.mark.parametrize(
    "value", ["id % 3", "1", "-id"], ids=["ties", "all ties", "no ties"]
)
def test_dense_index_matches_sort(spark, partitions, value):
    rows = spark.range(5000).select("id", F.expr(value).alias("v")).repartition(partitions, "id")
    indexed = dense_index(rows, [F.desc("v"), F.asc("id")]).collect()
    expected = sorted(((r["id"], r["v"]) for r in indexed), key=lambda r: (-r[1], r[0]))
    assert sorted(r["ix"] for r in indexed) == list(range(5000))
    by_index = sorted(indexed, key=lambda r: r["ix"])
    assert [(r["id"], r["v"]) for r in by_index] == expected


def test_dense_index_splits_ties(spark):
    """One value on all rows still sorts in many tasks, and only their sizes meet."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(20000).repartition(3, "id").select("id", (F.col("id") * 0).alias("v"))
        indexed = dense_index(rows, [F.desc("v"), F.asc("id")])
        files = indexed.inputFiles()
        assert len(files) == 4
        largest = max(spark.read.parquet(f).count() for f in files)
        assert largest < 20000 / 2
        assert indexed.where("ix != id").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_dense_index_of_nothing(spark):
    assert dense_index(spark.range(0), [F.asc("id")]).count() == 0


@pytest.mark.parametrize("left, right", [(3, 5), (5, 3), (4, 4), (0, 2)])
def test_pairing_keeps_the_shorter_side(spark, left, right):
    a = dense_index(spark.range(left).withColumnRenamed("id", "a"), [F.asc("a")])
    b = dense_index(spark.range(right).withColumnRenamed("id", "b"), [F.desc("b")])
    pairs = sorted((r["a"], r["b"]) for r in pair_by_index(a, b).collect())
    assert pairs == [(i, right - 1 - i) for i in range(min(left, right))]
    sizes = {r["side"]: r["n"] for r in side_sizes(a, b).collect()}
    assert (sizes.get("left", 0), sizes["right"]) == (left, right)


def test_pair_by_popularity(spark):
    edges = spark.createDataFrame(
        [(8, 1), (8, 1), (9, 1), (9, 2), (9, 9), (7, 1)], "followed long, follower long"
    )
    pairs = pair_by_popularity(documents(spark), edges).orderBy("ix")
    assert [tuple(r) for r in pairs.select("talk_id", "social_id").collect()] == [
        (2, 9), (3, 8), (1, 7),
    ]


def test_rank_plan_has_no_window_over_the_rows(spark):
    edges = spark.range(1000).select((F.col("id") % 10).alias("followed"), "id")
    plan = rank_nodes(follower_count(edges))._jdf.queryExecution().executedPlan().toString()
    # The only single-task window adds up partition sizes, below a broadcast.
    assert plan.count("SinglePartition") == 1
    assert plan.index("BroadcastExchange") < plan.index("SinglePartition")


def test_cogroup(spark):
    left = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "k long, a long")
    right = spark.createDataFrame([(1, "x"), (3, "y"), (1, "x")], "k long, b string")
    rows = cogroup(left, right, "k", "a", "b").collect()
    assert sorted((r["k"], r["left_values"], r["right_values"]) for r in rows) == [
        (1, [10, 11], ["x", "x"]),
        (2, [12], []),
        (3, [], ["y"]),
    ]


def test_cogroup_keeps_nulls_and_small_keys_whole(spark):
    rows = [(k, v) for k in (1, 2, 3, 4) for v in (k, None)] + [(None, 5)] * 3
    left = spark.createDataFrame(rows, "k long, a long")
    right = spark.createDataFrame([(4, None), (None, 1)], "k long, b long")
    found = cogroup(left, right, "k", "a", "b", chunk_rows=3).collect()
    got = {(r.k, r.chunk): (r.left_values, r.right_values) for r in found}
    assert got == {
        (1, 0): ([None, 1], []), (2, 0): ([None, 2], []), (3, 0): ([None, 3], []),
        (4, 0): ([None, 4], [None]), (None, 0): ([5, 5, 5], []), (None, 1): ([], [1]),
    }


def test_cogroup_splits_equal_rows(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        left = spark.range(8_000).select(F.lit(1).alias("k"), F.lit(7).alias("a"))
        right = spark.range(3).select(F.col("id").alias("k"), F.lit("x").alias("b"))
        found = cogroup(left, right, "k", "a", "b", chunk_rows=1_000).where("k = 1").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((r.chunk, len(r.left_values)) for r in found) == [*((i, 1_000) for i in range(8)), (8, 0)]
    assert [r.right_values for r in sorted(found, key=lambda r: r.chunk)][-1] == ["x"]


def test_cogroup_bounds_hot_keys(spark):
    left = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("a"))
    right = spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("b"))
    rows = cogroup(left, right, "k", "a", "b", chunk_rows=64).orderBy("k", "chunk").collect()
    assert max(len(r["left_values"]) + len(r["right_values"]) for r in rows) <= 64
    hot = [a for r in rows if r["k"] == 1 for a in r["left_values"]]
    assert hot == list(range(1000))
