import uuid

import pytest
from pyspark.sql import functions as F

from rankdex.operators.lookup import fetch
from rankdex.operators.upsert import keyed_add, keyed_put
from rankdex.plans.popularity import load_popularity
from rankdex.sources.keyed_table import KeyedTable

SCHEMA = "k long, v string, s long"


@pytest.fixture
def base(spark):
    return spark.createDataFrame([(1, "a", None), (2, "b", 5)], SCHEMA)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_put_replaces_whole_rows(spark, base):
    puts = spark.createDataFrame([(2, "B", None), (3, "c", None)], SCHEMA)
    once = keyed_put(base, puts, "k")
    assert rows(once.fillna(-1)) == [(1, "a", -1), (2, "B", -1), (3, "c", -1)]
    assert rows(keyed_put(once, puts, "k").fillna(-1)) == rows(once.fillna(-1))


def test_put_of_fewer_and_more_columns(spark, base):
    puts = spark.createDataFrame([(2, "new")], "k long, extra string")
    out = keyed_put(base, puts, "k")
    assert out.columns == ["k", "v", "s", "extra"]
    assert [tuple(r) for r in out.orderBy("k").collect()] == [
        (1, "a", None, None),
        (2, None, None, "new"),
    ]


@pytest.mark.parametrize("keep, expected", [("last", "z"), ("first", "x")])
def test_put_of_repeated_keys(spark, base, keep, expected):
    puts = spark.createDataFrame([(1, "y", 2), (1, "x", 1), (1, "z", 3)], SCHEMA)
    out = keyed_put(base, puts, "k", order_by=["s"], keep=keep)
    assert out.where("k = 1").first()["v"] == expected


def test_put_of_unique_keys_shuffles_rows_once(spark, base):
    puts = spark.createDataFrame([(2, "B", None), (3, "c", None)], SCHEMA)
    put = keyed_put(base, puts, "k", unique=True)
    assert rows(put.fillna(-1)) == rows(keyed_put(base, puts, "k").fillna(-1))
    assert "Aggregate" not in put._jdf.queryExecution().executedPlan().toString()


def test_add(spark, base):
    deltas = spark.createDataFrame([(1, 7), (1, 7), (2, 1), (9, 4)], "k long, s long")
    expected = [(1, "a", 14), (2, "b", 6), (9, "", 4)]
    assert rows(keyed_add(base, deltas, "k", "s").fillna("")) == expected
    added = keyed_add(base.drop("s"), deltas, "k", "s")
    assert rows(added.fillna("").fillna(-1)) == [(1, "a", 14), (2, "b", 1), (9, "", 4)]


def test_rows_without_delta_keep_null(spark, base):
    deltas = spark.createDataFrame([(2, 1)], "k long, s long")
    assert keyed_add(base, deltas, "k", "s").where("k = 1").first()["s"] is None


@pytest.fixture
def name(spark):
    database = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {database}")
    return f"{database}.items"


def test_table_life(spark, base, name):
    table = KeyedTable(spark, name, "k", SCHEMA, buckets=4)
    assert table.read().count() == 0
    table.put(base)
    seen = table.read()
    table.add(spark.createDataFrame([(1, 7), (9, 4)], "k long, s long"), "s")
    assert rows(table.read().fillna("")) == [(1, "a", 7), (2, "b", 5), (9, "", 4)]
    assert rows(seen.fillna(-1)) == [(1, "a", -1), (2, "b", 5)]  # an older version, still whole
    again = KeyedTable(spark, name, "k", SCHEMA, buckets=4)
    assert again.read().count() == 3
    assert spark.table(name).count() == 3
    # The view, its version and the one before.
    assert len(spark.catalog.listTables(name.split(".")[0])) == 3


def test_empty_put_writes_no_version(spark, base, name):
    table = KeyedTable(spark, name, "k", SCHEMA, buckets=4)
    table.put(base)
    before = spark.catalog.listTables(name.split(".")[0])
    table.put(base.limit(0))
    table.add(base.limit(0), "s")
    assert spark.catalog.listTables(name.split(".")[0]) == before


def test_null_keys_are_refused(spark, base, name):
    table = KeyedTable(spark, name, "k", SCHEMA, buckets=4)
    bad = spark.createDataFrame([(None, "a", 1)], SCHEMA)
    for write in (table.put, lambda df: table.add(df, "s")):
        with pytest.raises(ValueError, match="NULL"):
            write(bad)
    assert table.read().count() == 0


def test_null_deltas_add_nothing(spark, base, name):
    table = KeyedTable(spark, name, "k", SCHEMA, buckets=4)
    table.put(base)
    table.add(spark.createDataFrame([(1, None), (9, None)], "k long, s long"), "s")
    assert rows(table.read().fillna(-1)) == [(1, "a", -1), (2, "b", 5)]


def test_types_stay_as_declared(spark, name):
    schema = "k long, n decimal(10,2), i int"
    table = KeyedTable(spark, name, "k", schema, buckets=2)
    table.put(spark.createDataFrame([(1, 2.0, 3.0)], "k long, n double, i double"))
    for _ in range(2):
        table.add(table.read().select("k", "n"), "n")
        table.add(table.read().select("k", "i"), "i")
    assert table.read().schema.simpleString() == "struct<k:bigint,n:decimal(10,2),i:int>"
    assert table.read().first()["i"] == 12


def test_reopening_checks_key_buckets_and_types(spark, base, name):
    KeyedTable(spark, name, "k", SCHEMA, buckets=4).put(base)
    assert KeyedTable(spark, name, "k", "k long, v string", buckets=4).read().count() == 2
    for key, schema, buckets in (("v", SCHEMA, 4), ("k", SCHEMA, 8), ("k", "k long, v int", 4), ("k", "k long, z int", 4)):
        with pytest.raises(ValueError, match="has"):
            KeyedTable(spark, name, key, schema, buckets=buckets)


def test_another_writer_is_noticed(spark, base, name):
    table = KeyedTable(spark, name, "k", SCHEMA, buckets=4)
    other = KeyedTable(spark, name, "k", SCHEMA, buckets=4)
    began = table._property("rankdex.version")
    other.put(base)
    with pytest.raises(RuntimeError, match="another writer"):
        table._publish(base.limit(1), began)
    assert table.read().count() == 2


def test_ties_are_broken_by_all_columns(spark, base):
    given = [(1, "b", 5), (1, "a", 5), (1, "c", 4)]
    for order in (given, given[::-1]):
        puts = spark.createDataFrame(order, SCHEMA)
        assert keyed_put(base, puts, "k", [F.col("s")]).where("k = 1").first()["v"] == "b"
        assert keyed_put(base, puts, "k", [F.col("s")], "first").where("k = 1").first()["v"] == "c"


def test_failed_write_leaves_the_table(spark, base, name):
    table = KeyedTable(spark, name, "k", SCHEMA, buckets=4)
    table.put(base)
    bad = base.withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        table.put(bad)
    assert rows(table.read().fillna(-1)) == [(1, "a", -1), (2, "b", 5)]


def test_put_does_not_shuffle_the_table(spark, base, name):
    table = KeyedTable(spark, name, "k", SCHEMA, buckets=8)
    table.put(spark.range(1000).select(F.col("id").alias("k"), F.lit("v").alias("v")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = keyed_put(table.read(), base, "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    left = plan[plan.index("FullOuter") : plan.index("FileScan")]
    assert "Exchange" not in left and "Bucketed: true" in plan
    assert len(table.read().inputFiles()) <= 8


def test_lookup_filters_the_stored_table(spark, name):
    table = KeyedTable(spark, name, "k", SCHEMA, buckets=8)
    table.put(spark.range(1000).select(F.col("id").alias("k"), F.lit("v").alias("v")))
    asked = spark.createDataFrame([(1, 5), (2, 5), (3, 9)], "id long, k long")
    found = fetch(asked, table.read(), "k", "id")
    assert rows(found.select("id", "k", "v")) == [(1, 5, "v"), (2, 5, "v"), (3, 9, "v")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(k, [5,9])" in plan or "PushedFilters: [In(k, [9,5])" in plan
    assert "Exchange hashpartitioning" not in plan


def test_load_popularity_with_repeated_documents(spark, name):
    """The same key twice: the least viewed row stays, and its nodes add up."""
    documents = spark.createDataFrame(
        [(1, "old", 50), (1, "new", 10), (2, "b", 30), (3, "c", 5)],
        "talk_id long, title string, views long",
    )
    edges = spark.createDataFrame(
        [(100, 1)] * 4 + [(200, 1)] * 3 + [(300, 1)] * 2, "followed long, follower long"
    )
    table = KeyedTable(spark, name, "talk_id", documents.schema, buckets=4)
    before = set(spark.sql(f"show tables in {name.split('.')[0]}").toPandas()["tableName"])
    load_popularity(table, documents, edges)
    after = set(spark.sql(f"show tables in {name.split('.')[0]}").toPandas()["tableName"])
    assert len(after - before) == 1  # one version
    expected = [(1, "new", 10, 400), (2, "b", 30, 200), (3, "c", 5, -1)]
    assert rows(table.read().fillna(-1)) == expected
    load_popularity(table, documents, edges)
    assert rows(table.read().fillna(-1)) == expected
