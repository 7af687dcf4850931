import random

import pytest
from pyspark.sql import functions as F

from rankdex.operators import selection
from rankdex.operators.pairing import pair_in_order
from rankdex.operators.ranking import follower_count
from rankdex.operators.selection import first_rows, sort_columns
from rankdex.plans.popularity import pair_by_popularity


@pytest.fixture(autouse=True)
def small_samples(monkeypatch):
    monkeypatch.setattr(selection, "SAMPLE_ROWS", 300)


def ids(df, order, n):
    return [r["id"] for r in df.orderBy(*sort_columns(order)).limit(n).collect()]


VALUES = {
    "no ties": "cast(pmod(xxhash64(id), 1000003) as long)",
    "ties": "id % 3",
    "all ties": "1",
    "few large": "case when id % 1000 = 7 then id else 0 end",
    "NULLs": "case when id % 3 > 0 then id % 50 end",
    "doubles": "cast(id as double) / 7 - 100",
    "text": "cast(id * 37 % 5000 as string)",
    "decimals": "cast(id % 700 as decimal(12,3)) / 7",
    "days": "date_add(date'2020-01-01', cast(id % 400 as int))",
}


@pytest.mark.parametrize("value", VALUES)
@pytest.mark.parametrize("ascending", [True, False])
def test_first_rows_and_few_others(spark, value, ascending):
    rows = spark.range(20_000).select("id", F.expr(VALUES[value]).alias("v"))
    order = [("v", ascending), ("id", not ascending)]
    for wanted in (1, 700, 9_000):
        found = first_rows(rows, order, wanted, slack=100)
        assert ids(found, order, wanted) == ids(rows, order, wanted)
        assert wanted <= found.count() <= wanted + max(wanted // 4, 100)


def test_none_and_all(spark):
    rows = spark.range(2_000)
    assert first_rows(rows, [("id", True)], 0).count() == 0
    assert first_rows(rows, [("id", True)], 5_000, slack=0).count() == 2_000
    assert first_rows(rows.limit(0), [("id", True)], 5, slack=0).count() == 0


def test_equal_rows_all_come(spark):
    rows = spark.range(5_000).select((F.col("id") * 0).alias("id"))
    assert first_rows(rows, [("id", True)], 10, slack=0).count() == 5_000


def test_rows_are_not_shuffled(spark):
    rows = spark.range(5_000)
    plan = first_rows(rows, [("id", False)], 10, slack=0)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


@pytest.mark.parametrize("left, right", [(4000, 300), (300, 4000), (50, 50), (0, 900)])
def test_pairs_sort_about_the_shorter_side(spark, left, right):
    rng = random.Random(left)
    a = [(i, rng.randrange(40)) for i in range(left)]
    b = [(i, rng.randrange(40)) for i in range(right)]
    paired = pair_in_order(
        spark.createDataFrame(a, "a long, x long"), [("x", False), ("a", True)],
        spark.createDataFrame(b, "b long, y long"), [("y", True), ("b", False)], slack=20,
    )
    first = sorted(a, key=lambda r: (-r[1], r[0]))
    second = sorted(b, key=lambda r: (r[1], -r[0]))
    expected = [(i, *x, *y) for i, (x, y) in enumerate(zip(first, second))]
    assert sorted(tuple(r[c] for c in ("ix", "a", "x", "b", "y")) for r in paired.collect()) == expected
    shorter = min(left, right)
    sizes = {}
    for file in paired.inputFiles():  # what was sorted and stored
        folder = file.rsplit("/", 1)[0]
        sizes[folder] = sizes.get(folder, 0) + spark.read.parquet(file).count()
    assert sizes and max(sizes.values(), default=0) <= shorter + max(shorter // 4, 20)


def test_popularity_of_few_documents_and_many_nodes(spark):
    documents = spark.createDataFrame([(1, 999), (2, 65051954), (3, 7000), (4, 10)], "talk_id long, views long")
    edges = spark.range(30_000).select((F.col("id") % 20_011).alias("followed"), F.col("id").alias("follower"))
    pairs = pair_by_popularity(documents, edges).orderBy("ix").collect()
    assert [(r["talk_id"], r["social_id"]) for r in pairs] == [(2, 0), (3, 1), (1, 2), (4, 3)]
    assert follower_count(edges).count() == 20_011
