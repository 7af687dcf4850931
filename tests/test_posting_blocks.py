import random

import pytest
from hypothesis import given, settings, strategies as st

import pyarrow as pa

from rankdex.operators.posting_blocks import (
    _cut,
    block_heads,
    from_blocks,
    read_blocks,
    to_blocks,
    write_blocks,
)
from rankdex.operators.postings import posting_heads
from rankdex.plans.keyword_search import search_pages

SCHEMA = "keyword string, doc_id long"


@pytest.fixture(scope="module")
def postings(spark):
    """A word of every document, one of most, rare ones; ids far apart and below 0."""
    rng = random.Random(3)
    ids = rng.sample(range(-(10**12), 10**12), 3000) + [-(2**63), 2**63 - 1]
    rows = [("all", i) for i in ids] + [("most", i) for i in ids if i % 3]
    rows += [(f"w{i % 400}", i) for i in ids]
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


@settings(max_examples=100, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from("abc"), st.integers(-(2**63), 2**63 - 1)), max_size=40),
    st.integers(1, 7),
    st.integers(1, 9),
)
def test_cutting_batches(rows, size, batch):
    """Blocks are full but for a keyword's last one, wherever batches end."""
    rows = sorted(rows)
    table = pa.table(
        {"keyword": pa.array([k for k, _ in rows], pa.string()), "doc_id": pa.array([i for _, i in rows], pa.int64())}
    )
    batches = [b for b in table.to_batches(max_chunksize=batch)]
    found, sizes = [], {}
    for packed in _cut(size)(iter(batches)):
        for block in packed.to_pylist():
            at = block["first_id"]
            assert block["gaps"][0] == 0 and len(block["gaps"]) == block["n"] <= size
            for gap in block["gaps"]:
                at = (at + gap + 2**63) % 2**64 - 2**63
                found.append((block["keyword"], at))
            sizes.setdefault(block["keyword"], []).append(block["n"])
    assert found == rows
    assert all(n == size for counts in sizes.values() for n in counts[:-1])


@pytest.mark.parametrize("size", [1, 7, 128])
def test_blocks_hold_all_postings(spark, postings, tmp_path, size):
    path = str(tmp_path / "blocks")
    write_blocks(postings, path, size)
    blocks = read_blocks(spark, path)
    assert pairs(from_blocks(blocks)) == pairs(postings)
    assert blocks.where("n > %d or n <> size(gaps) or gaps[0] <> 0" % size).isEmpty()
    # Blocks of a keyword do not overlap.
    ranges = sorted((r["keyword"], r["first_id"]) for r in blocks.collect())
    assert len(set(ranges)) == len(ranges)


def test_hot_keyword_is_cut_by_several_tasks(spark, postings):
    blocks = to_blocks(postings.where("keyword = 'all'"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert blocks.selectExpr("spark_partition_id() p").distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("depth", [1, 15, 75, 200])
def test_heads_of_blocks(spark, postings, depth):
    expected = pairs(posting_heads(postings, depth).selectExpr("keyword", "explode(doc_ids)"))
    own = to_blocks(postings, 9)
    halves = [postings.where(f"pmod(doc_id, 2) = {half}") for half in (0, 1)]
    overlapping = to_blocks(halves[0], 9).unionByName(to_blocks(halves[1], 40))
    for blocks in (own, overlapping):
        found = block_heads(blocks, depth)
        assert pairs(found.selectExpr("keyword", "explode(doc_ids)")) == expected
        assert all(r["doc_ids"] == sorted(r["doc_ids"]) for r in found.collect())


def test_heads_limit_blocks_before_the_shuffle(spark, postings, tmp_path):
    write_blocks(postings, str(tmp_path / "blocks"))
    plan = block_heads(read_blocks(spark, str(tmp_path / "blocks")), 15)._jdf.queryExecution().executedPlan()
    assert plan.toString().count("WindowGroupLimit") == 2


def test_search_in_blocks(spark, postings, tmp_path):
    path = str(tmp_path / "blocks")
    write_blocks(postings, path, 10)
    queries = spark.createDataFrame(
        [(1, "most all"), (2, "all w"), (3, "nothing"), (4, "")], "query_id long, query string"
    )
    for page in (1, 2, 5):
        expected = search_pages(queries, postings, page, stem=False)
        assert pairs(search_pages(queries, read_blocks(spark, path), page, stem=False)) == pairs(expected)
    plan = search_pages(queries, read_blocks(spark, path), stem=False)._jdf.queryExecution().toString()
    assert "In(keyword" in plan[plan.index("PushedFilters: [") :]


def test_odd_rows(spark):
    rows = [("a", 1), ("a", 1), ("a", None), (None, 2), ("", 3)]
    assert pairs(from_blocks(to_blocks(spark.createDataFrame(rows, SCHEMA)))) == [("", 3), ("a", 1), ("a", 1)]
    empty = spark.createDataFrame([], SCHEMA)
    assert from_blocks(to_blocks(empty)).count() == 0 and block_heads(to_blocks(empty), 5).count() == 0
    with pytest.raises(TypeError, match="whole numbers"):
        to_blocks(spark.createDataFrame([("a", "x")], "keyword string, doc_id string"))
