import random

import pytest
from pyspark.sql import functions as F

from rankdex.functions.porter import stem
from rankdex.operators import lookup
from rankdex.operators.lookup import fetch, measure, missing, spread_join
from rankdex.operators.postings import (
    inverted_index,
    posting_heads,
    read_heads,
    read_postings,
    write_index,
)
from rankdex.operators.search import page_hits, query_bags, result_pages
from rankdex.plans.drilldown import detail_lookup, expand_related, search_topics
from rankdex.plans.keyword_search import search, search_pages
from rankdex.scratch import materialise

POSTINGS = [("a", d) for d in range(1, 21)] + [("b", d) for d in range(11, 41)]


@pytest.fixture(scope="module")
def postings(spark):
    return spark.createDataFrame(POSTINGS, "keyword string, doc_id long").repartition(3, "doc_id")


def hits(spark, postings, query, page, **options):
    queries = spark.createDataFrame([(1, query)], "query_id long, query string")
    row = search_pages(queries, postings, page, **options).first()
    assert row["low"] == 15 * (page - 1) + 1
    assert row["high"] == row["low"] - 1 + len(row["hits"])
    return row["hits"]


def span(first, last):
    return list(range(first, last + 1))


@pytest.mark.parametrize(
    "query, page, expected",
    [
        ("a b", 1, span(1, 15)),
        ("a b", 2, span(16, 30)),
        ("a b", 3, span(31, 40)),
        ("a b", 4, []),
        ("a b", 5, []),
        ("b a", 1, span(11, 25)),
        ("b a", 3, span(1, 10)),
        ("A a", 2, span(16, 20)),
        ("a  b", 3, span(31, 40)),
        ("z z z z z z z z z z z z z z b a", 1, span(11, 25)),
        ("z z z z z z z z z z z z z z z b", 1, []),
        ("c", 1, []),
        ("", 1, []),
    ],
)
def test_pages(spark, postings, query, page, expected):
    assert hits(spark, postings, query, page) == expected


@pytest.mark.parametrize(
    "page, expected",
    [
        (1, span(1, 15)),
        (2, span(15, 20) + span(11, 14) + span(21, 25)),
        (3, span(20, 34)),
        (4, span(35, 40)),
        (5, []),
    ],
)
def test_compat_pages(spark, postings, page, expected):
    assert hits(spark, postings, "a b", page, compat=True) == expected


def compat_pages(lists, page):
    """Distinct documents of the bag from ordinal 15 (page - 1) on, of which 15."""
    bag = [d for documents in lists for d in documents]
    rest = bag[max(0, 15 * (page - 1) - 1) :]
    return list(dict.fromkeys(rest))[:15]


def distinct_scan(lists, page):
    seen = list(dict.fromkeys(d for documents in lists for d in documents))
    return seen[15 * (page - 1) : 15 * page]


@pytest.mark.parametrize("compat", [False, True])
def test_pages_against_scan(spark, compat):
    """Random indexes with lists longer than a search reads: cutting lists is exact."""
    draw = random.Random(7)
    lists = {
        f"w{i}": sorted(draw.sample(range(260), draw.choice([0, 3, 20, 60, 150, 250])))
        for i in range(60)
    }
    rows = [(word, d) for word, documents in lists.items() for d in documents]
    index = spark.createDataFrame(rows, "keyword string, doc_id long").repartition(5, "doc_id")
    queries = [
        (q, [draw.choice(list(lists)) for _ in range(draw.randint(1, 15))]) for q in range(150)
    ]
    table = spark.createDataFrame(
        [(q, " ".join(words)) for q, words in queries], "query_id long, query string"
    )
    for page in range(1, 6):
        pages = search_pages(table, index, page, stem=False, compat=compat).collect()
        got = {r["query_id"]: r["hits"] for r in pages}
        for q, words in queries:
            documents = [lists[word] for word in words]
            if compat:
                expected = compat_pages(documents, page)
            else:
                expected = distinct_scan(documents, page)
            assert got[q] == expected, (page, words)


def test_a_repeated_query_id_fails(spark, postings):
    schema = "query_id long, query string"
    for rows in ([(1, "a"), (1, "b")], [(1, ""), (1, "a")], [(1, ""), (1, "")]):
        with pytest.raises(ValueError, match="not unique"):
            search_pages(spark.createDataFrame([(2, "a"), *rows], schema), postings).collect()


def test_files_of_heads_do_not_overlap(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = spark.range(20_000).selectExpr("concat('w', id % 3000) keyword", "id doc_id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_index(rows, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = []
    for file in read_heads(spark, path).inputFiles():
        spans.append(tuple(spark.read.parquet(file).selectExpr("min(keyword)", "max(keyword)").first()))
    spans.sort()
    assert len(spans) > 1 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_cold_keys_join_stored_buckets(spark, large):
    """A hot key does not shuffle the wide side for the others."""
    database = f"t_{__import__('uuid').uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {database}")
    wide = spark.range(2_000).selectExpr("id k", "repeat('x', 50) text")
    wide.write.bucketBy(4, "k").sortBy("k").saveAsTable(f"{database}.wide")
    many = spark.range(3_000).selectExpr("id", "if(id % 3 = 0, 7, id % 2000) k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spread_join(many, spark.table(f"{database}.wide"), "k", "id", 3_000, "inner", large)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The cold keys' half comes first in the union; its wide side is sorted where it is.
    cold = plan[: plan.index("_copy")]
    wide_side = cold[cold.rindex("+- Sort", 0, cold.index("Bucketed: true")) : cold.index("Bucketed: true")]
    assert "Exchange" not in wide_side
    assert joined.count() == 3_000


def test_null_keywords_are_not_joined(spark, postings, large):
    queries = spark.range(300).selectExpr("id query_id", "if(id % 3 = 0, 'a', ' ') query")
    bags = query_bags(queries, postings, 15, limits=large)
    assert sorted((r.query_id, len(r.bag)) for r in bags.collect()) == [
        (i, 15 if i % 3 == 0 else 0) for i in range(300)
    ]


def test_validity_is_optional(spark, postings):
    queries = spark.createDataFrame([(1, "a"), (2, "a 2"), (3, "")], "query_id long, query string")
    every = search_pages(queries, postings)
    valid = search_pages(queries, postings, only_valid=True)
    assert sorted(r["query_id"] for r in every.collect()) == [1, 2, 3]
    assert [r["query_id"] for r in valid.collect()] == [1]


def test_hit_without_document(spark, postings):
    queries = spark.createDataFrame([(1, "a")], "query_id long, query string")
    documents = spark.range(5, 100).select(F.col("id").alias("doc_id"), F.lit("t").alias("title"))
    found = search(queries, postings, documents).orderBy("rank")
    assert [r["rank"] for r in found.collect()] == span(5, 15)
    lacking = missing(page_hits(search_pages(queries, postings)), documents, "doc_id")
    assert sorted(tuple(r) for r in lacking.collect()) == [(d, 1) for d in span(1, 4)]


def test_index_of_texts(spark):
    documents = spark.createDataFrame(
        [(1, "Cats, cat\nponies"), (2, "pony 7 L'été"), (3, ""), (4, None)],
        "doc_id long, text string",
    )
    expected = [("cat", 1), ("l", 2), ("poni", 1), ("poni", 2), ("été", 2)]
    assert sorted(tuple(r) for r in inverted_index(documents).collect()) == expected
    plain = inverted_index(documents, stem=False)
    assert ("ponies", 1) in [tuple(r) for r in plain.collect()]
    twice = inverted_index(documents.union(documents), unique_key=False)
    assert sorted(tuple(r) for r in twice.collect()) == expected


def test_index_of_whole_texts(spark, table):
    documents = table("documents").select("doc_id", "text")
    got = {tuple(r) for r in inverted_index(documents).collect()}
    letters = __import__("regex").compile(r"\p{L}+")
    expected = {
        (stem(word), r["doc_id"])
        for r in documents.collect()
        for word in letters.findall(r["text"].lower())
    }
    assert got == expected


def test_stored_index(spark, postings, tmp_path):
    path = str(tmp_path / "index")
    write_index(postings, path)
    stored = sorted(tuple(r) for r in read_postings(spark, path).collect())
    assert stored == sorted(POSTINGS)
    heads = read_heads(spark, path)
    assert {r["keyword"]: r["doc_ids"] for r in heads.collect()} == {
        "a": span(1, 20),
        "b": span(11, 40),
    }
    for page in range(1, 6):
        assert hits(spark, heads, "a b", page) == hits(spark, postings, "a b", page)
    for index in (heads, postings):
        with pytest.raises(ValueError, match="pages"):
            hits(spark, index, "a b", 6)


def test_search_reads_only_the_words_asked_for(spark, postings, tmp_path):
    path = str(tmp_path / "index")
    write_index(postings, path)
    queries = spark.createDataFrame([(1, "a b")], "query_id long, query string")
    plan = search_pages(queries, read_heads(spark, path))._jdf.queryExecution().toString()
    pushed = plan[plan.index("PushedFilters: ["):]
    assert "In(keyword, [a,b])" in pushed or "In(keyword, [b,a])" in pushed, pushed


def test_heads_limit_before_the_shuffle(spark, postings):
    plan = posting_heads(postings, 15)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    partial = plan.index("Partial", plan.index("WindowGroupLimit"))
    assert plan.index("Exchange hashpartitioning(keyword") < partial


@pytest.fixture
def large():
    """Treat the test tables as too large to broadcast, and three rows as many."""
    return lookup.Limits(rows_per_key=3, broadcast_rows=0, broadcast_bytes=0, broadcast_ids=0)


def test_large_search_equals_small_one(spark, table, large):
    documents = table("documents")
    queries = table("benchmark").select(
        F.col("item_id").alias("query_id"), F.regexp_replace("text", r"[^\p{L}]+", " ").alias("query")
    )
    shown = documents.select("doc_id", "lang")

    def result(limits):
        bags = query_bags(queries, inverted_index(documents), 30, limits=limits)
        hits = materialise(page_hits(result_pages(bags, 2)), "hits")
        return sorted(tuple(r) for r in fetch(hits, shown, "doc_id", "query_id", limits).collect())

    spread = result(large)
    assert spread == result(lookup.LIMITS)
    assert len(spread) > 500


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join(spark, large, how):
    """A third of the rows on one key: same rows as a plain join, key in many tasks."""
    many = spark.range(900).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k")
    )
    one = spark.range(0, 700).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = spread_join(many, one, "k", "id", 900, how, large)
    assert joined.columns == ["k", "id", "v"]
    plain = many.join(one, "k", how)
    assert joined.exceptAll(plain).count() == 0 and plain.exceptAll(joined).count() == 0


@pytest.mark.parametrize("keys", [0, 5, 1000])
def test_fetch_ways_agree(spark, large, keys):
    many = spark.range(600).select("id", (F.col("id") % max(keys, 1)).alias("k")).limit(keys and 600)
    one = spark.range(0, 400).select(F.col("id").alias("k"), F.lit("wide").alias("text"))
    ways = large, lookup.LIMITS, lookup.Limits(filter_keys=0)
    one_way, *others = (sorted(tuple(r) for r in fetch(many, one, "k", "id", way).collect()) for way in ways)
    assert all(one_way == other for other in others)


def test_measure(spark):
    df = spark.createDataFrame(
        [(1, "é" * 100, list(range(1000))), (2, None, None)], "k long, s string, a array<long>"
    )
    rows, size = measure(df)
    assert rows == 2 and 200 + 2000 < size < 6000
    assert measure(df.limit(0)) == (0, 0)


def test_small_fetch_does_not_shuffle_documents(spark, table):
    many = spark.range(500).select("id", F.col("id").alias("doc_id"))
    fetched = fetch(many, table("documents"), "doc_id", "id")
    plan = fetched._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(doc_id" not in plan.split("BroadcastExchange")[0]
    assert "SortMergeJoin" not in plan


def test_topic_search(spark):
    documents = spark.createDataFrame(
        [(1, "cats", ["cats", "dogs"]), (2, "a cat and a dog", ["cats"]), (3, "dog", [])],
        "doc_id long, text string, topics array<string>",
    )
    found = search_topics(documents, inverted_index(documents))
    ranks = sorted((r["topic"], r["rank"], r["doc_id"]) for r in found.collect())
    assert ranks == [("cats", 1, 1), ("cats", 2, 2), ("dogs", 1, 2), ("dogs", 2, 3)]


def test_related(spark):
    documents = spark.createDataFrame(
        [(1, "x", {9: "gone", 2: "two"}), (2, "y", {1: "one"}), (3, "z", {})],
        "doc_id long, title string, related map<long,string>",
    )
    linked = expand_related(documents, documents.select("doc_id", "title"))
    columns = ("doc_id", "place", "related_id", "related_title", "target_title")
    assert sorted(tuple(r) for r in linked.select(*columns).collect()) == [
        (1, 0, 2, "two", "y"),
        (2, 0, 1, "one", "x"),
    ]


def test_detail_lookup(spark):
    documents = spark.createDataFrame([(12, "a"), (7, "b")], "doc_id long, title string")
    requests = spark.createDataFrame(
        [(1, "12abc"), (2, " 7"), (3, "abc"), (4, "99"), (5, "12")],
        "request_id long, raw_id string",
    )
    found = detail_lookup(requests, documents)
    assert sorted((r["request_id"], r["title"]) for r in found.collect()) == [
        (1, "a"), (2, "b"), (5, "a"),
    ]


def test_long_texts_reach_the_stemmer_in_parts(spark, monkeypatch):
    """However long texts are, a row that goes to Python holds a few words; the stems of a
    text are made distinct over all its parts, also where an Arrow batch ends within it."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    many = [f"q{x}{y}{z}{end}" for x in letters[:9] for y in letters for z in "bdk" for end in ("", "s", "ing")]
    texts = [(1, " ".join(many)), (2, "Cats cat"), (None, "cats"), (2, "cat pony"), (3, ""), (4, None), (5, many[0])]
    documents = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    given = []
    kind, run = type(documents), type(documents).mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda df, *rest: given.append(df) or run(df, *rest))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = sorted((s, i) for i, text in texts if i and text for s in {stem(w) for w in text.lower().split()})
    try:
        for rows in (1, 7, 10_000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
            got = [tuple(r) for r in inverted_index(documents).collect()]
            assert sorted(r for r in got if r[1]) == expected
            assert [r for r in got if not r[1]] == [("cat", None)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(given) == 3
    assert given[0].select(F.max(F.size("words"))).first()[0] <= 32
