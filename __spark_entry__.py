"""

``queries()[name](spark, sf_dir)`` is the Spark side and ``oracle_sql()[name]`` the
same result in SQL for DuckDB. Each query reads whole tables and whole texts.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle_parts import (  # noqa: E402
    HITS,
    PAIRING,
    QUERIES,
    STEMMED_INDEX,
    UNSTEMMED_HITS,
    WORDS,
    page_sql,
)
from rankdex.functions.literals import normalise, related_entries  # noqa: E402
from rankdex.functions.text import replace_first, valid_query  # noqa: E402
from rankdex.operators.lookup import Limits, fetch, missing  # noqa: E402
from rankdex.operators.pairing import cogroup, pair_in_order, side_sizes  # noqa: E402
from rankdex.operators.posting_blocks import read_blocks, write_blocks  # noqa: E402
from rankdex.operators.postings import inverted_index, read_heads, write_index  # noqa: E402
from rankdex.operators.ranking import (  # noqa: E402
    dense_index,
    follower_count,
    rank_documents,
    rank_nodes,
)
from rankdex.operators.search import page_hits  # noqa: E402
from rankdex.operators.upsert import keyed_add, keyed_put  # noqa: E402
from rankdex.plans.drilldown import detail_lookup, expand_related, search_topics  # noqa: E402
from rankdex.plans.keyword_search import search, search_pages  # noqa: E402
from rankdex.plans.popularity import load_popularity, pair_by_popularity  # noqa: E402
from rankdex.scratch import materialise, scratch_path  # noqa: E402
from rankdex.sources.documents import DOCUMENT_SCHEMA, read_documents  # noqa: E402
from rankdex.sources.edges import read_edges  # noqa: E402
from rankdex.sources.keyed_table import KeyedTable  # noqa: E402
from rankdex.sources.rows import local_rows  # noqa: E402

# The operators on training data may be left out, with the pipeline made of them.
try:
    from rankdex.llm.queries import ORACLE_SQL as _MORE_SQL, QUERIES as _MORE_QUERIES
except ImportError:
    _MORE_QUERIES, _MORE_SQL = {}, {}
try:
    import corpus_pipeline
except ImportError:
    pass
else:
    _MORE_QUERIES = {**_MORE_QUERIES, "pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL:
        _MORE_SQL = {**_MORE_SQL, "pipeline": corpus_pipeline.ORACLE_SQL}

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(sql: str | None = None, name: str | None = None):
    def add(function: Query) -> Query:
        key = name or function.__name__
        _QUERIES[key] = function
        if sql:
            _SQL[key] = sql
        return function

    return add


def entry(spark: SparkSession) -> DataFrame:
    """The most viewed document with the most followed node, and so on."""
    return rank_pairing(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {**_QUERIES, **_MORE_QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**_SQL, **_MORE_SQL}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- counting, ranking, pairing ---------------------------------------------------


def _degrees(spark: SparkSession, sf_dir: str, followed: str) -> DataFrame:
    return follower_count(_table(spark, sf_dir, "lineitem"), followed)


@register("select l_partkey node_id, count(*) followers from lineitem group by 1", "follower_count")
def _follower_count(spark, sf_dir):
    return _degrees(spark, sf_dir, "l_partkey")


@register(
    """select node_id, followers, row_number() over (order by followers desc, node_id) - 1 ix
    from (select l_partkey node_id, count(*) followers from lineitem group by 1)"""
)
def follower_rank(spark, sf_dir):
    return rank_nodes(_degrees(spark, sf_dir, "l_partkey"))


@register(
    """select doc_id, n_chars, row_number() over (order by n_chars desc, doc_id) - 1 ix
    from documents"""
)
def doc_rank_numeric(spark, sf_dir):
    return rank_documents(_table(spark, sf_dir, "documents"), "doc_id", "n_chars")


@register(
    """select doc_id, n_chars,
        row_number() over (order by cast(n_chars as varchar) desc, doc_id) - 1 ix
    from documents"""
)
def doc_rank_lexical(spark, sf_dir):
    return rank_documents(_table(spark, sf_dir, "documents"), "doc_id", "n_chars", lexical=True)


@register(
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
        row_number() over (
            order by l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 ix
    from lineitem"""
)
def dense_index_heavy_ties(spark, sf_dir):
    """A global index whose leading sort value covers a third of the rows."""
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = _table(spark, sf_dir, "lineitem").select("l_returnflag", *key)
    return dense_index(rows, [F.col(c).asc() for c in rows.columns]).drop("l_returnflag")


@register(f"with {PAIRING('n_chars desc')} select ix, doc_id, social_id from paired")
def rank_pairing(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    edges = _table(spark, sf_dir, "lineitem")
    return pair_by_popularity(documents, edges, "doc_id", "n_chars", "l_partkey")


@register(
    f"with {PAIRING('cast(n_chars as varchar) desc')} select ix, doc_id, social_id from paired"
)
def rank_pairing_lexical(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    edges = _table(spark, sf_dir, "lineitem")
    return pair_by_popularity(documents, edges, "doc_id", "n_chars", "l_partkey", lexical=True)


@register(
    """with left_ix as (
        select c_custkey, row_number() over (order by c_acctbal desc, c_custkey) - 1 ix
        from customer),
    right_ix as (
        select node_id, row_number() over (order by followers desc, node_id) - 1 ix
        from (select l_suppkey node_id, count(*) followers from lineitem group by 1))
    select ix, c_custkey, node_id, followers from left_ix join right_ix using (ix)
    join (select l_suppkey node_id, count(*) followers from lineitem group by 1) using (node_id)"""
)
def rank_pairing_small_right(spark, sf_dir):
    """Many customers and few nodes; the first customers are selected before any sort, also
    where they are few."""
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    nodes = _degrees(spark, sf_dir, "l_suppkey")
    richest, most = [("c_acctbal", False), ("c_custkey", True)], [("followers", False), ("node_id", True)]
    return pair_in_order(customers, richest, nodes, most, slack=0).drop("c_acctbal")


@register(
    """select 'left' side, count(*) n from documents
    union all select 'right', count(distinct l_partkey) from lineitem""",
    "side_sizes",
)
def _side_sizes(spark, sf_dir):
    return side_sizes(_table(spark, sf_dir, "documents"), _degrees(spark, sf_dir, "l_partkey"))


@register(
    """with r as (
        select o_custkey k, 0 side, o_orderkey v from orders
        union all select l_suppkey, 1, l_orderkey from lineitem),
    n as (select *, (row_number() over (partition by k order by side, v) - 1) // 500 chunk from r)
    select k "key", chunk,
        coalesce(string_agg(cast(v as varchar), ',' order by v) filter (where side = 0), '')
            left_values,
        coalesce(string_agg(cast(v as varchar), ',' order by v) filter (where side = 1), '')
            right_values
    from n group by 1, 2"""
)
def cogroup_chunks(spark, sf_dir):
    """Keys of more than 500 values in chunks, the others whole."""
    return _cogroup_text(spark, sf_dir, chunk_rows=500)


@register(
    """with l as (select o_custkey k, array_agg(o_orderkey order by o_orderkey) vs from orders group by 1),
    r as (select l_suppkey k, array_agg(l_orderkey order by l_orderkey) vs from lineitem group by 1)
    select k "key", 0 chunk, coalesce(array_to_string(l.vs, ','), '') left_values,
        coalesce(array_to_string(r.vs, ','), '') right_values
    from l full join r using (k)"""
)
def cogroup_lists(spark, sf_dir):
    return _cogroup_text(spark, sf_dir)


def _cogroup_text(spark, sf_dir, **options):
    orders = _table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "key")
    lineitem = _table(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "key")
    groups = cogroup(orders, lineitem, "key", "o_orderkey", "l_orderkey", **options)

    def text(values: str) -> Column:
        return F.array_join(F.col(values).cast("array<string>"), ",").alias(values)

    return groups.select("key", "chunk", text("left_values"), text("right_values"))


# --- sources ----------------------------------------------------------------------


@register("select l_partkey followed, l_suppkey follower from lineitem")
def edge_text_parse(spark, sf_dir):
    path = scratch_path(spark, "edges")
    lines = F.concat_ws(" ", "l_partkey", "l_suppkey", "l_returnflag")
    _table(spark, sf_dir, "lineitem").select(lines.alias("value")).write.text(path)
    return read_edges(spark, path)


@register("select l_partkey followed, l_suppkey follower from lineitem where l_linenumber <> 1")
def edge_text_drop(spark, sf_dir):
    """Lines that are no edges, here every first line of an order, left out."""
    path = scratch_path(spark, "edges")
    broken = F.when(F.col("l_linenumber") == 1, F.lit("x")).otherwise(F.col("l_partkey").cast("string"))
    lines = F.concat_ws(" ", broken, "l_suppkey")
    _table(spark, sf_dir, "lineitem").select(lines.alias("value")).write.text(path)
    return read_edges(spark, path, mode="drop")


@register(
    """select doc_id talk_id, text description, 'say "' || source || '"' title, '' speaker_1,
        n_chars views, n_chars // 60 duration, '[''' || lang || ''', ''x'']' topics,
        '{' || doc_id || ': ''a, b''}' related_talks,
        'https://www.example.com/' || lang url
    from documents"""
)
def csv_by_header(spark, sf_dir):
    """Whole documents as CSV with shuffled and additional columns, read by name."""
    path = scratch_path(spark, "csv")
    documents = _table(spark, sf_dir, "documents").select(
        F.format_string("https://www.example.com/%s", "lang").alias("url"),
        F.col("n_chars").alias("views"),
        F.lit("").alias("speaker_1"),
        F.col("text").alias("description"),
        F.lit("extra").alias("event"),
        F.format_string("{%d: 'a, b'}", "doc_id").alias("related_talks"),
        F.format_string('say "%s"', "source").alias("title"),
        F.col("doc_id").alias("talk_id"),
        F.floor(F.col("n_chars") / 60).alias("duration"),
        F.format_string("['%s', 'x']", "lang").alias("topics"),
    )
    documents.write.option("header", True).option("escape", '"').csv(path)
    return read_documents(spark, path)


@register(
    """select doc_id talk_id, coalesce(text, '') description, 'a "b"' || chr(10) || '",' || lang title,
        source || chr(10) speaker_1, n_chars "views", cast(0 as bigint) duration, '"' topics, '' related_talks,
        '5" disk' url
    from documents"""
)
def csv_split_files(spark, sf_dir):
    """Whole documents as CSV with quotes and line breaks in most fields, and read in
    splits far smaller than its files."""
    path = scratch_path(spark, "csv")
    documents = _table(spark, sf_dir, "documents").select(
        F.lit('5" disk').alias("url"),
        F.concat(F.lit('a "b"\n",'), "lang").alias("title"),
        F.col("text").alias("description"),
        F.concat("source", F.lit("\n")).alias("speaker_1"),
        F.col("n_chars").alias("views"),
        F.lit('"').alias("topics"),
        F.lit("").alias("related_talks"),
        F.lit(0).alias("duration"),
        F.col("doc_id").alias("talk_id"),
    )
    writer = documents.write.option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    small = {"spark.sql.files.maxPartitionBytes": "256k", "spark.sql.files.openCostInBytes": "0"}
    before = {name: spark.conf.get(name) for name in small}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        return materialise(read_documents(spark, path), "documents")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@register(
    """select p.code, count(*) orders
    from orders left join (values ('1-URGENT', 'a'), ('2-HIGH', 'b'), ('5-LOW', 'c')) p (name, code)
        on o_orderpriority = p.name
    group by 1""",
    "local_rows",
)
def _local_rows(spark, sf_dir):
    codes = local_rows(
        spark,
        [("1-URGENT", "a"), ("2-HIGH", "b"), ("5-LOW", "c")],
        "o_orderpriority string not null, code string not null",
    )
    orders = _table(spark, sf_dir, "orders").join(F.broadcast(codes), "o_orderpriority", "left")
    return orders.groupBy("code").agg(F.count(F.lit(1)).alias("orders"))


# --- keyed tables -----------------------------------------------------------------

_PUT_SQL = """
    last_order as (
        select o_custkey k, o_orderstatus s, o_orderkey n from orders
        qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1),
    put as (
        select c_custkey k, c_mktsegment s, c_nationkey n, c_name note from customer
        where c_custkey not in (select k from last_order)
        union all select k, s, n, null from last_order)"""
_ADD_SQL = """
    deltas as (select l_suppkey * 40 k, cast(sum(l_orderkey) as bigint) d from lineitem group by 1)"""


def _base(spark, sf_dir):
    return _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"),
        F.col("c_mktsegment").alias("s"),
        F.col("c_nationkey").cast("long").alias("n"),
        F.col("c_name").alias("note"),
    )


def _puts(spark, sf_dir):
    return _table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("k"),
        F.col("o_orderstatus").alias("s"),
        F.col("o_orderkey").alias("n"),
        "o_orderdate",
    )


_PUT_ORDER = ["o_orderdate", "n"]


def _deltas(spark, sf_dir):
    return _table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") * 40).alias("k"), F.col("l_orderkey").alias("n")
    )


@register(f"with {_PUT_SQL} select k, s, n, note from put", "keyed_put")
def _keyed_put(spark, sf_dir):
    put = keyed_put(_base(spark, sf_dir), _puts(spark, sf_dir), "k", order_by=_PUT_ORDER)
    return put.drop("o_orderdate")


@register(
    f"""with {_ADD_SQL},
    base as (
        select c_custkey k, c_mktsegment s,
            case when c_nationkey < 20 then c_nationkey end n from customer)
    select k, s, case when d is null then n else coalesce(n, 0) + d end n
    from base full join deltas using (k)""",
    "keyed_add",
)
def _keyed_add(spark, sf_dir):
    base = _base(spark, sf_dir).select("k", "s", F.when(F.col("n") < 20, F.col("n")).alias("n"))
    return keyed_add(base, _deltas(spark, sf_dir), "k", "n")


def _scratch_table(spark: SparkSession, key: str, schema: str, buckets: int = 16) -> KeyedTable:
    """A keyed table of its own in the shared folder."""
    database = f"rankdex_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {database} LOCATION '{scratch_path(spark, 'tables')}'")
    return KeyedTable(spark, f"{database}.items", key, schema, buckets=buckets)


@register(
    f"""with {_PUT_SQL}, {_ADD_SQL}
    select k, s, case when d is null then n else coalesce(n, 0) + d end n, note
    from put full join deltas using (k)"""
)
def keyed_table(spark, sf_dir):
    """Create, put twice and add, each as a stored version."""
    table = _scratch_table(spark, "k", "k long, s string, n long, note string")
    table.put(_base(spark, sf_dir))
    table.put(_puts(spark, sf_dir), order_by=_PUT_ORDER)
    again = KeyedTable(spark, table.name, "k", "k long, s string, n long, note string", buckets=16)
    again.add(_deltas(spark, sf_dir), "n")
    return again.read().drop("o_orderdate")


@register(
    """with richest as (
        select c_nationkey, max_by(c_custkey, (c_acctbal, c_custkey)) k from customer group by 1)
    select c_custkey k, case when r.k is null then c_mktsegment else 'RICHEST' end s,
        case when r.k is null then c_custkey else 2 * c_custkey end n
    from customer left join richest r on c_custkey = r.k"""
)
def keyed_few_buckets(spark, sf_dir):
    """A table of all customers, and a put and an add of one customer a nation, which
    write the buckets of those only."""
    customers = _table(spark, sf_dir, "customer")
    table = _scratch_table(spark, "k", "k long, s string, n long", buckets=64)
    key = F.col("c_custkey").alias("k")
    table.put(customers.select(key, F.col("c_mktsegment").alias("s"), F.col("c_custkey").alias("n")))
    richest = customers.groupBy("c_nationkey").agg(F.max(F.struct("c_acctbal", "c_custkey"))["c_custkey"].alias("k"))
    richest = materialise(richest.select("k", F.lit("RICHEST").alias("s"), F.col("k").alias("n")), "richest")
    table.put(richest)
    table.add(richest.select("k", "n"), "n")
    return table.read()


@register(
    f"""with {PAIRING('n_chars desc')}
    select doc_id, text, n_chars, social_id from documents left join paired using (doc_id)"""
)
def popularity_load(spark, sf_dir):
    """Documents put into a keyed table, then the paired node added to each."""
    table = _scratch_table(spark, "doc_id", "doc_id long, text string, n_chars long")
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    edges = _table(spark, sf_dir, "lineitem")
    load_popularity(table, documents, edges, "n_chars", "l_partkey")
    return table.read()


@register(
    f"""with {PAIRING('n_chars desc')}
    select doc_id talk_id, text description, 'a ' || source title, '' speaker_1, n_chars views,
        n_chars // 60 duration, '[]' topics, '{{}}' related_talks, 'https://' || lang url, social_id
    from documents left join paired using (doc_id)"""
)
def popularity_load_files(spark, sf_dir):
    """The whole load, from an edge file and a CSV to the stored table."""
    edge_path, csv_path = scratch_path(spark, "edges"), scratch_path(spark, "csv")
    edges = _table(spark, sf_dir, "lineitem").select(F.concat_ws(" ", "l_partkey", "l_suppkey"))
    edges.write.text(edge_path)
    documents = _table(spark, sf_dir, "documents").select(
        F.col("text").alias("description"), F.col("n_chars").alias("views"), F.lit("").alias("speaker_1"),
        F.col("doc_id").alias("talk_id"), F.format_string("a %s", "source").alias("title"),
        F.floor(F.col("n_chars") / 60).alias("duration"), F.lit("[]").alias("topics"),
        F.lit("{}").alias("related_talks"), F.format_string("https://%s", "lang").alias("url"),
    )
    documents.write.option("header", True).option("escape", '"').csv(csv_path)
    table = _scratch_table(spark, "talk_id", DOCUMENT_SCHEMA.simpleString()[len("struct<") : -1])
    load_popularity(table, read_documents(spark, csv_path), read_edges(spark, edge_path))
    return table.read()


@register(
    """select o_orderkey, doc_id, lang from documents join (
        select o_orderkey, case when o_orderkey % 3 = 0 then 7 else o_custkey % 1500 end doc_id
        from orders) using (doc_id)"""
)
def fetch_hot_keys(spark, sf_dir):
    """Documents of orders, a third of which ask for the same one, by the way that
    neither side is small enough to be broadcast."""
    hot = F.when(F.col("o_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("o_custkey") % 1500)
    asked = _table(spark, sf_dir, "orders").select("o_orderkey", hot.cast("long").alias("doc_id"))
    limits = Limits(rows_per_key=100, broadcast_rows=0, broadcast_bytes=0, broadcast_ids=0, filter_keys=0)
    documents = _table(spark, sf_dir, "documents").select("doc_id", "lang")
    found = fetch(materialise(asked, "asked"), documents, "doc_id", "o_orderkey", limits)
    return found.select("o_orderkey", "doc_id", "lang")


# --- nested text columns ----------------------------------------------------------


def _quoted(text: Column) -> Column:
    """``text`` as a quoted literal, the way Python prints it."""
    for raw, escaped in (
        ("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"),
        ("\u00a0", "\\xa0"),
    ):
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return F.concat(F.lit("'"), text, F.lit("'"))


def _with_topics(documents: DataFrame, *columns: str) -> DataFrame:
    items = F.concat_ws(", ", *(_quoted(F.col(c)) for c in columns))
    return documents.withColumn("topics", F.concat(F.lit("["), items, F.lit(",]")))


@register(
    """select doc_id, 0 place, lang topic, false topics_parse_error from documents
    union all select doc_id, 1, source, false from documents
    union all select doc_id, 2, text, false from documents"""
)
def topics_parse(spark, sf_dir):
    documents = _with_topics(_table(spark, sf_dir, "documents"), "lang", "source", "text")
    return normalise(documents, lists=["topics"]).select(
        "doc_id", F.posexplode_outer("topics").alias("place", "topic"), "topics_parse_error"
    )


@register(
    """select doc_id, case when doc_id % 4 = 0 then lang end first_topic,
        doc_id % 4 <> 0 topics_parse_error, doc_id % 4 <> 0 related_parse_error
    from documents"""
)
def broken_parse(spark, sf_dir):
    """Lists and dicts with something behind them, or one within them, are not read."""
    topics = F.concat(F.lit("['"), "lang", F.lit("', 'x'"))
    related = F.concat(F.lit("{"), F.col("doc_id").cast("string"), F.lit(": 'x'"))
    ends = F.array(*(F.lit(end) for end in ("]", "] junk", "], 5", ", ['b']]")))
    dict_ends = F.array(*(F.lit(end) for end in ("}", "} junk", "}}", ", 3: ['b']}")))
    which = (F.col("doc_id") % 4).cast("int")
    documents = _table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(topics, F.get(ends, which)).alias("topics"),
        F.concat(related, F.get(dict_ends, which)).alias("related"),
    )
    return normalise(documents, lists=["topics"], maps=["related"]).select(
        "doc_id", F.get("topics", F.lit(0)).alias("first_topic"), "topics_parse_error", "related_parse_error"
    )


# Keys may repeat (last one wins) and need not be in order; titles hold an apostrophe.
_RELATED_SQL = """
    given as (
        select p_partkey, 0 seq, p_partkey id, p_name title from part
        union all select p_partkey, 1, p_size, p_brand || '''s 12: "' || p_type || '"' from part
        union all select p_partkey, 2, p_partkey % 60, 'seven' from part),
    entries as (
        select p_partkey, id related_id, title related_title,
            cast(row_number() over (partition by p_partkey order by id) - 1 as integer) place
        from (select * from given
              qualify row_number() over (partition by p_partkey, id order by seq desc) = 1))"""


def _with_related(part: DataFrame) -> DataFrame:
    literal = F.format_string(
        "{%d: '%s', %d: '%s\\'s 12: \"%s\"', %d: 'seven'}",
        "p_partkey", "p_name", "p_size", "p_brand", "p_type", F.col("p_partkey") % 60,
    )
    return normalise(part.withColumn("related", literal), maps=["related"])


@register(
    f"with {_RELATED_SQL} select p_partkey, place, related_id, related_title from entries"
)
def related_parse(spark, sf_dir):
    part = _with_related(_table(spark, sf_dir, "part"))
    return related_entries(part.where(~F.col("related_parse_error")), "p_partkey", "related")


@register(
    f"""with {_RELATED_SQL}
    select p_partkey, place, related_id, related_title, lang target_lang, n_chars target_n_chars
    from entries join documents on related_id = doc_id"""
)
def related_expand(spark, sf_dir):
    part = _with_related(_table(spark, sf_dir, "part"))
    targets = _table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("p_partkey"), "lang", "n_chars"
    )
    return expand_related(part, targets, "p_partkey")


@register(
    """select page_id, url,
        regexp_replace(url, 'example[.]', 'embed.example.') embed_url,
        regexp_replace(url, '/', '$1|') first_slash
    from pages"""
)
def host_rewrite(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.select(
        "*",
        replace_first(F.col("url"), "example.", "embed.example.").alias("embed_url"),
        replace_first(F.col("url"), "/", "$1|").alias("first_slash"),
    )


@register(
    """select request_id, doc_id, lang first_topic, doc_id + 1 first_related, 't ' || lang related_title,
        'https://embed.example.com/' || lang url
    from (select o_orderkey request_id, case when o_orderkey % 6 < 4 then o_custkey end doc_id from orders)
    join documents using (doc_id)""",
    "detail_lookup",
)
def _detail_lookup(spark, sf_dir):
    """Ids as text in all forms, and their documents with parsed columns."""
    number = F.col("o_custkey").cast("string")
    forms = F.array(
        F.concat(F.lit(" "), number, F.lit("abc")), F.concat(F.lit("0x"), F.hex("o_custkey"), F.lit("g")),
        F.concat(F.lit("\t+"), number), F.concat(F.lit("\u00a0"), number, F.lit(".5")),
        F.concat(F.lit("0xg"), number), F.concat(F.lit("x"), number),
    )
    requests = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.get(forms, (F.col("o_orderkey") % 6).cast("int")).alias("raw_id"),
    )
    documents = _table(spark, sf_dir, "documents").select(
        "doc_id",
        F.format_string("['%s', 'x']", "lang").alias("topics"),
        F.format_string("{%d: 't %s'}", F.col("doc_id") + 1, "lang").alias("related"),
        F.format_string("https://www.example.com/%s", "lang").alias("url"),
    )
    hosts = {"url": ("www.example.com", "embed.example.com")}
    found = detail_lookup(requests, documents, lists=["topics"], maps=["related"], hosts=hosts)
    return found.select(
        "request_id",
        "doc_id",
        F.get("topics", F.lit(0)).alias("first_topic"),
        F.get(F.map_keys("related"), F.lit(0)).alias("first_related"),
        F.get(F.map_values("related"), F.lit(0)).alias("related_title"),
        "url",
    )


# --- index and search -------------------------------------------------------------


def _index(spark, sf_dir, stem=True):
    return inverted_index(_table(spark, sf_dir, "documents"), stem=stem)


def _keyword_queries(spark, sf_dir):
    """The words of each benchmark text, between single spaces, as a query."""
    return _table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"),
        F.regexp_replace("text", r"[^\p{L}]+", " ").alias("query"),
    )


@register(f"with {WORDS} select doc_id, w keyword from words", "inverted_index")
def _inverted_index(spark, sf_dir):
    return _index(spark, sf_dir, stem=False)


@register(f"with {STEMMED_INDEX} select keyword, doc_id from idx")
def inverted_index_stemmed(spark, sf_dir):
    return _index(spark, sf_dir)


def _search(page: int, compat: bool = False) -> Query:
    def run(spark, sf_dir):
        documents = _table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
        return search(
            _keyword_queries(spark, sf_dir), _index(spark, sf_dir), documents, page, compat=compat
        )

    return run


for _page in range(1, 6):
    register(page_sql(_page), f"search_page_{_page}")(_search(_page))
    if _page > 1:
        register(page_sql(_page, compat=True), f"search_page_{_page}_compat")(
            _search(_page, compat=True)
        )


@register(
    f"""with {WORDS}, idx as (select doc_id, w keyword from words), {QUERIES}, {UNSTEMMED_HITS}
    select query_id, doc_id, rk as "rank", lang from hits join documents using (doc_id)
    where rk between 1 and 15"""
)
def search_unstemmed(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").select("doc_id", "lang")
    found = search(
        _keyword_queries(spark, sf_dir), _index(spark, sf_dir, stem=False), documents, stem=False
    )
    return found.select("query_id", "doc_id", "rank", "lang")


def stored_search(spark: SparkSession, sf_dir: str) -> Query:
    """The search of ``search_stored_index`` over an index that is written now."""
    path = scratch_path(spark, "postings")
    write_index(_index(spark, sf_dir), path)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        documents = _table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
        return search(_keyword_queries(spark, sf_dir), read_heads(spark, path), documents, 2)

    return run


@register(page_sql(2))
def search_stored_index(spark, sf_dir):
    """The index written in keyword order, and searched from its files."""
    return stored_search(spark, sf_dir)(spark, sf_dir)


@register(page_sql(3))
def search_posting_blocks(spark, sf_dir):
    """The index stored in blocks of gaps, and searched from those alone."""
    path = scratch_path(spark, "blocks")
    write_blocks(_index(spark, sf_dir), path)
    documents = _table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return search(_keyword_queries(spark, sf_dir), read_blocks(spark, path), documents, 3)


@register(
    f"""with {STEMMED_INDEX}, {QUERIES}, {HITS}
    select query_id, rk as "rank", doc_id, text description, lang first_topic, source last_topic,
        n_chars + 7 first_related, 'it''s ' || lang related_title,
        'https://embed.example.com/www.example.com' url
    from hits join documents using (doc_id) where rk between 1 and 15"""
)
def search_results(spark, sf_dir):
    """Hits with whole documents, whose text columns are parsed once fetched."""
    documents = _with_topics(_table(spark, sf_dir, "documents"), "lang", "source").select(
        "doc_id",
        "topics",
        F.col("text").alias("description"),
        F.format_string('{%d: "it\'s %s"}', F.col("n_chars") + 7, "lang").alias("related"),
        F.lit("https://www.example.com/www.example.com").alias("url"),
    )
    found = search(_keyword_queries(spark, sf_dir), _index(spark, sf_dir), documents)
    hosts = {"url": ("www.example.com", "embed.example.com")}
    return normalise(found, lists=["topics"], maps=["related"], hosts=hosts).select(
        "query_id",
        "rank",
        "doc_id",
        "description",
        F.get("topics", F.lit(0)).alias("first_topic"),
        F.get("topics", F.lit(1)).alias("last_topic"),
        F.get(F.map_keys("related"), F.lit(0)).alias("first_related"),
        F.get(F.map_values("related"), F.lit(0)).alias("related_title"),
        "url",
    )


@register(
    f"""with {STEMMED_INDEX}, {QUERIES}, {HITS}
    select query_id, 3 page, 31 low, cast(30 + count(rk) as integer) high
    from q left join (select * from hits where rk between 31 and 45) using (query_id)
    group by 1"""
)
def search_labels(spark, sf_dir):
    pages = search_pages(_keyword_queries(spark, sf_dir), _index(spark, sf_dir), 3)
    return pages.drop("hits")


_SHORT_QUERIES = r"""
    q as (select item_id query_id, case item_id % 4 when 0 then '  ' when 1 then 'qqq zzzqqq'
        when 2 then regexp_extract(text, '(\p{L}+)\P{L}*$', 1) || ' zzz'
        else regexp_replace(text, '[^\p{L}]+', ' ', 'g') end query from benchmark)"""


@register(
    f"""with {WORDS}, idx as (select doc_id, w keyword from words), {_SHORT_QUERIES}, {UNSTEMMED_HITS}
    select query_id, 5 page, 61 low, cast(60 + count(rk) as integer) high,
        coalesce(string_agg(cast(doc_id as varchar), ',' order by rk), '') hits
    from q left join (select * from hits where rk between 61 and 75) using (query_id) group by 1"""
)
def search_short_pages(spark, sf_dir):
    """Last pages of queries without words, without hits, with few and with many."""
    text, which = F.col("text"), F.col("item_id") % 4
    few = F.concat(F.regexp_extract(text, r"(\p{L}+)\P{L}*$", 1), F.lit(" zzz"))
    query = F.when(which == 0, "  ").when(which == 1, "qqq zzzqqq").when(which == 2, few)
    queries = _table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"),
        query.otherwise(F.regexp_replace(text, r"[^\p{L}]+", " ")).alias("query"),
    )
    pages = search_pages(queries, _index(spark, sf_dir, stem=False), 5, stem=False)
    return pages.withColumn("hits", F.array_join(F.col("hits").cast("array<string>"), ","))


@register(
    f"""with {WORDS}, idx as (select doc_id, w keyword from words),
    q as (select * from (select item_id query_id, case when item_id % 2 = 0
            then regexp_extract(text, '^([A-Za-z]+ ?[A-Za-z]*)', 1) else text end query from benchmark)
        where regexp_matches(query, '^[A-Za-z ]+$')), {UNSTEMMED_HITS}
    select query_id, cast(count(rk) as integer) high
    from q left join (select * from hits where rk between 1 and 15) using (query_id) group by 1"""
)
def search_only_valid(spark, sf_dir):
    """Of whole texts and of their first words as queries, those of letters and spaces."""
    first = F.regexp_extract("text", "^([A-Za-z]+ ?[A-Za-z]*)", 1)
    queries = _table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"),
        F.when(F.col("item_id") % 2 == 0, first).otherwise(F.col("text")).alias("query"),
    )
    pages = search_pages(queries, _index(spark, sf_dir, stem=False), stem=False, only_valid=True)
    return pages.select("query_id", "high")


@register(
    f"""with {STEMMED_INDEX}, {QUERIES}, {HITS}
    select doc_id, count(*) n from hits
    where rk between 1 and 15 and doc_id not in (select doc_id from labels) group by 1"""
)
def search_missing_documents(spark, sf_dir):
    """Hits whose document a document table lacks, here the labels."""
    pages = search_pages(_keyword_queries(spark, sf_dir), _index(spark, sf_dir), 1)
    hits = materialise(page_hits(pages), "hits")
    return missing(hits, _table(spark, sf_dir, "labels"), "doc_id")


@register(
    r"""select conv_id, turn, regexp_matches(text, '^[A-Za-z ]+$') raw_valid,
        regexp_matches(regexp_replace(text, '[^\p{L}]+', ' ', 'g'), '^[A-Za-z ]+$') words_valid
    from conversations"""
)
def query_validity(spark, sf_dir):
    only_words = F.regexp_replace("text", r"[^\p{L}]+", " ")
    return _table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        valid_query(F.col("text")).alias("raw_valid"),
        valid_query(only_words).alias("words_valid"),
    )


@register(
    f"""with {STEMMED_INDEX.replace('from benchmark', "from (select unnest([lang, source]) as text from documents)")},
    q as (select distinct topic query_id, topic query
        from (select unnest([lang, source]) topic from documents)), {HITS}
    select query_id topic, doc_id, rk as "rank", 1 page, 1 low,
        cast(count(*) over (partition by query_id) as integer) high, lang, n_chars
    from hits join documents using (doc_id) where rk between 1 and 15"""
)
def topic_search(spark, sf_dir):
    documents = _with_topics(_table(spark, sf_dir, "documents"), "lang", "source")
    documents = normalise(documents, lists=["topics"])
    found = search_topics(documents, inverted_index(documents))
    return found.select("topic", "doc_id", "rank", "page", "low", "high", "lang", "n_chars")
