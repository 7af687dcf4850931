"""Every operator and every stage of the pipeline on tables that hold what none should."""

import pytest
from pyspark.sql import functions as F, types as T

import corpus_pipeline
from rankdex.llm import (
    bpe,
    decontamination,
    language_id,
    line_spread,
    near_duplicates,
    order_minhash,
    quality,
    suffix_dedup,
    url_filter,
    warc,
)
from rankdex.llm.queries import QUERIES, word_vocabulary

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, or for what they return.
CLASHING = (
    "_gone", "_doc", "_row", "_key", "_q", "_n", "_lines", "_hits", "_first", "_class", "_label", "_at",
    "_place", "_site", "_line", "_h1", "_ix", "_next", "id", "n", "k", "t", "a", "b", "row", "row_", "key", "key_",
    "item", "window", "words", "shingles", "node", "path", "verdict", "score", "label", "ranges", "text_id",
    "edited", "fingerprint", "payload", "digest", "decoded", "token_ids", "n_lines", "dotted.name",
)


def with_clashes(df):
    return df.select("*", *(F.lit(f"extra {c}").alias(c) for c in CLASHING if c not in df.columns))


@pytest.fixture(scope="module")
def rows(prose):
    long, passage = prose(30_000, 1), prose(60, 2)
    return [
        (1, prose(80, 3), "en", "a", 1), (1, prose(80, 3), "en", "a", 1), (1, prose(50, 4), "en", "a", 1),
        (2, prose(80, 3), None, None, None), (3, None, "en", "a", None), (4, "", "en", "a", 0),
        (None, prose(40, 5), "en", "b", 3), (None, prose(40, 5), "en", "b", 3), (None, None, None, None, None),
        (5, long, "en", "c", 9), (6, long + " end", "en", "c", 9), (7, " \n\t ", "en", "c", 4),
        (8, passage, "en", "d", 5), (9, f"{prose(30, 6)}\n{passage}\n{prose(30, 7)}", "en", "d", 5),
        (-1, "x" * 200_000, "", "", 5), (2**62, "\n" * 5_000, "en", "e", 5), (10, "\x00   𝒳 é", "en", "e", 5),
    ] + [(20 + i, f"shared by all sites\n{prose(20, 20 + i)}", "en", f"site {i}", 7) for i in range(15)]


@pytest.fixture(scope="module")
def folder(spark, rows, prose, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd"))
    pages = [(1, "https://a.com/", "x"), (1, "https://a.com/", "x"), (2, None, None), (None, "", ""), (3, "://", "x" * 99_999)]
    tables = {
        "documents": (rows, DOCUMENTS),
        "labels": ([(1, 1, 0), (1, 0, 0), (None, 1, None), (5, None, None), (20, 0, 0), (99, 1, 1), (23, 1, 0)],
                   "doc_id long, quality int, toxic int"),
        "benchmark": ([(1, prose(60, 2)), (1, prose(60, 2)), (2, None), (3, ""), (None, prose(30, 6)), (4, "two words")],
                      "item_id long, text string"),
        "pages": (pages, "page_id long, url string, html string"),
    }
    for name, (content, schema) in tables.items():
        with_clashes(spark.createDataFrame(content, schema)).write.parquet(f"{path}/odd/{name}.parquet")
        spark.createDataFrame([], schema).write.parquet(f"{path}/none/{name}.parquet")
    return path


@pytest.mark.parametrize("name", QUERIES)
def test_queries_on_odd_tables(spark, folder, name):
    table = "pages" if name.startswith(("op1_", "op2_")) else "documents"
    found = QUERIES[name](spark, f"{folder}/odd").collect()
    if not name.startswith("op9_"):
        assert len(found) == spark.read.parquet(f"{folder}/odd/{table}.parquet").count()


@pytest.mark.parametrize("name", QUERIES)
def test_queries_on_empty_tables(spark, folder, name):
    full = QUERIES[name](spark, f"{folder}/odd").schema
    none = QUERIES[name](spark, f"{folder}/none")
    assert none.collect() == []
    assert [(f.name, f.dataType) for f in none.schema] == [(f.name, f.dataType) for f in full]


@pytest.mark.parametrize("tables", ["odd", "none"])
def test_stages(spark, folder, tables):
    documents = spark.read.parquet(f"{folder}/{tables}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, documents, f"{folder}/{tables}")
        found = out.collect()
        if name != "tokens":
            assert out.schema.simpleString() == documents.schema.simpleString(), name
        assert (tables == "odd") == bool(found), name


def extra_columns(rows):
    return {tuple(r[c] for c in CLASHING) for r in rows}


def test_extra_columns_stay_what_they_are(spark, folder):
    documents = spark.read.parquet(f"{folder}/odd/documents.parquet")
    benchmark = spark.read.parquet(f"{folder}/odd/benchmark.parquet")
    expected = {tuple(f"extra {c}" for c in CLASHING)}
    assert extra_columns(line_spread.dedup_lines(documents).collect()) == expected
    assert extra_columns(near_duplicates.one_of_each(documents).collect()) == expected
    assert extra_columns(decontamination.without_contaminated(documents, benchmark).collect()) == expected
    assert extra_columns(quality.good_documents(documents, 0.5).collect()) == expected
