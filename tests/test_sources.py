import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rankdex.operators.ranking import follower_count, rank_nodes
from rankdex.sources.documents import DOCUMENT_SCHEMA, read_documents
from rankdex.sources.edges import read_edges
from rankdex.sources.rows import local_rows

HEADER = "url,views,speaker_1,event,description,talk_id,duration,title,topics,related_talks"


def rows(df):
    return [tuple(r) for r in df.collect()]


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_edges_and_followers(spark, tmp_path):
    edges = read_edges(spark, write(tmp_path / "e.txt", "1 2\n1 3\n1 3\n2 1\n4 4\n5 1 extra\n"))
    assert edges.count() == 6
    assert sorted(rows(follower_count(edges))) == [(1, 3), (2, 1), (4, 1), (5, 1)]
    ranked = rank_nodes(follower_count(edges)).orderBy("ix").select("node_id", "ix")
    assert rows(ranked) == [(1, 0), (2, 1), (4, 2), (5, 3)]


@pytest.mark.parametrize("line", ["x 1", "7", "", "1  2", "1 2x", "1\t2", "1 2\t", "9223372036854775808 1"])
def test_bad_edge_line(spark, tmp_path, line):
    path = write(tmp_path / "e.txt", f"1 2\n{line}\n3 4\n")
    with pytest.raises(Exception, match="not an edge"):
        read_edges(spark, path).count()
    assert sorted(rows(read_edges(spark, path, mode="drop"))) == [(1, 2), (3, 4)]


def test_ids_beyond_32_bits(spark, tmp_path):
    path = write(tmp_path / "e.txt", "5000000000 -7\n9223372036854775807 +000000000000000000012 3\n")
    assert rows(read_edges(spark, path)) == [(5_000_000_000, -7), (2**63 - 1, 12)]


def test_csv_by_header_name(spark, tmp_path):
    path = write(
        tmp_path / "d.csv",
        f'{HEADER}\nu,10,"A, B",x,"He said ""go""\nand left",3,60,,"[\'a\']",{{}}\n',
    )
    df = read_documents(spark, path)
    assert df.columns == DOCUMENT_SCHEMA.names
    assert rows(df) == [(3, 'He said "go"\nand left', "", "A, B", 10, 60, "['a']", "{}", "u")]


def test_csv_backslash_quotes(spark, tmp_path):
    path = write(tmp_path / "d.csv", f'{HEADER}\nu,10,s,x,"back\\"slash",3,60,t,[],{{}}\n')
    assert read_documents(spark, path, escape="\\").first()["description"] == 'back"slash'


def test_csv_missing_column(spark, tmp_path):
    path = write(tmp_path / "d.csv", f"{HEADER.replace('views,', '')}\nu,s,x,d,3,60,t,[],{{}}\n")
    with pytest.raises(AnalysisException):
        read_documents(spark, path)


def test_csv_text_in_integer_column(spark, tmp_path):
    path = write(tmp_path / "d.csv", f"{HEADER}\nu,many,s,x,d,3,60,t,[],{{}}\n")
    with pytest.raises(Exception, match="not an integer: many"):
        read_documents(spark, path).collect()
    kept = read_documents(spark, path, mode="PERMISSIVE").first()
    assert kept["views"] is None and kept["talk_id"] == 3


def test_csv_bad_integer_fails_unused(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(",".join(f.name for f in DOCUMENT_SCHEMA) + "\n1,d,t,s,many,3,[],{},u\n")
    for use in (lambda df: df.count(), lambda df: df.select("talk_id").collect()):
        with pytest.raises(Exception, match="not an integer"):
            use(read_documents(spark, str(path)))


def test_csv_broken_record(spark, tmp_path):
    path = write(tmp_path / "d.csv", f"{HEADER}\nu,1,s,x,d,3,60,t,[],{{}}\nu,2,s,x,d,4,60,t\n")
    with pytest.raises(Exception):
        read_documents(spark, path).collect()
    broken = read_documents(spark, path, mode="PERMISSIVE").where(
        F.col("_corrupt_record").isNotNull()
    )
    assert [r["talk_id"] for r in broken.collect()] == [4]


def test_local_rows(spark):
    df = local_rows(
        spark, [("1", "string1"), ("2", "string2")], "left string not null, right string not null"
    )
    assert df.count() == 2
    assert not df.schema["left"].nullable
