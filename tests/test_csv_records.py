"""Split CSV against Spark's reader of whole files."""

import random

import pytest
from pyspark.sql import functions as F

from rankdex.sources.csv_records import TASKS_PER_CORE, _lines, csv_records, line_state, read_csv, tasks
from rankdex.sources.documents import read_documents

SF = "/root/testdata/sf0.001"
DOUBLED = (
    'id,text,"na\nme",last\n'
    '1,"two\nlines",x,y\n'
    '\n'
    '2,"say ""hi""\n"" and\n\n""",5" disk,"a ""b"""\n'
    '3,plain "inner" quotes,,"""\n"\n'
    '4,"","",","\n'
    '\n\n'
    '5,"x"tail "more,b"",""\n'
    '6,"comma, and\n""line"", 7,8,9\n10,11,12,13\n",é𝒳,"," \n'
    '7,"ends" ,\' , \n'
    '8,"last\n",a\tb,"\n\n\n"'
)
BACKSLASH = (
    'id,text,name,last\n'
    '1,"back\\"slash\n\\"more\\"",x,"\\\\"\n'
    '2,"a\\n\n,b","\\\n",z\n'
    '3,\\"x,"y\\\\\\"\n",""\n'
    '4,"two\n\n",p"q,"r"\n'
)


@pytest.fixture
def splits(spark):
    """Sets the size of splits."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = {n: spark.conf.get(n) for n in names}

    def set_size(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], 0)

    yield set_size
    for name, value in old.items():
        spark.conf.set(name, value)


def whole(spark, path, escape):
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", escape)
    return reader.option("mode", "FAILFAST").csv(str(path))


def same(spark, path, escape='"'):
    got, expected = read_csv(spark, str(path), escape), whole(spark, path, escape)
    assert got.columns == expected.columns
    found = sorted(map(tuple, got.collect()), key=repr)
    assert found == sorted(map(tuple, expected.collect()), key=repr)
    return found


@pytest.mark.parametrize("size", [1, 3, 16, 64, 1000])
def test_every_split_size(spark, tmp_path, splits, size):
    splits(size)
    path = tmp_path / "d.csv"
    path.write_bytes(DOUBLED.encode())
    assert len(same(spark, path)) == 8


@pytest.mark.parametrize("size", [2, 40])
@pytest.mark.parametrize("mark", ["", "﻿"])
def test_carriage_returns_and_mark(spark, tmp_path, splits, size, mark):
    splits(size)
    path = tmp_path / "d.csv"
    text = "\n".join(line for line in DOUBLED.split("\n") if '"na' not in line and line != 'me",last')
    path.write_bytes((mark + "id,text,name,last\n" + text + "\n").replace("\n", "\r\n").encode())
    assert len(same(spark, path)) == 8


@pytest.mark.parametrize("size", [2, 8, 1000])
def test_backslash_quotes(spark, tmp_path, splits, size):
    splits(size)
    path = tmp_path / "d.csv"
    path.write_bytes(BACKSLASH.encode())
    assert len(same(spark, path, "\\")) == 4


def random_csv(rng, records):
    field = lambda: rng.choice(
        ["", "a", "bc d", '"q"', '"x\ny"', '"\n"', '""', '"a""b"', '"""\n"""', 'p"q', '","', '"é\n\n,"', "'", '"1\n2\n3"']
    )
    return "a,b,c\n" + "".join(f"{field()},{field()},{i}\n" + "\n" * (rng.random() < 0.1) for i in range(records))


@pytest.mark.parametrize("seed", range(4))
def test_random_files(spark, tmp_path, splits, seed):
    rng = random.Random(seed)
    splits(rng.choice([5, 17, 50, 200]))
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text(random_csv(rng, rng.choice([0, 1, 40, 120])))
    same(spark, tmp_path)


def test_a_field_over_many_ranges(spark, tmp_path, splits):
    splits(50)
    path = tmp_path / "d.csv"
    path.write_text('a,b\n1,"' + "line\n" * 400 + '"\n2,x\n')
    assert same(spark, path) == [("1", "line\n" * 400), ("2", "x")]


def test_one_file_is_read_by_many_tasks(spark, tmp_path, splits):
    splits(2000)
    path = tmp_path / "d.csv"
    path.write_text("a,b\n" + "".join(f'{i},"some\ntext"\n' for i in range(2000)))
    records = csv_records(spark, str(path))
    tasks = records.where(~F.col("header")).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) == 2000
    assert len(tasks) > 10 and max(r["count"] for r in tasks) < 300


def test_empty_and_headless_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("a,b\n")
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text("\n\nA,b\n3,4")
    assert sorted(map(tuple, read_csv(spark, str(tmp_path)).collect())) == [("1", "2"), ("3", "4")]


def test_another_header_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="another header"):
        read_csv(spark, str(tmp_path)).collect()


def test_names_that_repeat_or_lack(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text("a,,a,b\n1,2,3,4\n")
    assert same(spark, path) == [("1", "2", "3", "4")]


def test_carriage_returns_alone_fail(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_bytes(b"a,b\r1,2\r")
    with pytest.raises(Exception, match="carriage returns alone"):
        read_csv(spark, str(path)).collect()


def test_splits_that_change_fail(spark, tmp_path, splits):
    splits(1000)
    path = tmp_path / "d.csv"
    path.write_text("a,b\n" + '1,"x\ny"\n' * 500)
    df = read_csv(spark, str(path))
    assert df.count() == 500
    splits(700)
    with pytest.raises(Exception, match="size of their splits changed"):
        df.count()


@pytest.mark.parametrize(
    "line, escape, from_record, from_quoted",
    [
        ("", '"', False, True), ("a,b", '"', False, True), ('"', '"', True, False), ('a,"b', '"', True, False),
        ('a"b', '"', False, False), ('""', '"', False, True), ('x"",', '"', False, True), ('a","b', '"', True, True),
        ('a", "b', '"', False, False), ('a"x,"', '"', True, True), ('"a" "b', '"', False, False),
        ('\\"', "\\", False, True), ('"\\"', "\\", True, False), ('\\\\"', "\\", False, False), ('a\\', "\\", False, True),
    ],
)
def test_state_after_a_line(line, escape, from_record, from_quoted):
    ends_quoted = line_state(escape)
    assert (ends_quoted(line, False), ends_quoted(line, True)) == (from_record, from_quoted)


def test_whole_documents_in_small_splits(spark, table, tmp_path, splits):
    documents = table("documents").select(
        F.col("doc_id").alias("talk_id"), F.col("text").alias("description"), F.col("n_chars").alias("views"),
        F.col("n_chars").alias("duration"), *(F.lit('"\n,').alias(c) for c in ("title", "speaker_1", "topics", "related_talks", "url")),
    )
    documents.coalesce(1).write.option("header", True).option("escape", '"').csv(f"{tmp_path}/d")
    splits(20_000)
    found = read_documents(spark, f"{tmp_path}/d")
    both = found.select("talk_id", "description", "title").exceptAll(
        documents.select("talk_id", F.coalesce("description", F.lit("")), "title")
    )
    assert found.count() == documents.count() and both.isEmpty()


def test_small_ranges_share_tasks(spark, tmp_path, splits):
    """Every range used to be a task of its own in three scans, however small it was."""
    splits(500)
    path = tmp_path / "d.csv"
    path.write_text("a,b\n" + "".join(f'{i},"some\n{"long " * (i % 300)}text"\n' for i in range(400)))
    assert path.stat().st_size > 250_000  # 500 ranges
    fewest = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert _lines(spark, str(path)).rdd.getNumPartitions() == fewest
    assert len(same(spark, path)) == 400


def test_tasks_grow_with_the_input(spark, splits):
    splits(1 << 20)
    fewest = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert [tasks(spark, n) for n in (0, 1, fewest, fewest + 1, 16_000)] == [0, 1, fewest, fewest, 1000]
    splits(128 << 20)
    assert tasks(spark, 16_000) == 16_000
