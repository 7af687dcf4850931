"""Language ID and the quality chain: held-out accuracy and odd rows."""

import random
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankdex.llm import language_id, quality, sampling
from rankdex.llm.queries import held_out, op6_language_id, op10_quality_crf

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_held_out_languages(spark, rows):
    found = op6_language_id(spark, SF).join(rows.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == rows.count()
    assert all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert 200 < len(held) < 500
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def test_held_out_quality(spark, rows):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = op10_quality_crf(spark, SF)
    assert found.count() == rows.count()
    held = found.where("held_out").join(labels, "doc_id").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in held)
    assert sum(r.quality == r.predicted for r in held) >= 0.97 * len(held)


def test_held_out_rows_teach_nothing(spark, rows):
    learn = ~held_out(F.col("doc_id"))
    wrong = rows.withColumn("lang", F.when(learn, F.col("lang")).otherwise(F.lit("xx")))
    names, likelihoods = language_id.fit(wrong, learn)
    assert names == ["de", "en", "es", "fr"]
    assert (likelihoods == language_id.fit(rows, learn)[1]).all()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(learn, F.col("quality")).otherwise(1 - F.col("quality")))
    one, two = quality.fit(rows, labels, learn), quality.fit(rows, flipped, learn)
    assert all((np.asarray(x) == np.asarray(y)).all() for x, y in zip(one, two))


ODD = [(1, None), (2, ""), (3, "123 ... 456"), (4, "the"), (4, "the"), (None, "the cat"), (5, "ab " * 100_000), (6, "\n\n"), (7, "é")]


@pytest.fixture(scope="module")
def model():
    likelihoods = np.full((2, language_id.BUCKETS), 1.0)
    for i, word in enumerate((" the and with ", " der und mit ")):
        data = np.frombuffer(word.encode() * 50, np.uint8)
        _, buckets, counts = language_id.trigrams(data, np.array([0, len(data)]))
        likelihoods[i, buckets] += counts * 100
    return ["de2", "en2"][::-1], (likelihoods / likelihoods.sum(axis=1, keepdims=True)).astype(np.float32)


def test_odd_rows_and_mixtures(frame, model):
    mixed = [(10, "the and with " * 40), (11, "der und mit " * 40), (12, "the and with " * 40 + "der und mit " * 20)]
    found = language_id.predict(frame(ODD + mixed), model).collect()
    assert len(found) == len(ODD) + len(mixed)
    by_id = {r.doc_id: r for r in found}
    for i in (1, 2, 3, 6):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].languages) == ("und", 0.0, {})
    assert by_id[4].lang_pred == by_id[None].lang_pred == "en2"
    assert by_id[7].lang_pred != "und" and 0 < by_id[7].score <= 1
    assert set(by_id[10].languages) == {"en2"} and set(by_id[11].languages) == {"de2"}
    assert by_id[12].languages["en2"] == pytest.approx(2 / 3, abs=0.05)
    assert by_id[12].languages["de2"] == pytest.approx(1 / 3, abs=0.05)
    assert language_id.predict(frame([]), model).count() == 0


def test_a_text_in_all_languages(frame):
    words = [" the and with ", " der und mit ", " que los por ", " dans avec est ", " zijn voor niet "]
    likelihoods = np.full((len(words), language_id.BUCKETS), 1.0)
    for i, word in enumerate(words):
        data = np.frombuffer(word.encode() * 50, np.uint8)
        _, buckets, counts = language_id.trigrams(data, np.array([0, len(data)]))
        likelihoods[i, buckets] += counts * 100
    model = list("abcde"), (likelihoods / likelihoods.sum(axis=1, keepdims=True)).astype(np.float32)
    rows = [(n, "".join(word * 40 for word in words[:n])) for n in range(1, 6)]
    rows += [(10, words[0] * 80 + words[1] * 40 + words[3] * 40 + words[4] * 40), (11, "the")]
    found = {r.doc_id: r for r in language_id.predict(frame(rows), model).collect()}
    for n in range(1, 6):
        assert found[n].languages == pytest.approx({name: 1 / n for name in model[0][:n]}, abs=0.03)
        assert found[n].score == max(found[n].languages.values())
    assert found[10].lang_pred == "a"
    assert found[10].languages == pytest.approx({"a": 0.4, "b": 0.2, "d": 0.2, "e": 0.2}, abs=0.03)


def test_sizes_left_out_could_not_be_chosen(monkeypatch):
    rng = np.random.default_rng(4)
    likelihoods = rng.dirichlet(np.full(300, 0.3), 6).astype(np.float32) + np.float32(1e-6)
    rows, buckets, counts = [], [], []
    for row in range(80):
        shares = rng.dirichlet(np.full(6, rng.choice([0.1, 1.0])))
        drawn = np.bincount(rng.choice(300, rng.integers(1, 900), p=(p := shares @ likelihoods) / p.sum()), minlength=300)
        at = np.flatnonzero(drawn)
        rows, buckets, counts = [*rows, *[row] * len(at)], [*buckets, *at], [*counts, *drawn[at]]
    given = np.array(rows), np.array(buckets), np.array(counts), likelihoods
    ids, found = language_id.mixtures(*given)
    monkeypatch.setattr(language_id, "_ceiling", lambda *args: np.full(len(args[-1]), np.inf))
    every = language_id.mixtures(*given)[1]
    assert ids.tolist() == list(range(80)) and np.array_equal(found, every)
    assert {1, 2, 3, 4, 5} <= set((found > 0).sum(axis=1).tolist())


def test_without_labelled_languages(frame, spark):
    df = frame([(1, "the", None), (2, "cat", None)], "doc_id long, text string, lang string")
    model = language_id.fit(df, F.lit(True))
    assert model[0] == []
    assert {tuple(r[:3]) for r in language_id.predict(df, model).collect()} == {(1, "und", 0.0), (2, "und", 0.0)}


def test_trigrams_stay_within_rows():
    texts = ["abc", "ab", "", "cab cab", None]
    data, offsets = language_id.tokens.raw(pa.array(texts))
    rows, _, counts = language_id.trigrams(data, offsets)
    per_row = np.bincount(rows, weights=counts, minlength=5)
    assert per_row.tolist() == [1, 0, 0, 5, 0]


def test_sample_is_bounded_and_repeatable(spark):
    df = spark.range(5_000).select(F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    one = sampling.sample_per_label(df, "k", "y", 100).collect()
    two = sampling.sample_per_label(df.repartition(17).unionAll(df), "k", "y", 100).collect()
    assert sorted(one) == sorted(two)
    assert sorted(r.y for r in one) == [0] * 100 + [1] * 100
    with pytest.raises(ValueError, match="labels"):
        sampling.sample_per_label(spark.range(2_000).selectExpr("id k", "id y"), "k", "y", 1)
    assert sampling.sample_per_label(df.where("k < 0"), "k", "y", 5).count() == 0


def all_sequences(good, changes):
    """Marginals and expected changes by summing over all labellings."""
    n = len(good)
    total, marginal, expected = 0.0, np.zeros((n, 2)), np.zeros((2, 2))
    for labels in product((0, 1), repeat=n):
        weight = np.exp(sum(g for g, y in zip(good, labels) if y) + sum(changes[a, b] for a, b in zip(labels, labels[1:])))
        total += weight
        for t, y in enumerate(labels):
            marginal[t, y] += weight
        for a, b in zip(labels, labels[1:]):
            expected[a, b] += weight
    return marginal / total, expected / total


def test_forward_backward_against_all_labellings():
    rng = np.random.default_rng(2)
    bounds = np.cumsum([0, 3, 1, 6, 2, 5])
    good, changes = rng.normal(size=bounds[-1]) * 2, rng.normal(size=(2, 2))
    found, expected = quality.marginals(good, changes, bounds)
    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
        marginal, change = all_sequences(good[a:b], changes)
        assert np.allclose(found[a:b], marginal)
        assert np.allclose(expected[i], change)


def test_lines_of_rows():
    texts = ["one two\nthree.", None, "", "\n", "tail\n", "x", "a a a b"]
    data, offsets = quality.tokens.raw(pa.array(texts))
    features, size, bounds = quality.lines(data, offsets)
    assert np.diff(bounds).tolist() == [2, 1, 1, 1, 1, 1, 1]
    assert size.tolist() == [7, 6, 0, 0, 0, 4, 1, 7]
    column = {name: features[:, i] for i, name in enumerate(quality.FEATURES)}
    assert column["ends_sentence"].tolist() == [0, 1, 0, 0, 0, 0, 0, 0]
    assert column["empty"].tolist() == [0, 0, 1, 1, 1, 0, 0, 0]
    assert column["repeats"][-1] == pytest.approx(0.5)
    assert np.expm1(column["words"]).round().tolist() == [2, 1, 0, 0, 0, 1, 1, 4]


def test_rows_are_scored_alike_alone_and_together(frame):
    rng = random.Random(5)
    texts = ["\n".join("x" * rng.randrange(9) + "##" * rng.randrange(3) for _ in range(rng.randrange(1, 7))) for _ in range(40)]
    data, offsets = quality.tokens.raw(pa.array(texts))
    features, size, bounds = quality.lines(data, offsets)
    labels = np.array([int("#" not in t) for t in texts])
    model = quality.train(features, bounds, labels, rounds=40)
    together, _ = quality.qualities(model, features, size, bounds)
    for i, text in enumerate(texts):
        own = quality.lines(*quality.tokens.raw(pa.array([text])))
        assert quality.qualities(model, *own)[0][0] == pytest.approx(together[i])
    found = quality.score(frame(ODD), model).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].score == by_id[2].score and len(by_id[1].line_scores) == 1
    assert quality.score(frame([]), model).count() == 0
    good = quality.good_documents(frame(ODD), model)
    assert good.columns == frame(ODD).columns
    assert good.count() == sum(r.score >= 0.5 for r in found)


def test_labels_of_one_class_or_none(frame, spark):
    df = frame([(1, "a"), (2, "b"), (3, None)])
    labels = spark.createDataFrame([(1, 1), (2, 1), (9, 0), (3, None)], "doc_id long, quality int")
    assert quality.fit(df, labels, F.lit(True)) == 1.0
    assert quality.fit(df, labels.limit(0), F.lit(True)) == 0.5
    assert {r.score for r in quality.score(df, 0.5).collect()} == {0.5}
