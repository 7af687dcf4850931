import hashlib
import random

import pytest
import regex
from hypothesis import given, settings, strategies as st

from rankdex.llm import fill_middle


def expected(key, text):
    """The transformation as its contract says it, one code point after the other."""
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    text = text or ""
    points = list(text)
    n = len(points)
    if n == 0 or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return n, "plain", None, None, text
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(points[a:b]) for a, b in ((0, one), (one, two), (two, n)))
    if h4 % 100 < 20:
        return n, "spm", one, two - one, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", one, two - one, f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(spark, frame, rows):
    out = fill_middle.fill_in_middle(frame(rows))
    got = out.withColumn("back", fill_middle.restored()).collect()
    columns = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "back")
    found = sorted((tuple(r[c] for c in columns) for r in got), key=repr)
    assert found == sorted(((k, *expected(k, t), t or "") for k, t in rows), key=repr)
    return got


ODD = ["", None, "a", "\n", "\r\n\x00 ", "𝒳é🙂👍🏽", "<P> in", "<", "<<P", "M>", "<S><M>", "<p>", "é" * 40]


def test_odd_texts_nulls_and_repeats(spark, frame):
    rows = [(i, t) for i in range(60) for t in (ODD[i % len(ODD)],)]
    got = check(spark, frame, [*rows, *rows[:9], (None, "no key"), (None, None), (-5, "negative"), (2**62, "large")])
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_long_texts_in_blocks(spark, frame, monkeypatch):
    rng = random.Random(3)
    long = "".join(rng.choice("aé\n𝒳 <PSM>") for _ in range(3 * fill_middle.BLOCK_UNITS + 17)).replace(">", "")
    exact = "x" * (2 * fill_middle.BLOCK_UNITS)
    got = check(spark, frame, [(i, t) for i in range(6) for t in (long, exact, exact + "y", exact[1:])])
    assert max(r.prefix_chars or 0 for r in got) > fill_middle.BLOCK_UNITS


def test_no_rows(spark, frame):
    assert fill_middle.fill_in_middle(frame([(1, "a")]).limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60), st.integers(1, 9), st.sampled_from([".", r"\X", r"\w+|\W", r"\S+\s?|\s"]))
def test_blocks_give_the_ends_of_one_match(text, size, unit):
    whole = regex.compile(f"({unit})*+", regex.DOTALL)
    match = whole.fullmatch(text)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(fill_middle, "BLOCK_UNITS", size)
        units = fill_middle.Units(text, whole, regex.compile(f"({unit}){{0,{size}}}+", regex.DOTALL))
        assert units.n == len(match.ends(1))
        assert [units.end(i) for i in range(units.n + 1)] == [0, *match.ends(1)]


def test_units_of_words(spark, frame):
    text = " ".join(f"word{i}" for i in range(500))
    out = fill_middle.fill_in_middle(frame([(i, text) for i in range(40)]), unit=r"\S+\s*")
    rows = out.withColumn("back", fill_middle.restored()).collect()
    assert {r.n for r in rows} == {500} and {r.back for r in rows} == {text}
    assert all(r.form == "plain" or text[: r.prefix_chars].endswith(" ") or r.prefix_chars in (0, len(text)) for r in rows)


def test_units_that_leave_a_gap(monkeypatch):
    whole, block = regex.compile("(a)*+"), regex.compile("(a){0,2}+")
    for size in (1, 100):
        monkeypatch.setattr(fill_middle, "BLOCK_UNITS", size)
        with pytest.raises(ValueError):
            fill_middle.Units("aabaa", whole, block)
