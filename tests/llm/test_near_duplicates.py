import random
import re
from itertools import combinations

import numpy as np
import pytest

from rankdex.llm import near_duplicates as near, tokens
from rankdex.llm.components import components
from rankdex.llm.queries import op3_near_duplicates

SF = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    k = min(k, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute_force(rows, k, percent=80):
    """``{id: (sizes, component)}`` of rows with ids, by comparing all pairs."""
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, a), (j, b) in combinations(sets, 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            low, high = sorted((root(i), root(j)))
            parent[high] = low
    return {i: root(i) for i, _ in sets}


def check(df, rows, k, percent=80):
    expected = brute_force(rows, k, percent)
    found = near.near_duplicates(df, words=k, percent=percent).collect()
    assert len(found) == len(rows)
    sizes = {}
    for i, text in rows:
        sizes.setdefault(i, set()).add(len(shingles(text, k)))
    for row in found:
        assert row.n_shingles in sizes[row.doc_id]
        if row.doc_id is None:
            assert row.component_id is None and row.kept
        else:
            assert (row.doc_id, row.component_id) == (row.doc_id, expected[row.doc_id])
            assert row.kept == (row.doc_id == row.component_id)


def edited(text, n, seed):
    rng, words = random.Random(seed), text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def test_whole_table(spark, table):
    rows = [tuple(r) for r in table("documents").select("doc_id", "text").collect()]
    expected = brute_force(rows, 2)
    found = {r.doc_id: r for r in op3_near_duplicates(spark, SF).collect()}
    assert {i: r.component_id for i, r in found.items()} == expected
    assert all(r.n_shingles == len(shingles(t, 2)) for i, t in rows for r in [found[i]])


@pytest.mark.parametrize("k", [1, 2, 5])
def test_groups_chains_and_odd_rows(frame, prose, k):
    base, other = prose(60, 1), prose(300, 2)
    rows = [(100 + i, edited(base, i % 4, i)) for i in range(30)]
    chain = other
    for i in range(12):  # neighbours are near, the ends are far from each other
        rows.append((300 - i, chain))
        chain = edited(chain, 5, 1000 + i)
    rows += [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE\ttwo"), (8, "two one")]
    rows += [(9, base.upper()), (10, prose(40_000, 3)), (10, prose(40_000, 3)), (None, base), (None, None)]
    rows += [(400 + i, prose(50, 10 + i)) for i in range(40)]
    check(frame(rows), rows, k)


def test_nodes_that_do_not_shrink(frame, prose, monkeypatch):
    """Tiny nodes and blocks: every path through large nodes is taken."""
    monkeypatch.setattr(near, "SMALL_NODE", 4)
    monkeypatch.setattr(near, "BLOCK_ROWS", 7)
    a, b = prose(80, 1), prose(80, 2)
    rows = [(i, edited(a, i % 6, i)) for i in range(60)] + [(100 + i, edited(b, i % 9, i)) for i in range(60)]
    passage = prose(25, 5)
    rows += [(200 + i, passage + " " + prose(60, 50 + i)) for i in range(60)]
    check(frame(rows), rows, 2)


def test_ids_that_are_not_broadcast(frame, prose, monkeypatch):
    monkeypatch.setattr(near, "BROADCAST_IDS", 0)
    monkeypatch.setattr(near, "SMALL_NODE", 4)
    a = prose(80, 1)
    rows = [(i, edited(a, i % 6, i)) for i in range(40)] + [(100 + i, prose(40, i)) for i in range(20)]
    check(frame(rows), rows, 2)


def test_empty_table(frame):
    assert near.near_duplicates(frame([])).count() == 0


def test_pairs_at_the_threshold_are_found(frame, prose):
    """Recall at similarities just above 0.8."""
    rows, links = [], 0
    for i in range(250):
        text = prose(120, 5000 + i, vocabulary=5000)
        near_one = edited(text, 6, i)
        a, b = shingles(text, 2), shingles(near_one, 2)
        if 0.8 <= len(a & b) / len(a | b) <= 0.86:
            links += 1
            rows += [(2 * i, text), (2 * i + 1, near_one)]
    found = near.near_duplicates(frame(rows), words=2).where("not kept").count()
    assert links > 50 and found == links


def test_words_are_cut_alike_in_blocks_of_any_size(monkeypatch):
    import pyarrow as pa

    texts = ["Alpha beta", None, "", "gamma" * 30 + " delta  epsilon\n", "é ß\tx", "tail"]
    data, offsets = tokens.raw(pa.array(texts))
    whole, at = tokens.words(data, offsets)
    monkeypatch.setattr(tokens, "BLOCK", 16)
    small, at_small = tokens.words(data, offsets)
    assert (whole == small).all() and (at == at_small).all()
    assert np.diff(at).tolist() == [2, 0, 0, 3, 3, 1]
    assert len(set(whole.tolist())) == 9


def test_components(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    rest = [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)]
    links = chain + star + rest + [(7, 7), (500, 500)] + chain[:3]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.id: r.component for r in found} == {x: root(x) for x in parent}
    assert len(found) == len(parent)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
