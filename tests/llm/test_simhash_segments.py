import random

import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rankdex.llm import simhash_segments as segments
from rankdex.llm.queries import op11_simhash_segments

SF = "/root/testdata/sf0.001"


def fingerprint(text, words=3):
    """One bit after the other, from the contract."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        lower = lower.replace(space, " ")
    found = [w for w in lower.split(" ") if w]
    runs = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    """The smallest reachable of a set of numbers for each, all pairs compared."""
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    every = sorted(prints)
    for i, a in enumerate(every):
        for b in every[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {p: root(p) for p in every}


def expected(rows):
    prints = [(k, fingerprint(t)) for k, t in rows]
    component = classes({p for _, p in prints})
    least = {}
    for k, p in prints:
        if k is not None:
            least[component[p]] = min(k, least.get(component[p], k))
    return sorted(((k, f"{p:016x}", least.get(component[p])) for k, p in prints), key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=repr)


def found(spark, numbers):
    signed = [(n - 2**64 if n >= 2**63 else n,) for n in sorted(numbers)]
    rows = segments.linked(spark.createDataFrame(signed, "fingerprint long").repartition(3)).collect()
    component = {r.id % 2**64: r.component % 2**64 for r in rows}
    groups = {}
    for n in numbers:
        groups.setdefault(component.get(n, n), set()).add(n)
    return sorted(map(sorted, groups.values()))


def expected_groups(numbers):
    groups = {}
    for n, c in classes(numbers).items():
        groups.setdefault(c, set()).add(n)
    return sorted(map(sorted, groups.values()))


def test_whole_table(spark, table):
    rows = [(r.doc_id, r.text) for r in table("documents").collect()]
    assert rows_of(op11_simhash_segments(spark, SF)) == expected(rows)


def test_odd_texts_nulls_and_repeats(spark, frame, prose, monkeypatch):
    monkeypatch.setattr(segments, "BLOCK_BYTES", 100)
    base = prose(300, 1)
    rows = [(10 + i, f"{base} extra{i}") for i in range(8)] + [(30, base), (30, base), (30, prose(50, 2)), (9, base.upper())]
    rows += [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "one two"), (6, "ONE\ttwo"), (None, base), (None, prose(40, 8))]
    rows += [(None, None), (-3, "x" * 5000), (2**62, "é 𝒳 \x00 a\x85b")]
    out = segments.near_duplicates(frame(rows)).withColumn("fingerprint", segments.as_text(F.col("fingerprint")))
    assert rows_of(out) == expected(rows)


def test_no_rows(spark, frame):
    assert segments.near_duplicates(frame([(1, "a")]).limit(0)).collect() == []


def around(rng, centre, flips):
    for bit in rng.sample(range(64), flips):
        centre ^= 1 << bit
    return centre


@pytest.mark.parametrize("dense, block", [(64, 4096), (3, 4096), (1, 20)])
def test_every_link_is_found(spark, monkeypatch, dense, block):
    """Chains, groups around a centre, and numbers within exactly 3 and 4 bits, with cells
    taken apart from different sizes on."""
    monkeypatch.setattr(segments, "DENSE", dense)
    monkeypatch.setattr(segments, "BLOCK_ROWS", block)
    rng = random.Random(dense)
    numbers = {0, 1, 7, 15, 2**64 - 1, 2**63, 0x5555555555555555, 0xAAAAAAAAAAAAAAAA}
    for _ in range(40):
        one = rng.getrandbits(64)
        numbers |= {one, around(rng, one, 3), around(rng, one, 4), around(rng, one, 2)}
    link = rng.getrandbits(64)
    for _ in range(40):
        numbers.add(link := around(rng, link, 3))
    for spread in (2, 4, 6):
        centre = rng.getrandbits(64)
        numbers |= {around(rng, centre, rng.randint(0, spread)) for _ in range(150)}
    assert found(spark, numbers) == expected_groups(numbers)


def test_a_dense_cell_sends_few_links(spark):
    """Links within a large group grow with its size, not with its square."""
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    numbers = sorted({around(rng, centre, rng.randint(0, 5)) for _ in range(3000)})
    signed = [(n - 2**64 if n >= 2**63 else n,) for n in numbers]
    prints = spark.createDataFrame(signed, "fingerprint long")
    members = prints.select("fingerprint", F.explode(F.array(*segments._cells(F.col("fingerprint")))).alias("cell"))
    dense = members.groupBy("cell").count().where(F.col("count") > segments.DENSE).select("cell")
    groups = segments._dense_members(members, dense)
    links = segments._grid_links(members, dense, True).unionAll(segments._leader_links(members, dense, groups))
    assert links.count() < 40 * len(numbers)
    assert found(spark, set(numbers)) == expected_groups(set(numbers))


@settings(max_examples=200, deadline=None)
@given(st.text("abAB \n\té𝒳", max_size=200), st.integers(1, 4), st.integers(1, 30))
def test_fingerprints_in_blocks(text, words, size):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(segments, "BLOCK_BYTES", size)
        assert segments.simhash(memoryview(text.encode()), words) % 2**64 == fingerprint(text, words)
