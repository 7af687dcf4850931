"""Order MinHash, line spread and decontamination against plain Python."""

import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from rankdex.llm import decontamination as dc, line_spread as ls, order_minhash as om
from rankdex.llm.queries import op7_order_minhash, op9_benchmark_simhash

SF = "/root/testdata/sf0.001"


def xx(*values):
    """Spark's xxhash64 of text and longs."""
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else (v % 2**64).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(data, seed=seed)
    return seed


def xx_int(seed, value):
    return xxhash.xxh64_intdigest((value % 2**32).to_bytes(4, "little"), seed=seed)


def fingerprint(text):
    """The 16 tuples of a text, by sorting all k-mers for every function."""
    units = [u for u in re.split(r"[ \t\n\x0b\f\r]+", re.sub(r"([\u3040-\u30ff\u4e00-\u9fff])", r" \1 ", text or "")) if u]
    if not units:
        numbered = []
    else:
        hashes = [xx(u) for u in units]
        kmers = [xx(*hashes[i : i + om.K]) for i in range(max(1, len(hashes) - om.K + 1))]
        seen, numbered = Counter(), []
        for place, kmer in enumerate(kmers):
            kind = kmer >> 24
            n = seen[kind]
            seen[kind] += 1
            top = kind if n == 0 else xx_int(xx(kind), n) >> 24
            numbered.append(top << 24 | place)
    found = []
    for function in range(om.FUNCTIONS):
        chosen = sorted(numbered, key=lambda e: e ^ function << 60)[: om.SELECTED]
        chosen.sort(key=lambda e: e & 0xFFFFFF)
        found.append(xx(*(e >> 24 for e in chosen)) & 0xFFFFFFFF)
    return found


def texts(prose):
    long = prose(3_000, 1)
    return [
        None, "", " \n", "one", "one two", "one two three", "a b a b a b a b a b", "x " * 400, prose(40, 2), prose(200, 3),
        prose(700, 4, 5_000), long, long + " end", "日本語 の テキスト abc", "é è ê ë à", prose(300, 5) * 3,
    ]


def test_fingerprints_against_full_sorts(frame, prose):
    rows = list(enumerate(texts(prose)))
    found = om.fingerprints(frame(rows), "text", "f").collect()
    assert len(found) == len(rows)
    for r in found:
        assert list(r.f) == fingerprint(r.text), r.doc_id


def test_next_and_edited_texts(frame, prose):
    rows = [(i * 3, t) for i, t in enumerate(texts(prose))] + [(6, "again"), (6, "again"), (None, "no id"), (-5, "last")]
    key = lambda r: (r[0] is None, -(r[0] or 0), r[1] or "")
    ordered = sorted(rows, key=key)
    expected = Counter()
    for i, (doc_id, text) in enumerate(ordered):
        own, other = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + other[:half]
        a, b, c = (fingerprint(t) for t in (own, edited, other))
        same = lambda x, y: sum(p == q for p, q in zip(x, y)) / om.FUNCTIONS
        expected[doc_id, len(own), edited, same(a, b), same(a, c)] += 1
    found = om.with_edited(frame(rows)).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited, r.near_edited, r.near_next) for r in found) == expected


def test_one_document_and_none(frame):
    found = om.with_edited(frame([(1, "abcd")])).collect()
    assert [(r.edited, r.near_next) for r in found] == [("abab", 1.0)]
    assert om.with_edited(frame([])).count() == 0


def test_order_counts(frame, prose):
    words = prose(400, 9, 5_000).split()
    moved = " ".join(words[200:] + words[:200])
    shuffled = words[:]
    random.Random(1).shuffle(shuffled)
    rows = [(1, " ".join(words)), (2, " ".join(words[:390] + ["new"] * 3)), (3, moved), (4, " ".join(shuffled))]
    f = {r.doc_id: r.f for r in om.fingerprints(frame(rows), "text", "f").collect()}
    like = lambda a, b: sum(x == y for x, y in zip(f[a], f[b])) / om.FUNCTIONS
    assert like(1, 2) >= 0.75 and like(1, 2) > like(1, 3) and like(1, 4) == 0


def test_whole_table_order_minhash(spark, table):
    documents = table("documents").select("doc_id", "text").orderBy(F.desc("doc_id")).collect()
    found = {r.doc_id: r for r in op7_order_minhash(spark, SF).collect()}
    for i, (doc_id, text) in enumerate(documents):
        other = documents[(i + 1) % len(documents)].text
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        assert found[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert found[doc_id].fingerprint == "".join(f"{h:08x}" for h in fingerprint(text))
        assert found[doc_id].edited_fingerprint == "".join(f"{h:08x}" for h in fingerprint(edited))


def deduped(rows, least):
    """Rows with repeats of lines of ``least`` sites or more removed."""
    sites, first = {}, {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    for i in order:
        key, text, site = rows[i]
        for at, line in enumerate(text.split("\n") if text is not None else []):
            if body := line.strip(" "):
                sites.setdefault(body, set()).update([site] if site is not None else [])
                first.setdefault(body, (key, text, at))
    found = Counter()
    for key, text, _ in rows:
        if text is None:
            found[key, None, 0, 0] += 1
            continue
        lines = text.split("\n")
        gone = [
            bool(b := line.strip(" ")) and len(sites[b]) >= least and first[b] != (key, text, at)
            for at, line in enumerate(lines)
        ]
        found[key, "\n".join(x for x, g in zip(lines, gone) if not g), len(lines), sum(gone)] += 1
    return found


def line_rows():
    rng = random.Random(3)
    pool = [f"line {i}" for i in range(60)]
    rows = [
        (i, "\n".join(rng.choice(pool[: 5 + i % 55]) for _ in range(rng.randrange(1, 9))), f"s{rng.randrange(14)}") for i in range(150)
    ]
    rows += [(200, None, "s1"), (201, "", "s2"), (202, "\n \n", "s3"), (203, "  line 1 \nown", None), (204, "line 2", None)]
    return rows + [(205, "line 3\nline 3\nline 3", "s0"), (206, "x" * 100_000 + "\nline 4", "s0"), (None, "line 1\nz", "s1")]


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_lines_of_many_sites(frame, monkeypatch, bound):
    monkeypatch.setattr(ls, "BROADCAST_LINES", bound)
    rows, schema = line_rows(), "doc_id long, text string, source string"
    df = frame(rows, schema)
    found = ls.dedup_lines(df, min_sites=6, counts=True)
    got = Counter((r.doc_id, r.text, r.n_lines, r.n_removed) for r in found.collect())
    assert got == deduped(rows, 6)
    assert ls.dedup_lines(df).columns == df.columns
    repeated = ls.dedup_lines(frame([*rows, rows[7]], schema), min_sites=6)
    assert repeated.where("doc_id = 7").select("text").distinct().count() == 1
    assert ls.dedup_lines(frame([], schema)).count() == 0


def test_near_lines_are_counted_exactly(spark):
    rows = [(line, f"site {s}", at) for line in range(8, 13) for s in range(line) for at in range(3)]
    lines = spark.createDataFrame(rows, "_h1 long, _site string, _h2 long")
    found = ls.boilerplate(lines, 10).collect()
    assert {r[0] for r in found} == {10, 11, 12} and len(found) == 9


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def bag(words, width):
    return Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def passages(rows, items):
    """``{(doc, item): similarity}`` over all windows of an item's length."""
    found = {}
    for doc, text in rows:
        words = words_of(text)
        for item, passage in items:
            own = words_of(passage)
            width, size = min(5, len(own)), min(len(own), len(words))
            if not own or not words:
                continue
            theirs = bag(own, width)
            for start in range(len(words) - size + 1):
                mine = bag(words[start : start + size], width)
                shared = sum((mine & theirs).values())
                if shared:
                    value = shared / sum((mine | theirs).values())
                    if value >= 0.8 and value > found.get((doc, item), 0):
                        found[doc, item] = value
    return found


def test_passages_are_found(frame, spark, prose):
    items = [(i, prose(15 + 5 * i, 100 + i, 3_000)) for i in range(8)]
    items += [(20, None), (21, ""), (22, "... !"), (23, "rare pair"), (24, "word"), (25, items[3][1]), (26, prose(300, 50, 3_000))]
    items += [(27, "again again again again again again again again"), (0, items[0][1])]
    items += [(None, items[5][1]), (0, prose(25, 900, 3_000))]
    rows_of_repeated_id = [(60, prose(9, 901) + " " + items[-1][1])]
    rows = []
    for i in range(40):
        _, passage = items[i % 8]
        words = passage.split()
        if i % 4 == 1:
            words[0] = "changed"
        if i % 4 == 2:
            words = words[: len(words) - 1]
        if i % 4 == 3:
            words[len(words) // 2] = "changed"
        rows.append((i, prose(30 + i, i, 3_000) + " " + " ".join(words).upper() + ". " + prose(20, 500 + i, 3_000)))
    rows += [(50, None), (51, ""), (52, "!!"), (53, items[2][1]), (54, "a rare, pair!"), (55, "Word"), (56, prose(20_000, 1) + items[-4][1] if items[-4][1] else "")]
    rows += rows_of_repeated_id
    rows += [(57, items[12][1] if items[12][1] else ""), (58, "again " * 30), (None, items[1][1]), (53, items[2][1])]
    found = dc.contaminated(frame(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id): r.similarity for r in found}
    expected = passages(rows, items)
    assert set(got) == set(expected)
    assert all(v == pytest.approx(expected[k]) for k, v in got.items())
    assert len(found) == len(got)
    clean = dc.without_contaminated(frame(rows), spark.createDataFrame(items, "item_id long, text string"))
    assert clean.columns == frame(rows).columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(d for d, _ in rows if all(d != k for k, _ in got))


def test_best_window_between_aligned_ones(frame, spark, prose):
    passage = [f"p{i}" for i in range(200)]
    changed = lambda n, name: [f"{name}{i}" for i in range(n)]
    # 16 words more in the middle and 8 others at each end: 0.815 at best, 0.750 where a shingle puts it.
    inserted = changed(8, "x") + passage[8:100] + changed(16, "y") + passage[100:192] + changed(8, "z")
    short = prose(40, 77, 3_000)
    rows = [(1, f"{prose(50, 1)} {' '.join(inserted)} {prose(50, 2)}"), (2, " ".join(inserted)), (3, " ".join(passage))]
    rows += [(4, " ".join(changed(300, "v"))), (None, f"{prose(9, 3)} {' '.join(inserted)}")]
    rng = random.Random(6)
    for i in range(60):
        words = passage[:] if i % 2 else short.split()
        for _ in range(rng.randrange(1, 4)):
            at = rng.randrange(len(words))
            words[at:at] = changed(rng.randrange(1, 2 + len(words) // 15), f"in{i}-{at}-")
            del words[at - rng.randrange(4) : at]
        rows.append((10 + i, f"{prose(rng.randrange(30), i)} {' '.join(words)} {prose(rng.randrange(30), 99 + i)}"))
    items = [(1, " ".join(passage)), (2, short), (3, prose(200, 5, 3_000))]
    found = dc.contaminated(frame(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id): r.similarity for r in found}
    assert got[1, 1] == got[2, 1] == got[None, 1] == pytest.approx(0.815, abs=0.001)
    assert got == pytest.approx(passages(rows, items)) and len(got) == len(found)


def test_nothing_to_find(frame, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert dc.contaminated(frame([(1, "a b c d e f")]), none).count() == 0
    assert dc.contaminated(frame([]), some).count() == 0
    assert dc.without_contaminated(frame([(1, "a b c")]), none).count() == 1


def test_lookups_find_all_within_the_radius(spark):
    rng = random.Random(8)
    base = rng.getrandbits(64)
    prints = [base ^ sum(1 << b for b in rng.sample(range(64), n)) for n in range(dc.RADIUS + 1) for _ in range(20)]
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    asked = spark.createDataFrame([(signed(p),) for p in prints], "p long").distinct()
    one = spark.createDataFrame([(signed(base),)], "q long")
    left = asked.select("p", dc._lookups(F.col("p"), 0).alias("at"))
    right = one.select("q", dc._lookups(F.col("q"), dc.BLOCK_RADIUS).alias("at"))
    assert left.join(right, "at").select("p").distinct().count() == asked.count()


def test_passages_of_the_whole_table(spark, table):
    documents = [tuple(r) for r in table("documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table("benchmark").select("item_id", "text").collect()]
    literal = {
        (d, i) for d, t in documents for i, x in items
        if f" {' '.join(words_of(x))} " in f" {' '.join(words_of(t))} "
    }
    assert literal <= {(r.doc_id, r.item_id) for r in op9_benchmark_simhash(spark, SF).collect()}
