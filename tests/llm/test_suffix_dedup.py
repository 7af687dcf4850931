import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from rankdex.llm import suffix_dedup as sd, tokens
from rankdex.llm.queries import op4_suffix_dedup

SF = "/root/testdata/sf0.001"


def brute_force(texts, length):
    """Removed byte runs of each text, by counting all strings."""
    contents = [(t or "").encode() for t in texts]
    counts = Counter(c[i : i + length] for c in contents for i in range(len(c) - length + 1))
    found = []
    for c in contents:
        gone = np.zeros(len(c) + 2, np.int8)
        for i in range(len(c) - length + 1):
            if counts[c[i : i + length]] > 1:
                gone[i + 1 : i + 1 + length] = 1
        edges = np.flatnonzero(np.diff(gone))
        found.append((c, list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()))))
    return found


def check(df, rows, length):
    expected = Counter()
    for (key, _), (content, spans) in zip(rows, brute_force([t for _, t in rows], length)):
        kept = bytearray(content)
        for a, b in reversed(spans):
            del kept[a : b + 1]
        expected[key, len(content), len(content) - len(kept), tuple(spans), bytes(kept)] += 1
    found = Counter()
    for r in sd.remove_repeats(df, length=length).collect():
        spans = tuple((s.first, s.last) for s in r.spans)
        found[r.doc_id, r.n_bytes, r.n_removed, spans, bytes(r.kept)] += 1
    assert found == expected


def test_whole_table(spark, table):
    rows = [tuple(r) for r in table("documents").select("doc_id", "text").collect()]
    found = {r.doc_id: r for r in op4_suffix_dedup(spark, SF).collect()}
    assert len(found) == len(rows)
    for (key, _), (content, spans) in zip(rows, brute_force([t for _, t in rows], sd.LENGTH)):
        kept = b"".join(
            content[a:b] for a, b in zip([0, *(e + 1 for _, e in spans)], [*(s for s, _ in spans), len(content)])
        )
        r = found[key]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(content), len(content) - len(kept), len(spans))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def odd_rows(prose):
    rng = random.Random(4)
    passage = prose(120, 77)
    rows = [(i, prose(60, i) + " " + passage[rng.randrange(200) : 300 + rng.randrange(300)] + " " + prose(40, 900 + i)) for i in range(30)]
    rows += [(100 + i, passage) for i in range(3)] + [(103, passage[:-1]), (104, "x" + passage)]
    rows += [(200, None), (201, ""), (202, "a" * 500), (203, "ab" * 300), (204, "é" * 260), (205, "ñ" + "é" * 150)]
    rows += [(206, prose(20, 5)), (206, prose(20, 5)), (None, prose(90, 6)), (None, prose(90, 6)), (207, prose(90, 6) + "!")]
    same = prose(70, 8)
    rows += [(208, same + "\n" + prose(30, 9) + "\n" + same)]
    return rows


@pytest.mark.parametrize("length", [200, 60])
def test_odd_rows(frame, prose, length):
    rows = odd_rows(prose)
    check(frame(rows), rows, length)


def test_small_blocks_and_shards(frame, prose, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK", 700)
    monkeypatch.setattr(sd, "SHARD_BYTES", 3_000)
    monkeypatch.setattr(sd, "SHARD_CONTEXTS", 5)
    monkeypatch.setattr(sd, "BROADCAST_IDS", 0)
    rows = odd_rows(prose)
    check(frame(rows), rows, 200)


def test_a_very_long_text(frame, prose):
    long = prose(60_000, 1)
    rows = [(1, long), (2, long[100_000:103_000]), (3, prose(2_000, 2)), (4, long[:150] + long[200_000:200_210])]
    check(frame(rows), rows, 200)


def test_empty_table(frame):
    assert sd.remove_repeats(frame([])).count() == 0


def test_suffix_array_and_common_prefixes():
    rng = random.Random(1)
    for text in (b"banana" * 40, b"a" * 300, bytes(rng.choice(b"ab") for _ in range(2_000)), bytes(range(256))):
        content = np.frombuffer(text, np.uint8)
        order = sd.suffix_array(content)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        m = len(text) - 64 + 1
        order = order[order < m]
        previous = np.full(len(text), -1)
        previous[order[1:]] = order[:-1]
        found = sd.common_prefixes(content, previous, np.array([0]), np.array([m]), 64)
        for i in range(m):
            j, n = previous[i], 0
            while j >= 0 and n < 64 and text[i + n] == text[j + n]:
                n += 1
            assert found[i] == n
