"""Removal of repeated passages by per-shard suffix arrays.

Every 200-byte string of a text has an anchor, the 48-byte string in it with the least
hash, and equal strings have equal anchors at the same place. So a text is cut into
contexts, the bytes of neighbouring strings with the same anchor, and strings can only
be equal within the contexts of one anchor.

Contexts that are equal as a whole need no further look. Those that share an anchor
but differ, as at the ends of a passage, are dealt to shards by anchor. Each shard
sorts its suffixes by Larsson-Sadakane refinement and gets common prefixes by Kasai's
rule, in numpy. The contexts of an anchor that very many texts share fill several
shards; what these hold is merged by binary search in sorted hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rankdex.llm import tokens
from rankdex.scratch import materialise

LENGTH = 200
ANCHOR = 48
#: Bytes of contexts in a shard, about, and contexts of one anchor in a shard at most.
SHARD_BYTES = 2 << 20
SHARD_CONTEXTS = 1_000
#: Anchors or texts that may be broadcast, of 8 bytes each.
BROADCAST_IDS = 2_000_000
#: An anchor that fills several shards is merged in as many parts, up to these.
MOST_PARTS = 1_024

_PLACE = np.uint64((1 << 21) - 1)


def _prefix_hashes(block: np.ndarray) -> np.ndarray:
    up, _ = tokens._powers(len(block) + 1)
    sums = np.zeros(len(block) + 1, np.uint64)
    np.cumsum(tokens._BYTE[block] * up[: len(block)], out=sums[1:])
    return sums


def _hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = tokens._powers(len(sums))
    return tokens.mix((sums[ends] - sums[starts]) * down[starts])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    found, done = values, 1
    while done * 2 <= width:
        found = np.minimum(found[:-done], found[done:])
        done *= 2
    rest = width - done
    return np.minimum(found[: len(found) - rest], found[rest:]) if rest else found


def contexts(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``row, first, last, anchor, context`` of consecutive rows, block by block: the
    first and last start of strings with one anchor, as byte places in the row, a hash
    of the anchor, and one of the context and the anchor's place in it."""
    gram = min(ANCHOR, length)
    base, end = int(offsets[0]), int(offsets[-1])
    for at in range(base, end, tokens.BLOCK):
        block = data[at : min(end, at + tokens.BLOCK + length - 1)]
        n = min(len(block) - length + 1, tokens.BLOCK)
        if n <= 0:
            continue
        sums = _prefix_hashes(block)
        places = np.arange(len(block) - gram + 1)
        grams = _hashes(sums, places, places + gram)
        packed = (grams & ~_PLACE) | places.astype(np.uint64)
        anchor = (_least(packed, length - gram + 1)[:n] & _PLACE).astype(np.int64)
        row = np.searchsorted(offsets, at + np.arange(n), "right") - 1
        inside = at + np.arange(n) + length <= offsets[row + 1]
        change = np.ones(n, bool)
        change[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | (inside[1:] != inside[:-1])
        first = np.flatnonzero(change)
        last = np.append(first[1:], n) - 1
        first, last = first[inside[first]], last[inside[first]]
        anchor, row = anchor[first], row[first]
        context = _hashes(sums, first, last + length) + tokens.mix(
            ((last - first) * 4096 + anchor - first).astype(np.uint64) + np.uint64(1)
        )
        shift = at - offsets[row]
        yield row, first + shift, last + shift, grams[anchor], context


def _anchors(documents: DataFrame, key: str, text: str, length: int) -> DataFrame:
    schema = "key long, text_id long, first int, last int, anchor long, context long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tokens.raw(batch.column(2))
            for a, b in tokens.row_groups(offsets):
                for row, first, last, anchor, context in contexts(data, offsets[a : b + 1], length):
                    at = pa.array(row + a)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(at), batch.column(1).take(at),
                            pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)),
                            pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)),
                        ],
                        names=["key", "text_id", "first", "last", "anchor", "context"],
                    )
            tokens.release()

    rows = documents.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("text_id"), F.col(text))
    return rows.mapInArrow(run, schema)


def suffix_array(content: np.ndarray) -> np.ndarray:
    """All suffixes in order, by Larsson-Sadakane refinement: groups of suffixes that
    agree so far are split by the rank of what follows, twice as far each round, and
    groups of one are left alone. Kasai's rule needs the order to be complete."""
    n = len(content)
    padded = np.concatenate([content, np.zeros(8, np.uint8)])
    words = np.zeros(n, np.uint64)
    for at in range(8):
        words |= padded[at : at + n].astype(np.uint64) << np.uint64(56 - 8 * at)
    order = np.argsort(words, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = words[order[1:]] != words[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    reach = 8
    while True:
        # A group of one starts where it does and the next group starts right after.
        alone = fresh & np.append(fresh[1:], True)
        places = np.flatnonzero(~alone)
        if not len(places):
            break
        suffixes = order[places]
        following = np.minimum(suffixes + reach, n)
        beyond = np.where(suffixes + reach < n, rank[np.minimum(following, n - 1)] + 1, 0)
        inner = np.lexsort((beyond, rank[suffixes]))
        order[places] = suffixes = suffixes[inner]
        beyond = beyond[inner]
        group = rank[suffixes]
        new = np.ones(len(places), bool)
        new[1:] = (group[1:] != group[:-1]) | (beyond[1:] != beyond[:-1])
        fresh[places] = new
        rank[suffixes] = places[np.maximum.accumulate(np.where(new, np.arange(len(places)), 0))]
        reach *= 2
    return order


def common_prefixes(
    content: np.ndarray, previous: np.ndarray, starts: np.ndarray, sizes: np.ndarray, most: int
) -> np.ndarray:
    """For every string start the length, up to ``most``, that it has in common with
    the start ``previous`` to it in sorted order (-1: none, or no start at all).

    Kasai's rule, in text order: one byte further on, the common length is one less
    at the least. The stretches of starts, given by ``starts`` and ``sizes``, advance
    side by side, and lengths grow by eight bytes at a time.
    """
    n = len(content)
    padded = np.concatenate([content, np.zeros(most + 16, np.uint8)])
    words = np.zeros(n + most + 8, np.uint64)
    for at in range(8):
        words |= padded[at : at + len(words)].astype(np.uint64) << np.uint64(8 * at)
    is_start = np.zeros(n + 1, bool)
    for step in range(int(sizes.max(initial=0))):
        is_start[starts[sizes > step] + step] = True
    found = np.zeros(n, np.int64)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    known = np.zeros(len(starts), np.int64)
    for step in range(int(sizes[0]) if len(sizes) else 0):
        active = int(np.searchsorted(-sizes, -step, "left"))
        here = starts[:active] + step
        other = previous[here]
        length = known[:active]
        length[other < 0] = 0
        going = np.flatnonzero((other >= 0) & (length < most))
        while len(going):
            differ = words[here[going] + length[going]] ^ words[np.minimum(other[going] + length[going], len(words) - 1)]
            low = differ & (~differ + np.uint64(1))
            equal = np.where(differ == 0, 8, np.bitwise_count(low - np.uint64(1)) // 8).astype(np.int64)
            length[going] += equal
            going = going[(equal == 8) & (length[going] < most)]
        np.minimum(length, most, out=length)
        found[here] = length
        carries = (other >= 0) & is_start[np.maximum(other, 0) + 1]
        known[:active] = np.where(carries, np.maximum(length - 1, 0), 0)
    return found


def repeated_starts(pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For all string starts of the pieces, in text order: their places in the joined
    pieces, whether the string starts elsewhere in them too, whether it is the first
    of its equals in sorted order, and where each piece's starts begin."""
    content = np.frombuffer(b"".join(pieces), np.uint8)
    ends = np.cumsum([len(p) for p in pieces])
    starts = ends - np.array([len(p) for p in pieces])
    sizes = ends - starts - length + 1
    owned = np.zeros(len(content), bool)
    for step in range(int(sizes.max(initial=0))):
        owned[starts[sizes > step] + step] = True
    order = suffix_array(content)
    order = order[owned[order]]
    previous = np.full(len(content), -1)
    previous[order[1:]] = order[:-1]
    prefix = common_prefixes(content, previous, starts, sizes, length)
    with_previous = prefix[order] >= length
    twice = with_previous | np.append(with_previous[1:], False)
    flags = np.zeros((2, len(content)), bool)
    flags[0, order] = twice
    flags[1, order] = ~with_previous
    places = np.flatnonzero(owned)
    return places, flags[0, places], flags[1, places], np.concatenate([[0], np.cumsum(sizes)])


_RANGE = "text_id long, first int, last int"
_FOUND = _RANGE + ", anchor long, part int, strings binary, text_ids binary, places binary, only binary"
_FOUND_TYPES = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4)


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2], edges[1::2] - 1


def _search_shard(shard: pa.Table, length: int) -> pa.Table:
    """Repeated starts of the contexts in a shard, as ranges of places in their texts.
    An anchor that fills several shards gives a row for each of its parts besides: the
    hashes of the different strings found here that fall into the part, with the text
    and place of one of each, and whether it is alone."""
    pieces = shard.column("content").to_pylist()
    text_ids, firsts = shard.column("text_id").to_numpy(), shard.column("first").to_numpy()
    n, parts = shard.column("n").to_numpy(), shard.column("parts").to_numpy()
    places, twice, first_of, bounds = repeated_starts(pieces, length)
    rows: list[tuple] = []
    alone: list[np.ndarray] = []
    for i in range(len(pieces)):
        own = slice(bounds[i], bounds[i + 1])
        if n[i] == 1:  # equal contexts are known to be repeated
            rows += [
                (text_ids[i], a + firsts[i], b + firsts[i], *[None] * 6) for a, b in zip(*_runs(twice[own]))
            ]
        alone.append(~twice[own] & (n[i] == 1))
    if len(parts) and parts[0]:  # then all contexts here are of one anchor
        sums = _prefix_hashes(np.frombuffer(b"".join(pieces), np.uint8))
        start = places[first_of]
        strings = _hashes(sums, start, start + length)
        piece = np.repeat(np.arange(len(pieces)), np.diff(bounds))[first_of]
        at = (np.arange(len(places)) - bounds[np.repeat(np.arange(len(pieces)), np.diff(bounds))])[first_of]
        texts, at = text_ids[piece], (at + firsts[piece]).astype(np.int32)
        only = np.concatenate(alone)[first_of]
        part = (strings % np.uint64(parts[0])).astype(np.int64)
        for p in np.unique(part):
            of = part == p
            columns = (strings[of], texts[of], at[of], only[of])
            rows.append((None, None, None, shard.column("anchor")[0].as_py(), p, *(c.tobytes() for c in columns)))
    names = [f.split()[0] for f in _FOUND.split(", ")]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table({name: pa.array(c, t) for name, c, t in zip(names, columns, _FOUND_TYPES)})


def _merge_shards(part: pa.Table) -> pa.Table:
    """Strings that are alone in their shard and found in another: each string's hash
    is searched in the sorted hashes of all shards, which name a string once each."""
    kinds = {"strings": np.uint64, "text_ids": np.int64, "places": np.int32, "only": np.bool_}
    strings, texts, places, only = (
        np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in part.column(name)])
        for name, kind in kinds.items()
    )
    ordered = np.sort(strings)
    asked = strings[only]
    twice = np.searchsorted(ordered, asked, "right") - np.searchsorted(ordered, asked, "left") > 1
    place = pa.array(places[only][twice])
    return pa.table({"text_id": pa.array(texts[only][twice]), "first": place, "last": place})


def _few(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def repeated_ranges(
    documents: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH
) -> DataFrame:
    """``text_id, ranges``: for every text with a string of ``length`` bytes that starts
    elsewhere too, the ranges of places where such strings start, in no order.
    ``text_id`` is ``xxhash64`` of the text: equal texts have equal ranges.

    Anchors are counted before they are shuffled, and only those that repeat travel
    on, as hashes and places. Bytes move for contexts that differ from others of their
    anchor, once for all copies of a text.
    """
    all_anchors = materialise(_anchors(documents, key, text, length), "anchors")
    repeated = all_anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    repeated = materialise(repeated.select("anchor"), "repeated")
    shared = materialise(all_anchors.join(_few(repeated), "anchor", "left_semi"), "shared")
    each = shared.groupBy("anchor", "context").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("text_id", "key", "first", "last")).alias("at")
    )
    each = materialise(each, "contexts")
    per_anchor = each.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    per_anchor = materialise(per_anchor, "open")
    whole = each.where("n > 1").select("context")
    whole = materialise(whole, "whole")
    ranges = shared.join(_few(whole), "context", "left_semi").select("text_id", "first", "last")

    wanted = each.join(_few(per_anchor), "anchor").select(
        "anchor", "context", "n", "k", "at.text_id", "at.key", "at.first", "at.last"
    )
    lists = wanted.groupBy("text_id", "key").agg(
        F.collect_list(F.struct("anchor", "context", "n", "k", "first", "last")).alias("wanted")
    )
    lists = materialise(lists, "wanted")
    rows = documents.select(F.xxhash64(text).alias("text_id"), F.col(key).cast("long").alias("key_"), F.col(text).cast("binary").alias("content"))
    rows = rows.join(_few(materialise(lists.select("text_id").distinct(), "texts")), "text_id", "left_semi")
    found = rows.join(lists, (rows["text_id"] == lists["text_id"]) & rows["key_"].eqNullSafe(lists["key"])).select(
        lists["text_id"], "content", F.explode("wanted").alias("w")
    )
    content = F.substring(F.col("content"), F.col("w.first") + 1, F.col("w.last") - F.col("w.first") + length)
    found = found.select("text_id", "w.anchor", "w.context", "w.n", "w.k", "w.first", content.alias("content"))
    # Rows that repeat key and text come once.
    found = materialise(found.dropDuplicates(["anchor", "context"]), "pieces")
    size = found.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    split = F.col("k") > SHARD_CONTEXTS
    fills = F.when(split, F.ceil(F.col("k") / SHARD_CONTEXTS)).otherwise(F.lit(0))
    # An anchor that fills shards has them for itself.
    owner = F.when(split, F.col("anchor"))
    at = F.when(split, F.pmod(F.xxhash64("context"), fills)).otherwise(
        F.pmod(F.xxhash64("anchor"), F.lit(shards))
    )
    searched = found.select(
        "text_id", "first", "anchor", "n", "content",
        F.least(fills, F.lit(MOST_PARTS)).cast("int").alias("parts"), owner.alias("owner"), at.alias("at"),
    ).groupBy("owner", "at").applyInArrow(lambda shard: _search_shard(shard, length), _FOUND)
    searched = materialise(searched, "searched")
    ranges = ranges.unionAll(searched.where(F.col("anchor").isNull()).select("text_id", "first", "last"))
    merged = searched.where(F.col("anchor").isNotNull()).drop("text_id", "first", "last")
    merged = merged.groupBy("anchor", "part").applyInArrow(_merge_shards, _RANGE)
    ranges = ranges.unionAll(merged).distinct()
    return materialise(ranges.groupBy("text_id").agg(F.collect_list(F.struct("first", "last")).alias("ranges")), "ranges")


def remove_repeats(
    documents: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH
) -> DataFrame:
    """``key, n_bytes, n_removed, spans, kept`` for every row: the text's UTF-8 bytes
    without those covered by a ``length``-byte string that starts anywhere else too.

    ``spans`` holds the removed runs as ``first, last`` byte, ascending; ``kept`` is the
    rest, as bytes, since a cut may fall within a letter. Strings are judged on the
    input, overlaps count, the same document counts as elsewhere, and strings never
    cross documents. So a text of ``length`` bytes or more that another row repeats
    goes as a whole, in both. NULL and empty texts, and those shorter than ``length``,
    keep all. Rows may repeat keys or lack them. Texts move at most once more, to meet
    their ranges.
    """
    rows = documents.select(
        F.col(key).alias("k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t")
    )
    ranges = repeated_ranges(rows, "k", "t", length)
    joined = rows.withColumn("text_id", F.xxhash64("t")).join(ranges, "text_id", "left")
    kind = documents.schema[key].dataType.simpleString()
    schema = f"k {kind}, n_bytes long, n_removed long, spans array<struct<first:int,last:int>>, kept binary"
    span = pa.struct([("first", pa.int32()), ("last", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            begin = held = 0
            for i in range(batch.num_rows):
                content = batch.column(1)[i].as_buffer()
                content = memoryview(content)
                found = batch.column(2)[i]
                spans, pieces, at = [], [], 0
                if found.is_valid:
                    starts = found.values.field(0).to_numpy().astype(np.int64)
                    ends = found.values.field(1).to_numpy() + np.int64(length)
                    order = np.argsort(starts, kind="stable")
                    starts, ends = starts[order], np.maximum.accumulate(ends[order])
                    new = np.concatenate([[True], starts[1:] > ends[:-1]])
                    last = np.append(np.flatnonzero(new)[1:], len(new)) - 1
                    for a, b in zip(starts[new].tolist(), ends[last].tolist()):
                        spans.append((a, b - 1))
                        pieces.append(content[at:a])
                        at = b
                pieces.append(content[at:])
                kept = b"".join(pieces)
                out.append((len(content), len(content) - len(kept), spans, kept))
                held += len(kept)
                if held > 8 << 20 or i + 1 == batch.num_rows:
                    sizes, removed, all_spans, texts = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(begin, len(out)), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                            pa.array([[{"first": a, "last": b} for a, b in s] for s in all_spans], pa.list_(span)),
                            pa.array(texts, pa.binary()),
                        ],
                        names=["k", "n_bytes", "n_removed", "spans", "kept"],
                    )
                    begin, held, out = i + 1, 0, []

    return joined.select("k", F.col("t").cast("binary"), "ranges").mapInArrow(run, schema).withColumnRenamed("k", key)
