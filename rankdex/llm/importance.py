"""Target-distribution importance resampling over hashed n-grams.

Features are runs of words, hashed to buckets by their CRC-32. An Aho-Corasick
automaton holds the distinct words of a block of text between delimiters, each with
its CRC and its length; one scan emits these payloads in text order. The CRC of a run
of words is composed from the payloads of neighbours, without its text. Documents and
target texts are counted by bucket, every bucket gets a gain, a document's weight is
its mean gain, and documents are drawn without replacement by weight plus Gumbel noise.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rankdex.llm import tokens
from rankdex.operators.ranking import dense_index
from rankdex.scratch import materialise

RUN_WORDS = 1
BUCKETS = 10_000
#: Of a hundred documents with at least LEAST_WORDS words, so many are drawn.
PERCENT, LEAST_WORDS = 10, 20
#: Bytes of text whose distinct words make one automaton.
BLOCK_BYTES = 1 << 20
#: Bytes of a word from which on it is not put into an automaton.
LONG_WORD = 500

# Words are runs of digits, letters (A-Z as a-z) and all bytes beyond ASCII.
_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_GAP = re.compile(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]")
_LONG = re.compile(rb"[^ ]{%d,}" % (LONG_WORD + 1))
_CRC_POLYNOMIAL = 0xEDB88320


def _crc_tables(powers: int = 32) -> np.ndarray:
    """``tables[p][i][b]``: what ``2**p`` zero bytes make of a CRC whose ``i``-th byte is
    ``b``, all others 0."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(_CRC_POLYNOMIAL), byte >> 1).astype(np.uint32)
    start = np.arange(256, dtype=np.uint32)
    tables = np.zeros((powers, 4, 256), np.uint32)
    for i in range(4):
        x = start << np.uint32(8 * i)
        tables[0, i] = (x >> np.uint32(8)) ^ byte[x & 255]
    for p in range(1, powers):
        for i in range(4):
            tables[p, i] = _through(tables[p - 1], tables[p - 1, i])
    return tables


def _through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    found = table[0][crc & 255]
    for i in range(1, 4):
        found = found ^ table[i][(crc >> np.uint32(8 * i)) & 255]
    return found


_TABLES = _crc_tables()


def joined_crc(left: np.ndarray, right: np.ndarray, right_size: np.ndarray) -> np.ndarray:
    """The CRC-32 of texts put together, from those of their halves and the number of
    bytes of the right ones."""
    crc = left.copy()
    for p in range(int(right_size.max(initial=0)).bit_length()):
        there = (right_size >> p & 1).astype(bool)
        crc[there] = _through(_TABLES[p], crc[there])
    return crc ^ right


def _payload(word: bytes) -> int:
    return len(word) << 32 | zlib.crc32(word)


class Words:
    """Finds the words of blocks between blanks by an automaton. The payload of a word is
    its number of bytes above its CRC-32. Words of more than ``LONG_WORD`` bytes stay out
    of the automaton, whose depth is that of its longest word, and get theirs on sight."""

    def __init__(self, blocks: list[bytes]):
        self._automaton, self._any_long = ahocorasick.Automaton(ahocorasick.STORE_ANY), False
        words: set[bytes] = set()
        for block in blocks:
            words.update(block.split())
        for word in words:
            if len(word) > LONG_WORD:
                self._any_long = True
            else:
                self._automaton.add_word(f" {word.decode('latin-1')} ", _payload(word))
        self._automaton.make_automaton()

    def _scan(self, block: bytes) -> list[int]:
        if not len(self._automaton):
            return []
        return [payload for _, payload in self._automaton.iter(f" {block.decode('latin-1')} ")]

    def payloads(self, block: bytes) -> np.ndarray:
        """CRC and length of all words of a block of blank-separated words, in order."""
        found, at = [], 0
        for long in _LONG.finditer(block) if self._any_long else ():
            found += self._scan(block[at : long.start()])
            found.append(_payload(long.group()))
            at = long.end()
        return np.array(found + self._scan(block[at:]), np.uint64)


def run_crcs(words: np.ndarray, width: int, new: int) -> Iterator[np.ndarray]:
    """CRC-32 of all runs of 1 to ``width`` words, joined by one blank, that end in one
    of the last ``new`` words."""
    crc, size = (words & np.uint64(0xFFFFFFFF)).astype(np.uint32), (words >> np.uint64(32)).astype(np.int64)
    blank = np.uint32(zlib.crc32(b" "))
    first = len(words) - new
    runs = crc
    yield runs[first:]
    for w in range(2, width + 1):
        if len(words) < w:
            return
        # runs[i] ends at word i + w - 2 and goes on with word i + w - 1.
        spaced = joined_crc(runs[:-1], np.broadcast_to(blank, len(runs) - 1), np.ones(len(runs) - 1, np.int64))
        runs = joined_crc(spaced, crc[w - 1 :], size[w - 1 :])
        yield runs[max(first - (w - 1), 0) :]


def _blocks(content: memoryview) -> Iterator[bytes]:
    """A text in blocks that end between words, delimiters as blanks."""
    at = 0
    while at < len(content):
        cut = _GAP.search(content, at + BLOCK_BYTES)
        to = cut.end() if cut else len(content)
        yield bytes(content[at:to]).translate(_BYTES)
        at = to


def _groups(column: pa.Array) -> Iterator[tuple[list[int], list[bytes]]]:
    """Rows and blocks of about ``BLOCK_BYTES``, with every row's blocks in order."""
    rows, blocks, held = [], [], 0
    for i, value in enumerate(column):
        content = memoryview(value.as_buffer()) if value.is_valid else b""
        for block in _blocks(content):
            rows.append(i)
            blocks.append(block)
            held += len(block)
            if held >= BLOCK_BYTES:
                yield rows, blocks
                rows, blocks, held = [], [], 0
    yield rows, blocks


def features(
    documents: DataFrame, key: str = "doc_id", text: str = "text", run_words: int = RUN_WORDS, buckets: int = BUCKETS
) -> DataFrame:
    """``key, n_words, n_features, features`` of every row: the buckets of all runs of 1
    to ``run_words`` words as packed little-endian integers (16 bits up to 65,536
    buckets, else 32), repeats included, in no order. Texts without words, NULL texts
    included, have none."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words = np.zeros(len(batch), np.int64)
            found: list[list[bytes]] = [[] for _ in range(len(batch))]
            last, before = -1, np.zeros(0, np.uint64)
            for rows, blocks in _groups(batch.column(1).cast(pa.large_binary())):
                words = Words(blocks)
                for row, block in zip(rows, blocks):
                    emitted = words.payloads(block)
                    if row != last:
                        last, before = row, emitted[:0]
                    n_words[row] += len(emitted)
                    both = np.concatenate([before, emitted])
                    if len(emitted):
                        for crcs in run_crcs(both, run_words, len(emitted)):
                            found[row].append((crcs % np.uint32(buckets)).astype(kind).tobytes())
                    before = both[max(len(both) - run_words + 1, 0) :]
            packed = [b"".join(parts) for parts in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_words),
                    pa.array([len(p) // kind.itemsize for p in packed], pa.int64()),
                    pa.array(packed, pa.binary()),
                ],
                names=["k", "n_words", "n_features", "features"],
            )
            tokens.release()

    of_key = documents.schema[key].dataType.simpleString()
    rows = documents.select(F.col(key).alias("k"), F.col(text).alias("t"))
    schema = f"k {of_key}, n_words long, n_features long, features binary"
    return rows.mapInArrow(run, schema).withColumnRenamed("k", key)


def _unpacked(column: pa.Array, buckets: int) -> np.ndarray:
    """The buckets of all rows of a batch, one row after the other."""
    data, offsets = tokens.raw(column)
    kind = "<u2" if buckets <= 1 << 16 else "<u4"
    return np.frombuffer(data[offsets[0] : offsets[-1]].tobytes(), kind)


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: how often each bucket occurs in the features of a table. A task
    sends one row per bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_unpacked(batch.column(0), buckets), minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["bucket", "n"])

    rows = found.select("features").mapInArrow(count, "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Per bucket, a thousand times the logarithm of its share of the target over its
    share of the source, one added to every count, rounded down.

    ``source`` and ``target`` are tables of ``bucket_counts``; only these, at most
    ``buckets`` rows each, come to the driver."""
    spark = source.sparkSession
    totals = [counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for counts in (source, target)]
    every = spark.range(buckets).withColumnRenamed("id", "bucket")
    both = every.join(source.withColumnRenamed("n", "s"), "bucket", "left").join(
        target.withColumnRenamed("n", "t"), "bucket", "left"
    )
    s, t = (F.coalesce(c, F.lit(0)).cast("double") for c in ("s", "t"))
    all_s, all_t = (F.lit(float(total + buckets)) for total in totals)
    ratio = (t + 1) * all_s / ((s + 1) * all_t)
    rows = both.select("bucket", F.floor(F.log(ratio) * 1000).alias("gain")).collect()
    found = np.zeros(buckets, np.int64)
    for bucket, gain in rows:
        found[bucket] = gain
    return found


def gumbel(key: Column, seed: str) -> Column:
    """A thousand times a Gumbel number drawn by the key, rounded down. A NULL key counts
    as empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((drawn + 0.5) / 4294967296.0)) * -1000)


def weighted(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``found`` with ``weight`` instead of its features: the mean gain of a row's
    features, rounded down; 0 without features."""
    known = found.sparkSession.sparkContext.broadcast(gain)
    kept = [c for c in found.columns if c != "features"]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(batch.schema.get_field_index("n_features")).to_numpy()
            values = known.value[_unpacked(batch.column(batch.schema.get_field_index("features")), len(known.value))]
            sums = np.concatenate([[0], np.cumsum(values)])
            ends = np.cumsum(n)
            weight = (sums[ends] - sums[ends - n]) // np.maximum(n, 1)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(weight.astype(np.int64))], names=[*kept, "weight"])

    schema = ", ".join(f"`{c}` {found.schema[c].dataType.simpleString()}" for c in kept)
    return found.mapInArrow(weigh, f"{schema}, weight long")


def draw(scored: DataFrame, key: str, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` with ``rank``: 1 and on for the highest scores of ``percent`` of a
    hundred rows of ``least_words`` words or more, ties to the smaller key; else NULL.

    Scores are whole numbers within a range that does not grow with the rows (a gain is
    a logarithm), so a count per score finds the lowest one drawn. Only the rows from
    there on are sorted.
    """
    enough = F.col("n_words") >= least_words
    counts = scored.where(enough).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    counts = materialise(counts, "scores")
    wanted = int(counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) * percent // 100
    none = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return scored.select("*", none)
    above = counts.withColumn("n", F.sum("n").over(Window.orderBy(F.desc("score"))))
    least = above.where(F.col("n") >= wanted).agg(F.max("score")).first()[0]
    near = enough & (F.col("score") >= least)
    others = [F.asc_nulls_first(c) for c in scored.columns if c not in (key, "score")]
    sorted_ = dense_index(scored.where(near), [F.desc("score"), F.asc_nulls_last(key), *others], "_place")
    place = F.col("_place") + 1
    drawn = sorted_.select(*scored.columns, F.when(place <= wanted, place).alias("rank"))
    return drawn.unionAll(scored.where(~near).select("*", none))


def resample(
    documents: DataFrame,
    target: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    run_words: int = RUN_WORDS,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: str = "2024",
) -> DataFrame:
    """``key, n_words, n_features, weight, score, rank`` for every row of ``documents``.

    ``weight`` is the mean gain of a document's features, ``score`` adds noise that its
    key draws, and ``rank`` numbers the drawn rows from the highest score. Texts without
    words, NULL ones included, have weight 0 and are not drawn. Rows are judged one by
    one: those that repeat a key and text get the same score and ranks next to each
    other; a NULL key comes after others of its score. Other columns are not read.

    Texts are scanned once; their features are stored as two bytes each.
    """
    found = materialise(features(documents, key, text, run_words, buckets), "features")
    wanted = features(target.select(F.lit(0).alias("_k"), F.col(target_text).alias("_t")), "_k", "_t", run_words, buckets)
    gain = gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets), buckets)
    scored = weighted(found, gain).withColumn("score", F.col("weight") + gumbel(F.col(key), seed))
    return draw(materialise(scored, "scored"), key, percent, least_words)
