"""Words, stems, queries and addresses."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rankdex.functions import porter

MAX_WORDS = 15  # Fixed value: words of a query that are looked up.
_KNOWN_STEMS = 50_000  # Bound on each of the two generations of words one task remembers.
_PART_WORDS = 32  # Words of a text that go to Python in one row.


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` worked out once however often ``use`` names it, also
    where the optimizer copies the result into a filter. A column of its own does not do
    that: a filter that is pushed below it takes a copy for every mention, those inside of
    lambdas once per element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    """The distinct lowercase words (runs of letters) of a whole text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), F.lit(1)))


def query_words(query: Column, limit: int = MAX_WORDS) -> Column:
    """The first ``limit`` words of a query, lowercase, in order, repeats kept.
    Words end at single spaces; the empty words between two spaces are dropped."""
    split = F.filter(F.split(F.lower(query), " "), lambda word: word != "")
    return F.slice(split, 1, limit)


def valid_query(query: Column) -> Column:
    """True for a non-empty query of ASCII letters and spaces only."""
    return F.coalesce(query.rlike(r"^[A-Za-z ]+\z"), F.lit(False))


class _Stems:
    """Stems of words, of which the last few are remembered: when one generation of known
    words is full, it takes the place of the one before."""

    def __init__(self) -> None:
        self.known: dict[str, str] = {}
        self.before: dict[str, str] = {}

    def __call__(self, vocabulary: pa.Array) -> pa.Array:
        return pa.array((self._stem(word) for word in vocabulary.to_pylist()), pa.string())

    def _stem(self, word: str | None) -> str | None:
        if word is None:
            return None
        found = self.known.get(word)
        if found is None:
            found = self.before.get(word)
            if found is None:
                found = porter.stem(word)
            if len(self.known) >= _KNOWN_STEMS:
                self.known, self.before = {}, self.known
            self.known[word] = found
        return found


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_words(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The stem of every word in an array column, for arrays of few words: a worker holds
    as many of them as an Arrow batch has rows. For whole texts see ``distinct_stems``.

    Each batch is dictionary-encoded, so Python sees a word once per batch; the words
    themselves stay in Arrow buffers.
    """
    stems_of = _Stems()
    for lists in batches:
        encoded = pc.dictionary_encode(lists.flatten())
        stems = stems_of(encoded.dictionary)
        lengths = pc.fill_null(pc.list_value_length(lists), 0).cast(pa.int32())
        ends = pc.cumulative_sum(lengths)
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends])
        yield pa.ListArray.from_arrays(
            offsets, stems.take(encoded.indices), mask=pc.is_null(lists)
        ).cast(lists.type)


def distinct_stems(df: DataFrame, keywords: Column, key: str) -> DataFrame:
    """``keyword, doc_id``: the distinct stems of the words in the array ``keywords`` of
    each row, with the row's ``key``. Words are not null.

    A row's words go to Python in parts of ``_PART_WORDS``, so that a batch holds a
    bounded number of words however long the texts are. A worker holds one batch, the
    words it remembers, and the stems of one row.
    """

    def parts(found: Column) -> Column:
        last = F.floor((F.size(found) - 1) / _PART_WORDS).cast("int")
        cut = F.transform(
            F.sequence(F.lit(0), last), lambda at: F.slice(found, at * _PART_WORDS + 1, F.lit(_PART_WORDS))
        )
        return F.when(F.size(found) > 0, cut)

    # An inner explode would make Spark find the words twice: for a filter, and for rows.
    cut = F.posexplode_outer(once(keywords, parts)).alias("at", "words")
    rows = df.select(cut, F.col(key).alias("doc_id")).where(F.col("at").isNotNull())
    kind = df.select(key).schema[0].dataType
    schema = T.StructType([T.StructField("keyword", T.StringType()), T.StructField("doc_id", kind)])

    def stem(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stems_of = _Stems()
        held: set[str] = set()  # the stems so far of the row that the next batch may go on with
        for batch in batches:
            if not batch.num_rows:
                continue
            part = np.repeat(np.arange(batch.num_rows), pc.list_value_length(batch.column(1)).to_numpy())
            encoded = pc.dictionary_encode(batch.column(1).flatten())
            stems = pc.dictionary_encode(stems_of(encoded.dictionary))
            codes = stems.indices.to_numpy()[encoded.indices.to_numpy()].astype(np.int64)
            # Rows are numbered within the batch; number 0 goes on from the batch before.
            row = np.cumsum(batch.column(0).to_numpy() == 0)[part]
            firsts = np.unique(row * len(stems.dictionary) + codes, return_index=True)[1]
            firsts.sort()
            going_on = int(np.searchsorted(row[firsts], 1))
            if going_on and held:
                early = stems.dictionary.take(pa.array(codes[firsts[:going_on]])).to_pylist()
                new = [at for at, one in zip(firsts, early) if one not in held]
                firsts = np.concatenate([np.array(new, firsts.dtype), firsts[going_on:]])
            if row[-1]:
                held = set()
            last = codes[firsts[row[firsts] == row[-1]]]
            held.update(stems.dictionary.take(pa.array(last)).to_pylist())
            found = stems.dictionary.take(pa.array(codes[firsts]))
            keys = batch.column(2).take(pa.array(part[firsts]))
            yield pa.RecordBatch.from_arrays([found, keys], names=["keyword", "doc_id"])

    return rows.mapInArrow(stem, schema)


def replace_first(text: Column, old: str, new: str) -> Column:
    """``text`` with the first ``old`` replaced by ``new``, both taken literally."""
    at = F.instr(text, old)
    return F.when(at > 0, F.overlay(text, F.lit(new), at, F.lit(len(old)))).otherwise(text)
