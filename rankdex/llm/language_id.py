"""Language identification as inference of a mixture of languages.

A model holds, for every language, the likelihoods of byte trigrams. The trigrams of a
document are taken as a mixture of languages, whose proportions expectation
maximisation estimates. The set of languages is then chosen by penalised likelihood:
one more language has to gain more than it costs. A set may hold all languages; sizes
are left out only where no mixture at all could gain what they cost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rankdex.llm import tokens
from rankdex.llm.sampling import sample_per_label

UNDETERMINED = "und"
#: Trigrams are hashed into so many buckets.
BUCKETS = 1 << 14
#: Bound on the labelled documents per language that a model learns from.
PER_LANGUAGE = 2_000
ROUNDS, SET_ROUNDS = 15, 8
#: A letter is in three trigrams, so their counts weigh a third.
WEIGHT = 1 / 3
#: Cost of one more language, times the logarithm of the trigrams.
PENALTY = 2.0

# Bytes of letters stay (any byte of a longer code counts as one); the rest is a blank.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and count of the trigrams of consecutive rows. Trigrams of nothing
    but blanks are left out."""
    base, end = int(offsets[0]), int(offsets[-1])
    folded = _FOLD[data[base:end]].astype(np.uint32)
    if len(folded) < 3:
        return (np.zeros(0, np.int64),) * 3
    code = folded[:-2] << np.uint32(16) | folded[1:-1] << np.uint32(8) | folded[2:]
    row = np.searchsorted(offsets - base, np.arange(len(code)), "right") - 1
    whole = np.arange(len(code)) + 3 <= (offsets[1:] - base)[row]
    letters = whole & (code != 0x202020)
    bucket = (code[letters] * np.uint32(0x9E3779B1)) >> np.uint32(32 - 14)
    keys = np.sort(row[letters].astype(np.uint64) << np.uint64(14) | bucket)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(keys)))
    keys = keys[first]
    return (keys >> np.uint64(14)).astype(np.int64), (keys & np.uint64(BUCKETS - 1)).astype(np.int64), counts


def fit(
    documents: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> tuple[list[str], np.ndarray]:
    """The languages, ascending, and a likelihood of each bucket for each of them.

    Learns from up to ``per_language`` documents of each language for which ``learn``
    holds, and at most ``sampling.MAX_LABELS`` languages, of 64 KB each. Trigrams are
    counted by the tasks; one row per language and bucket comes to the driver. Without
    labelled documents there are no languages.
    """
    labelled = documents.where(learn)
    sample = sample_per_label(labelled, key, lang, per_language)
    # At most per_language rows a language.
    chosen = labelled.select(key, lang, text).join(F.broadcast(sample), [key, lang], "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            data, offsets = tokens.raw(batch.column(1))
            sums: dict[str, np.ndarray] = {}
            for a, b in tokens.row_groups(offsets):
                rows, buckets, counts = trigrams(data, offsets[a : b + 1])
                cuts = np.searchsorted(rows, np.arange(b - a + 1))
                for i in range(b - a):
                    at = slice(cuts[i], cuts[i + 1])
                    own = sums.setdefault(names[a + i], np.zeros(BUCKETS, np.int64))
                    own[buckets[at]] += counts[at]
            for name, own in sums.items():
                used = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(used), pa.string()), pa.array(used), pa.array(own[used])],
                    names=["lang", "bucket", "n"],
                )

    counted = chosen.select(lang, text).mapInArrow(count, "lang string, bucket long, n long")
    found = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    names = sorted(row[0] for row in sample.select(lang).distinct().collect())
    table = found.toArrow()
    counts = np.full((len(names), BUCKETS), 0.5)
    at = {name: i for i, name in enumerate(names)}
    lines = np.array([at[x] for x in table.column("lang").to_pylist()], np.int64)
    counts[lines, table.column("bucket").to_numpy()] += table.column("n").to_numpy()
    return names, (counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def _estimate(
    likely: np.ndarray, weights: np.ndarray, starts: np.ndarray, sizes: np.ndarray, shares: np.ndarray, rounds: int
) -> tuple[np.ndarray, np.ndarray]:
    """Proportions after some rounds, and their log likelihoods. ``likely`` has a line
    per trigram and a column per language; rows without trigrams are not passed."""
    total = np.add.reduceat(weights, starts)[:, None]
    for _ in range(rounds):
        joint = likely * np.repeat(shares, sizes, axis=0)
        joint *= (weights / np.maximum(joint.sum(axis=1), 1e-30))[:, None]
        shares = np.add.reduceat(joint, starts, axis=0) / total
    mixed = (likely * np.repeat(shares, sizes, axis=0)).sum(axis=1)
    return shares, np.add.reduceat(weights * np.log(np.maximum(mixed, 1e-30)), starts, dtype=np.float64)


def _ceiling(
    likely: np.ndarray, weights: np.ndarray, starts: np.ndarray, sizes: np.ndarray, shares: np.ndarray, reached: np.ndarray
) -> np.ndarray:
    """Log likelihoods that no mixture of the languages exceeds, from proportions that
    have reached some: the likelihood is concave, so the steepest language bounds it."""
    mixed = np.maximum((likely * np.repeat(shares, sizes, axis=0)).sum(axis=1), 1e-30)
    total = np.add.reduceat(weights, starts)
    steepest = np.add.reduceat(likely * (weights / mixed)[:, None], starts, axis=0).max(axis=1) / total
    # With some room for rounding.
    return reached + total * np.log(np.maximum(steepest, 1)) + 1e-5 * np.abs(reached)


def mixtures(
    rows: np.ndarray, buckets: np.ndarray, counts: np.ndarray, likelihoods: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The rows that have trigrams, and the proportions of the languages in the set
    chosen for each; those outside of it are 0."""
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]])) if len(rows) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(first, len(rows)))
    n_languages = len(likelihoods)
    if not len(first):
        return rows[first], np.zeros((0, n_languages))
    weights = (counts * WEIGHT).astype(np.float32)
    likely = likelihoods.T[buckets]
    shares = np.full((len(first), n_languages), 1 / n_languages, np.float32)
    shares, reached = _estimate(likely, weights, first, sizes, shares, ROUNDS)
    ceiling = _ceiling(likely, weights, first, sizes, shares, reached)
    order = np.argsort(-shares, axis=1, kind="stable")
    n = np.add.reduceat(weights, first)
    best, best_score = np.zeros_like(shares), np.full(len(first), -np.inf)
    for size in range(1, n_languages + 1):
        cost = PENALTY * (size - 1) * np.log(n + 2)
        open_ = np.flatnonzero(ceiling - cost > best_score)
        if not len(open_):
            break
        inside = order[open_, :size]
        lines = np.flatnonzero(np.repeat(ceiling - cost > best_score, sizes))
        starts = np.cumsum(sizes[open_]) - sizes[open_]
        own = likely[lines[:, None], np.repeat(inside, sizes[open_], axis=0)]
        start = np.take_along_axis(shares[open_], inside, axis=1) + np.float32(1e-3)
        start = start / start.sum(axis=1, keepdims=True)
        found, score = _estimate(own, weights[lines], starts, sizes[open_], start, SET_ROUNDS if size > 1 else 0)
        score = score - cost[open_]
        better = score > best_score[open_] + 1e-9
        best_score[open_[better]] = score[better]
        full = np.zeros((len(open_), n_languages), np.float32)
        np.put_along_axis(full, inside, found, axis=1)
        best[open_[better]] = full[better]
    return rows[first], best


def predict(
    documents: DataFrame, model: tuple[list[str], np.ndarray], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, lang_pred, score, languages`` for every row.

    ``languages`` maps each language of the chosen set, of up to all that were learned,
    to its proportion, ``lang_pred``
    is the one with the largest (the first by name of equals) and ``score`` that
    proportion. A NULL text, one without a letter, and any text under a model without
    languages is ``und`` with score 0 and no languages; letters too few for a trigram
    leave all languages equal. Whole texts are read, row by row: nothing is shuffled,
    and repeated rows and NULL keys stay as they are.
    """
    names, likelihoods = model
    shipped = documents.sparkSession.sparkContext.broadcast(likelihoods)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shipped.value
        for batch in batches:
            data, offsets = tokens.raw(batch.column(1))
            for a, b in tokens.row_groups(offsets):
                shares = np.full((b - a, len(names)), 1 / max(1, len(names)))
                if names:
                    at, found = mixtures(*trigrams(data, offsets[a : b + 1]), table)
                    shares[at] = found
                texts = batch.column(1).slice(a, b - a)
                known = [bool(names) and t.is_valid and any(map(str.isalpha, t.as_py())) for t in texts]
                best = shares.argmax(axis=1) if names else np.zeros(b - a, np.int64)
                langs = [names[i] if ok else UNDETERMINED for i, ok in zip(best, known)]
                scores = [min(1.0, float(shares[j, best[j]])) if ok else 0.0 for j, ok in enumerate(known)]
                sets = [
                    [(names[i], float(shares[j, i])) for i in np.flatnonzero(shares[j])] if ok else []
                    for j, ok in enumerate(known)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(langs, pa.string()),
                        pa.array(scores, pa.float64()),
                        pa.array(sets, pa.map_(pa.string(), pa.float64())),
                    ],
                    names=["k", "lang_pred", "score", "languages"],
                )

    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(F.col(key).alias("k"), F.col(text).alias("t"))
    out = rows.mapInArrow(run, f"k {kind}, lang_pred string, score double, languages map<string,double>")
    return out.withColumnRenamed("k", key)
