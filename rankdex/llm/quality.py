"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are those of the line and of the lines before
and after it, and the chain weighs changes from line to line. Forward-backward gives
each line's marginal of being good; a document's quality is their mean, weighted by
the lengths of the lines. In training, the lines of a document carry its label.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rankdex.llm import tokens
from rankdex.llm.sampling import sample_per_label

#: Bound on the labelled documents of each class that the model learns from.
PER_CLASS = 2_000
ROUNDS = 200
RATE = 0.1
RIDGE = 1e-3

FEATURES = (
    "length", "letters", "digits", "blanks", "symbols", "punctuation", "capitals", "word_length",
    "repeats", "repeats_two_back", "words", "short_words", "ends_sentence", "empty",
)

_CLASSES = np.zeros((256, 6), bool)
for _column, _members in enumerate(
    (
        [*range(65, 91), *range(97, 123), *range(128, 256)],
        range(48, 58),
        (9, 11, 12, 13, 32),
        b"#$%&*|<>{}[]\\^~=+@_/",
        b".,;:!?'\"()-",
        range(65, 91),
    )
):
    _CLASSES[list(_members), _column] = True


class Model(NamedTuple):
    """Scales of the features, weights of a line's own and its neighbours' features
    for being good, a bias, and the weights of the four changes."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    changes: np.ndarray


def lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and byte lengths of all lines of consecutive rows, and the first line of
    each row (one entry more than rows). An empty row is one empty line."""
    base, end = int(offsets[0]), int(offsets[-1])
    block = data[base:end]
    marks = np.flatnonzero(block == 10)
    row_starts = offsets[:-1] - base
    starts = np.sort(np.concatenate([row_starts, marks + 1]))
    # A break at the very end of a row starts no further line.
    row_of = np.searchsorted(row_starts, marks, "right") - 1
    closing = marks[marks + 1 == (offsets[1:] - base)[row_of]]
    if len(closing):
        drop = np.searchsorted(starts, closing + 1, "left")
        keep = np.ones(len(starts), bool)
        keep[drop] = False
        starts = starts[keep]
    row_ends = offsets[1:] - base
    first = np.searchsorted(starts, row_starts, "left")
    # Rows that are empty share their start with the next row: the i-th of equal starts is theirs.
    same = np.concatenate([[0], np.cumsum(np.diff(row_starts) == 0)]) if len(row_starts) else np.zeros(0, np.int64)
    restart = np.maximum.accumulate(np.where(np.concatenate([[True], np.diff(row_starts) != 0]), same, 0)) if len(row_starts) else same
    first = first + (same - restart)
    bounds = np.append(first, len(starts))
    owner = np.repeat(np.arange(len(first)), np.diff(bounds))
    ends = np.append(starts[1:], len(block))
    ends = np.minimum(ends, row_ends[owner])
    broken = (ends > starts) & (block[np.maximum(ends - 1, 0)] == 10) if len(block) else np.zeros(len(starts), bool)
    ends = ends - broken
    size = (ends - starts).astype(np.float64)
    counts = np.zeros((len(starts), _CLASSES.shape[1]))
    for column in range(_CLASSES.shape[1]):
        sums = np.concatenate([[0], np.cumsum(_CLASSES[:, column][block], dtype=np.int64)])
        counts[:, column] = sums[ends] - sums[starts]
    shares = counts / np.maximum(size, 1)[:, None]
    hashes, at = tokens.words(block, np.append(starts, len(block)).astype(np.int64)) if len(block) else (
        np.zeros(0, np.uint64), np.zeros(len(starts) + 1, np.int64))
    n_words = np.diff(at).astype(np.float64)
    line_of = np.repeat(np.arange(len(starts)), np.diff(at))
    again = []
    for back in (1, 2):
        equal = (hashes[back:] == hashes[:-back]) & (line_of[back:] == line_of[:-back])
        again.append(np.bincount(line_of[back:][equal], minlength=len(starts)) / np.maximum(n_words, 1))
    word_size = (size - counts[:, 2]) / np.maximum(n_words, 1)
    last = block[np.maximum(ends - 1, 0)] if len(block) else np.zeros(len(starts), np.uint8)
    features = np.column_stack(
        [
            np.log1p(size), *shares.T, np.minimum(word_size, 50), *again, np.log1p(n_words),
            np.minimum(n_words, 5) / 5, np.isin(last, list(b".!?")) & (size > 0), size == 0,
        ]
    )
    return features, size, bounds


def _with_neighbours(features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each line's features, then those of the line before and after it in its row, with
    zeros where there is none."""
    before = np.zeros_like(features)
    before[1:] = features[:-1]
    before[bounds[:-1]] = 0
    after = np.zeros_like(features)
    after[:-1] = features[1:]
    after[bounds[1:] - 1] = 0
    return np.concatenate([features, before, after], axis=1)


def marginals(good: np.ndarray, changes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over all rows side by side: each line's probabilities of being
    bad and good, and each row's expected changes, given the lines' scores ``good``.

    The rows are ordered by length and advance together, so the loop is as long as
    the longest row and every step a few array operations.
    """
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = bounds[:-1][order], sizes[order]
    emission = np.exp(np.stack([np.minimum(0, -good), np.minimum(0, good)], axis=1))
    step = np.exp(changes - changes.max())
    forward, scale_free = np.zeros_like(emission), np.zeros_like(emission)
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), "left")
    for t in range(longest):
        at = starts[: active[t]] + t
        now = emission[at] * ((forward[at - 1] @ step) if t else 1.0)
        forward[at] = now / now.sum(axis=1, keepdims=True)
    expected = np.zeros((len(sizes), 2, 2))
    scale_free[bounds[1:] - 1] = 1.0
    for t in range(longest - 1, 0, -1):
        at = starts[: active[t]] + t
        message = emission[at] * scale_free[at]
        joint = forward[at - 1][:, :, None] * step * message[:, None, :]
        expected[: active[t]] += joint / joint.sum(axis=(1, 2), keepdims=True)
        back = message @ step.T
        scale_free[at - 1] = back / back.sum(axis=1, keepdims=True)
    both = forward * scale_free
    unordered = np.empty_like(expected)
    unordered[order] = expected
    return both / both.sum(axis=1, keepdims=True), unordered


def train(features: np.ndarray, bounds: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Fit the chain by gradient steps on the penalised likelihood of the lines' labels,
    both classes weighing the same; ``labels`` has one per row."""
    mean = features.mean(axis=0)
    spread = features.std(axis=0)
    scale = np.where(spread > 1e-9, spread, 1.0)
    x = _with_neighbours((features - mean) / scale, bounds)
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    truth = labels[owner].astype(np.float64)
    # A row weighs the same whatever its length, and each class the same in all.
    share = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
    weight = (share / sizes)[owner]
    observed = np.zeros((len(sizes), 2, 2))
    observed[np.arange(len(sizes)), labels, labels] = sizes - 1
    parameters = np.zeros(x.shape[1] + 1 + 4)
    first, second = np.zeros_like(parameters), np.zeros_like(parameters)
    for t in range(1, rounds + 1):
        good = x @ parameters[:-5] + parameters[-5]
        probability, expected = marginals(good, parameters[-4:].reshape(2, 2), bounds)
        residual = weight * (truth - probability[:, 1])
        change = ((observed - expected) * (share / sizes)[:, None, None]).sum(axis=0)
        gradient = np.concatenate([residual @ x, [residual.sum()], change.ravel()]) - RIDGE * parameters
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        parameters = parameters + RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return Model(mean, scale, parameters[:-5], float(parameters[-5]), parameters[-4:].reshape(2, 2))


def qualities(model: Model, features: np.ndarray, size: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's quality, and each line's probability of being good."""
    x = _with_neighbours((features - model.mean) / model.scale, bounds)
    probability, _ = marginals(x @ model.weights + model.bias, model.changes, bounds)
    weight = size + 1.0
    total = np.add.reduceat(weight * probability[:, 1], bounds[:-1]) / np.add.reduceat(weight, bounds[:-1])
    return np.clip(total, 0.0, 1.0), probability[:, 1]


def fit(
    documents: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text",
    label: str = "quality", per_class: int = PER_CLASS,
) -> Model | float:
    """A model from up to ``per_class`` labelled documents of each class for which
    ``learn``, a condition on the key, holds.

    The tasks turn their texts into features; those of the sample come to the driver,
    a few numbers per line, and the chain is fitted there. Labels other than 0 and 1,
    labels without document and documents without label teach nothing. With one class
    only, or none, there is nothing to fit and the share of class 1 is returned (0.5
    without labels).
    """
    usable = labels.select(key, F.col(label).cast("int").alias("_label")).where(learn)
    sample = sample_per_label(usable.where(F.col("_label").isin(0, 1)), key, "_label", per_class)
    # Two classes of at most per_class rows.
    chosen = documents.select(key, text).where(learn).join(F.broadcast(sample), key)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tokens.raw(batch.column(1))
            for a, b in tokens.row_groups(offsets):
                found, _, bounds = lines(data, offsets[a : b + 1])
                packed = [found[bounds[i] : bounds[i + 1]].tobytes() for i in range(b - a)]
                keys = [batch.column(j).slice(a, b - a) for j in (0, 2)]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(packed, pa.binary())], names=["k", "label", "lines"])
            tokens.release()

    kind = documents.schema[key].dataType.simpleString()
    found = chosen.select(key, text, "_label").mapInArrow(featurise, f"k {kind}, label int, lines binary")
    table = found.orderBy("k", "label", "lines").toArrow()
    classes = table.column("label").to_numpy().astype(np.int64)
    if len(set(classes.tolist())) < 2:
        return float(classes[0]) if len(classes) else 0.5
    rows = [np.frombuffer(x.as_buffer()).reshape(-1, len(FEATURES)) for x in table.column("lines")]
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    return train(np.concatenate(rows), bounds, classes)


def scores(model: Model | float, text: Column) -> Column:
    """``score`` and ``line_scores`` of a text column, as a struct.

    ``score`` is between 0 and 1; ``line_scores`` holds each line's probability of
    being good. Lines end at line feeds. A NULL or empty text is one empty line and
    gets that line's score. A model that is a number scores every text so, with no
    line scores. Only the text goes to Python, whole, and nothing is shuffled.
    """
    if not isinstance(model, Model):
        return F.struct(
            F.lit(float(model)).alias("score"), F.array().cast("array<float>").alias("line_scores")
        )

    @F.arrow_udf("score double, line_scores array<float>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            data, offsets = tokens.raw(texts)
            totals, good, sizes = [np.zeros(0)], [np.zeros(0, np.float32)], [np.zeros(0, np.int64)]
            for a, b in tokens.row_groups(offsets):
                features, size, bounds = lines(data, offsets[a : b + 1])
                total, each = qualities(model, features, size, bounds)
                totals.append(total)
                good.append(each.astype(np.float32))
                sizes.append(np.diff(bounds))
            at = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            per_line = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(good)))
            yield pa.StructArray.from_arrays(
                [pa.array(np.concatenate(totals)), per_line], names=["score", "line_scores"]
            )
            tokens.release()

    return run(text)


def score(documents: DataFrame, model: Model | float, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score, line_scores`` for every row; see ``scores``. Repeated rows and NULL
    keys stay as they are."""
    return documents.select(key, scores(model, F.col(text)).alias("_q")).select(key, "_q.*")


def good_documents(
    documents: DataFrame, model: Model | float, text: str = "text", least: float = 0.5
) -> DataFrame:
    """The rows whose text scores ``least`` or more, with all their columns."""
    scored = documents.select(F.struct("*").alias("_doc"), scores(model, F.col(text)).alias("_q"))
    return scored.where(F.col("_q.score") >= least).select("_doc.*")
