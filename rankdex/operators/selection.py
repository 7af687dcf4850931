"""The first rows of an order, selected before anything is sorted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F

#: Rows sampled in a round, at most twice as many.
SAMPLE_ROWS = 10_000
#: Rows beyond the wanted ones that are not worth another round.
SLACK_ROWS = 10_000

Order = Sequence[tuple[str, bool]]


def sort_columns(order: Order) -> list[Column]:
    """The columns of ``(name, ascending)`` as Spark sorts them: NULLs come first where
    ascending and last where descending."""
    return [F.col(name).asc() if ascending else F.col(name).desc() for name, ascending in order]


def _up_to(order: Order, place: Row, types: dict[str, str]) -> Column:
    """Whether a row comes before ``place`` in the order or is equal to it."""
    found = F.lit(True)
    for name, ascending in reversed(order):
        value, bound = F.col(name), F.lit(place[name]).cast(types[name])
        if place[name] is None:
            before = F.lit(False) if ascending else value.isNotNull()
        elif ascending:
            before = value.isNull() | (value < bound)
        else:
            before = F.coalesce(value > bound, F.lit(False))
        found = before | (value.eqNullSafe(bound) & found)
    return found


def _places(sample: list[Row], part: float) -> list[Row]:
    """Rows of a sorted sample around its part, the nearer the denser: by powers of two
    of a quarter of the deviation that a sample of this size has."""
    middle = min(len(sample) - 1, int(part * len(sample)))
    step, ats = max(1.0, (middle + 1) ** 0.5 / 4), {0, middle, len(sample) - 1}
    while step < len(sample):
        ats |= {int(middle - step), int(middle + step)}
        step *= 2
    return [sample[at] for at in sorted(ats) if 0 <= at < len(sample)]


def first_rows(rows: DataFrame, order: Order, wanted: int, total: int | None = None, slack: int = SLACK_ROWS) -> DataFrame:
    """The first ``wanted`` rows of ``order``, and not many others: at most a quarter as
    many or ``slack``, where rows are not equal in all of ``order``.

    A round takes a sample of the rows for places of the order, and counts the rows up to
    each of them in one pass: a histogram by the sort key. Rows beyond the first place
    that has enough are dropped, and the next round narrows the others. Ties in leading
    columns cost nothing where ``order`` ends in a unique column, as places compare by
    all of its columns. Only the sample comes to the driver; nothing is shuffled.

    Every round reads ``rows`` twice: give stored, narrow ones. ``total`` is their number
    where it is known.
    """
    total = rows.count() if total is None else total
    names = [name for name, _ in order]
    types = {name: rows.schema[name].dataType.simpleString() for name in names}
    turn = 0
    while wanted and total > wanted + max(wanted // 4, slack):
        turn += 1
        bound = int(min(1.0, SAMPLE_ROWS / total) * (2**64 - 2**12)) - 2**63
        drawn = rows.where(F.xxhash64(F.lit(turn), *names) <= bound).select(*names).limit(2 * SAMPLE_ROWS)
        sample = drawn.orderBy(*sort_columns(order)).collect()
        if not sample:
            break
        up_to = [_up_to(order, place, types) for place in _places(sample, wanted / total)]
        counts = rows.agg(*(F.count(F.when(c, 1)) for c in up_to)).first()
        enough = [(n, i) for i, n in enumerate(counts) if n >= wanted]
        if not enough or enough[0][0] > 0.9 * total:
            break
        total, i = enough[0]
        rows = rows.where(up_to[i])
    return rows if wanted else rows.limit(0)
