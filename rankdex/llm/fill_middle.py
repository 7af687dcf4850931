"""Fill-in-middle transformation by repeated-capture matching, and its inverse.

One full match of ``(unit)*`` retains the end of every repetition of the group. Their
number is the length of a text in units, and the cuts are two of these ends, so no
loop over units is needed. Texts of more than ``BLOCK_UNITS`` characters are matched in
consecutive blocks of so many units, of which only the starts are kept: a cut is then
found by matching its block again, and memory does not grow with the number of units.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from rankdex.llm import tokens

# What marks prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: One code point. Any pattern that covers a text without gaps may be a unit.
CODE_POINT = "."
#: Documents in a hundred that are transformed, and those of them with the suffix first.
RATE, SUFFIX_FIRST = 90, 20
#: Units whose ends are held at once.
BLOCK_UNITS = 1 << 17


class Units:
    """The units of one text: their number ``n``, and ``end(i)``, the place in the text
    after the first ``i`` of them."""

    def __init__(self, text: str, whole: regex.Pattern, block: regex.Pattern):
        self._text, self._block, self._starts, self._size = text, block, [0], 0
        if len(text) <= BLOCK_UNITS:
            match = whole.fullmatch(text)
            if match is None:
                raise ValueError("units do not cover the text")
            self._ends = match.ends(1)
            self.n = len(self._ends)
            return
        self._ends, self.n, at = None, 0, 0
        while at < len(text):
            match = block.match(text, at)
            if match.end() == at:
                raise ValueError("units do not cover the text")
            self.n += len(match.ends(1))
            at = match.end()
            self._starts.append(at)

    def end(self, i: int) -> int:
        if i == 0:
            return 0
        if self._ends is not None:
            return self._ends[i - 1]
        # All blocks but the last hold BLOCK_UNITS units.
        number, place = divmod(i - 1, BLOCK_UNITS)
        return self._block.match(self._text, self._starts[number]).ends(1)[place]


def draws(key: int | str | None, seed: str) -> list[int]:
    """The four numbers drawn for a document; a NULL key counts as empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[at : at + 8], 16) for at in range(0, 32, 8)]


def fill_in_middle(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    unit: str = CODE_POINT,
    seed: str = "1",
    rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """``key, n, form, prefix_chars, middle_chars, output`` for every row.

    ``n`` counts the units of the whole text. Of four numbers drawn by the key, two cut
    the text after as many units, the third leaves ``100 - rate`` of a hundred texts
    ``plain``, and the fourth puts the suffix first (``spm``) in ``suffix_first`` of a
    hundred of the others (else ``psm``). Empty and NULL texts, and texts that hold a
    marker, are plain: their output is the text, empty for NULL, and their lengths
    (code points of prefix and middle) are NULL. ``unit`` is a pattern that matches one
    character or more at every place of a text that a unit before it ends at. Rows are independent: repeated rows and
    NULL keys stay as they are, other columns are not read, and nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = regex.compile(f"({unit})*+", regex.DOTALL)
        block = regex.compile(f"({unit}){{0,{BLOCK_UNITS}}}+", regex.DOTALL)
        for batch in batches:
            rows = []
            for name, value in zip(batch.column(0), batch.column(1)):
                content = value.as_py() or ""
                units = Units(content, whole, block)
                n = units.n
                h1, h2, h3, h4 = draws(name.as_py(), seed)
                if not content or h3 % 100 >= rate or any(m in content for m in (PREFIX, SUFFIX, MIDDLE)):
                    rows.append((n, "plain", None, None, content))
                    continue
                first, second = (units.end(i) for i in sorted((h1 % (n + 1), h2 % (n + 1))))
                prefix, middle, suffix = content[:first], content[first:second], content[second:]
                if h4 % 100 < suffix_first:
                    form, parts = "spm", (SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
                else:
                    form, parts = "psm", (PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
                rows.append((n, form, len(prefix), len(middle), "".join(parts)))
            columns = list(zip(*rows)) if rows else [()] * 5
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))],
                names=["k", "n", "form", "prefix_chars", "middle_chars", "output"],
            )
            tokens.release()

    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(F.col(key).alias("k"), F.col(text).alias("t"))
    schema = f"k {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(run, schema).withColumnRenamed("k", key)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made of, from the output and its form alone. A text
    with a marker is plain, so the markers of any other output are the transformation's
    own."""
    parts = F.split(F.substring(output, len(PREFIX) + 1, 2**31 - 1), f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm = F.concat(F.get(parts, F.lit(0)), F.get(parts, F.lit(2)), F.get(parts, F.lit(1)))
    spm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(2)), F.get(parts, F.lit(0)))
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))
