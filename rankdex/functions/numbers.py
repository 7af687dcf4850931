"""Integers from text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def strict_long(text: Column) -> Column:
    """The integer that ``text`` spells; anything else, NULL included, fails the
    job, whatever ``spark.sql.ansi.enabled`` says."""
    shown = F.coalesce(text, F.lit("NULL"))
    return F.coalesce(
        lenient_long(text),
        F.raise_error(F.concat(F.lit("not an integer: "), shown)).cast("long"),
    )


def lenient_long(text: Column) -> Column:
    """The integer that ``text`` spells, or NULL. Blanks are not trimmed."""
    return F.when(text.rlike(r"^[+-]?[0-9]+\z"), text.try_cast("long"))


# Fixed value: the white space that may stand before a number.
_SPACE = r"[\s\x0B\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]*"


def prefix_long(text: Column) -> Column:
    """The integer at the start of ``text`` after white space, or NULL: ``12abc`` gives
    12. After ``0x`` it is hexadecimal, and ``0x`` without a digit is no integer.
    Beyond 64 bits it is NULL."""
    digits = F.ltrim(F.regexp_extract(text, f"^{_SPACE}[+-]?0[xX]([0-9a-fA-F]+)", 1), F.lit("0"))
    # conv() reads up to 64 bits, unsigned.
    size = F.when(F.length(digits) <= 16, F.conv(F.concat(F.lit("0"), digits), 16, 10).try_cast("long"))
    negative = F.regexp_extract(text, f"^{_SPACE}([+-]?)", 1) == "-"
    hexadecimal = F.when(negative, -size).otherwise(size)
    decimal = F.regexp_extract(text, f"^{_SPACE}([+-]?[0-9]+)", 1).try_cast("long")
    # Most ids hold no x: spare them the hexadecimal patterns.
    return F.when(
        F.lower(text).contains("0x") & text.rlike(f"^{_SPACE}[+-]?0[xX]"),
        F.when(text.rlike(f"^{_SPACE}[+-]?0[xX][0-9a-fA-F]"), hexadecimal),
    ).otherwise(decimal)
