"""URL filter: host and path rules, then a weighted vocabulary of terms.

A vocabulary has strict terms, one of which rejects a url, and soft terms, of which
several distinct ones do. All terms are found in one pass by an Aho-Corasick
automaton and count only where neither neighbour is an ASCII letter or digit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

ALLOW, BLOCK = "allow", "block"

# Host and path rules with their verdicts.
RULES = (
    ("com/", ALLOW),
    ("example.com/en/", BLOCK),
    ("www.example.com/en/", ALLOW),
    ("net/es/", BLOCK),
    ("net/fr/", BLOCK),
)
# The default vocabulary.
STRICT_TERMS = ("adult", "casino", "escort", "malware", "porn", "viagra", "warez", "xxx")
SOFT_TERMS = (
    "ads", "bets", "bonus", "cheap", "farm", "free", "loans", "pills", "poker", "spam", "track", "win",
)
SOFT_LIMIT = 2

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_HITS = T.StructType(
    [T.StructField("strict", T.IntegerType()), T.StructField("soft", T.IntegerType())]
)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for NULL and for urls without ``://``."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty where the host is
    missing."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[str]) -> Column:
    """The longest rule that fits, or NULL; of two as long, the one with the longer
    host. A rule is a host, which stands for its subdomains too, and the start of a
    path."""
    found = F.lit(None).cast("string")
    for rule in sorted(set(rules), key=lambda r: (len(r), r.find("/"))):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def term_hits(url: Column, strict: Sequence[str], soft: Sequence[str]) -> Column:
    """Distinct strict and distinct soft terms in ``url``, as a struct."""
    weights = {t.lower(): 0 for t in soft if t} | {t.lower(): 1 for t in strict if t}

    @F.arrow_udf(_HITS)
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term, weight in weights.items():
            automaton.add_word(term, (term, weight))
        if weights:
            automaton.make_automaton()
        inside = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")

        def hits(text: str | None) -> tuple[int, int]:
            found: dict[str, int] = {}
            for end, (term, weight) in automaton.iter(text) if text and weights else ():
                before, after = end - len(term), end + 1
                if before >= 0 and text[before] in inside:
                    continue
                if after < len(text) and text[after] in inside:
                    continue
                found[term] = weight
            n_strict = sum(found.values())
            return n_strict, len(found) - n_strict

        for texts in batches:
            counts = [hits(text) for text in texts.to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([c[i] for c in counts], pa.int32()) for i in (0, 1)],
                names=["strict", "soft"],
            )

    return count(ascii_lower(url))


def judge_urls(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    strict: Sequence[str] = STRICT_TERMS,
    soft: Sequence[str] = SOFT_TERMS,
    soft_limit: int = SOFT_LIMIT,
) -> DataFrame:
    """``key, host, path, rule, verdict, strict_hits, soft_hits`` for every row.

    The verdict is that of the longest rule that fits; without one, ``block`` if the
    url holds a strict term or ``soft_limit`` distinct soft terms, else ``allow``. A
    NULL or empty url has no rule and no term, so it is allowed. Repeated rows and
    NULL keys stay as they are. Only the two columns are read, nothing is shuffled,
    and other columns of ``pages`` do not matter. ``rules`` and terms are short
    lists; terms are compared in lower case.
    """
    # The hits are a column of their own before anything else uses them, so that the
    # automaton runs once per row.
    hits = pages.select(
        F.col(key).alias("_key"),
        host_of(F.col(url)).alias("_host"),
        path_of(F.col(url)).alias("_path"),
        term_hits(F.col(url), strict, soft).alias("_hits"),
    )
    rule = matching_rule(F.col("_host"), F.col("_path"), [r for r, _ in rules])
    by_rule = F.lit(None).cast("string")
    for pattern, verdict in rules:
        by_rule = F.when(F.col("_rule") == pattern, F.lit(verdict)).otherwise(by_rule)
    by_terms = F.when(
        (F.col("_hits.strict") > 0) | (F.col("_hits.soft") >= soft_limit), F.lit(BLOCK)
    ).otherwise(F.lit(ALLOW))
    return hits.withColumn("_rule", rule).select(
        F.col("_key").alias(key),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule").alias("rule"),
        F.coalesce(by_rule, by_terms).alias("verdict"),
        F.col("_hits.strict").alias("strict_hits"),
        F.col("_hits.soft").alias("soft_hits"),
    )
