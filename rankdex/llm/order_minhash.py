"""Order MinHash fingerprints, in DataFrame functions only.

A text's k-mers of words are numbered by occurrence, so that repeats count. For every
hash function the smallest numbered k-mers are selected, put back into text order and
hashed as a tuple. Texts that keep their k-mers and their order share many tuples, so
the share of equal tuples follows the edit distance rather than the set overlap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from rankdex.scratch import materialise

K = 3
SELECTED = 2
#: A function's mask differs from all others in the top four bits of a hash, so each
#: function looks at another sixteenth of the k-mers first.
BITS = 4
FUNCTIONS = 1 << BITS
#: K-mers of a sixteenth that are listed, on average. Fewer than SELECTED turn up in
#: one of 10,000 cases, and then the function looks at all k-mers.
SHORTLIST = 12

# A k-mer and its place share 64 bits: 40 of hash, 24 of place.
_PLACE = 24
_PLACE_MASK = (1 << _PLACE) - 1
_REST = 64 - BITS
_REST_MASK = (1 << _REST) - 1
# Letters of scripts without blanks between words are units of their own.
_ALONE = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}])"


def _numbered_kmers(df: DataFrame, text: str, own: list[str]) -> DataFrame:
    """``df`` with the ascending occurrence-numbered k-mers of a text in ``_e``."""
    text = F.coalesce(F.col(text), F.lit(""))
    # Such a letter takes three bytes at least.
    spaced = F.when(
        F.octet_length(text) - F.length(text) > 1, F.regexp_replace(text, _ALONE, " $1 ")
    ).otherwise(text)
    units = F.transform(F.array_remove(F.split(spaced, r"\s+"), ""), lambda unit: F.xxhash64(unit))
    df = df.select(*own, units.alias("_u")).withColumn("_n", F.greatest(F.size("_u") - K + 1, F.lit(1)))
    shift = F.greatest(F.ceil(F.log2(F.col("_n") / float(1 << _PLACE))), F.lit(0)).cast("int")
    df = df.withColumn("_shift", shift)
    placed = F.transform(
        F.sequence(F.lit(0), F.col("_n") - 1),
        lambda i: F.xxhash64(*(F.get("_u", i + j) for j in range(K)))
        .bitwiseAND(F.lit(~_PLACE_MASK))
        .bitwiseOR(F.call_function("shiftright", i, F.col("_shift")).cast("long")),
    )
    placed = F.when(F.size("_u") > 0, placed).otherwise(F.array().cast("array<long>"))
    # Sorted, equal k-mers stand together in text order.
    df = df.withColumn("_s", F.sort_array(placed)).drop("_u", "_n", "_shift")
    kind = lambda i: F.shiftrightunsigned(F.get("_s", i), _PLACE)
    places = F.when(F.size("_s") > 1, F.sequence(F.lit(1), F.size("_s") - 1)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("_again", F.filter(places, lambda i: kind(i) == kind(i - 1)))
    # Where a k-mer repeats: the first place of every run of equal ones. It and the next
    # run's give each repeat its number; the first one keeps its hash.
    firsts = F.array_except(F.sequence(F.lit(0), F.size("_s") - 1), F.col("_again"))
    df = df.withColumn("_r", F.when(F.size("_again") > 0, firsts))
    numbered = F.transform(
        "_r",
        lambda start, at: F.transform(
            F.sequence(F.lit(0), F.coalesce(F.get("_r", at + 1), F.size("_s")) - start - 1),
            lambda number: F.when(number == 0, F.get("_s", start)).otherwise(
                F.xxhash64(kind(start), number)
                .bitwiseAND(F.lit(~_PLACE_MASK))
                .bitwiseOR(F.get("_s", start + number).bitwiseAND(F.lit(_PLACE_MASK)))
            ),
        ),
    )
    every = F.when(F.col("_r").isNull(), F.col("_s")).otherwise(F.sort_array(F.flatten(numbered)))
    return df.select(*own, every.alias("_e"))


def fingerprints(df: DataFrame, text: str, fingerprint: str) -> DataFrame:
    """``df`` with the tuples of the column ``text`` in ``fingerprint``, an array of
    ``FUNCTIONS`` 32-bit hashes.

    A hash function orders the k-mers by their hash with the function's mask applied,
    and the tuple is of its ``SELECTED`` smallest ones. Units are words between white
    space, and single letters of scripts without blanks. A text of fewer than ``K``
    units is one k-mer; one without units, NULL included, has the same fingerprint as
    any other such text. Texts with the same units have the same fingerprint. All
    happens inside the row. Beyond 16 million k-mers neighbouring places count as one.
    """
    own = [c for c in df.columns if c != fingerprint]
    df = _numbered_kmers(df, text, own)
    bin_of = lambda e: F.shiftrightunsigned(e, _REST)
    # The smallest of each sixteenth: below a bound that SHORTLIST of them keep on average.
    share = F.least(F.lit(1.0), FUNCTIONS * SHORTLIST / F.greatest(F.size("_e"), F.lit(1)))
    df = df.withColumn("_below", (share * float(1 << _REST)).cast("long"))
    listed = F.filter("_e", lambda e: e.bitwiseAND(F.lit(_REST_MASK)) < F.col("_below"))
    df = df.withColumn("_c", listed).drop("_below")
    # They are in order, so a sixteenth's smallest stand where it starts.
    places = F.when(F.size("_c") > 0, F.sequence(F.lit(0), F.size("_c") - 1)).otherwise(F.array().cast("array<int>"))
    starts = F.filter(places, lambda i: (i == 0) | (bin_of(F.get("_c", i)) != bin_of(F.get("_c", i - 1))))
    df = df.withColumn("_at", starts)
    df = df.withColumn("_bins", F.transform("_at", lambda i: bin_of(F.get("_c", i))))

    def in_text_order(selected: Column) -> Column:
        placed = F.transform(
            selected, lambda e: F.struct(e.bitwiseAND(F.lit(_PLACE_MASK)).alias("p"), e.alias("e"))
        )
        kinds = F.transform(F.sort_array(placed), lambda x: F.shiftrightunsigned(x["e"], _PLACE))
        return F.xxhash64(kinds).bitwiseAND(F.lit(0xFFFFFFFF))

    def smallest(function: Column) -> Column:
        # Unsigned order, by flipping the sign.
        mask = F.call_function("shiftleft", function, F.lit(_REST)).bitwiseXOR(F.lit(-(1 << 63)))
        ordered = F.transform("_e", lambda e: F.struct(e.bitwiseXOR(mask).alias("h"), e.alias("e")))
        return F.transform(F.slice(F.sort_array(ordered), 1, SELECTED), lambda x: x["e"])

    def tuple_hash(function: Column) -> Column:
        start = F.get("_at", (F.array_position("_bins", function) - 1).cast("int"))
        last = F.get("_c", start + SELECTED - 1)
        return F.when(
            F.array_contains("_bins", function) & F.coalesce(bin_of(last) == function, F.lit(False)),
            in_text_order(F.slice("_c", start + 1, SELECTED)),
        ).otherwise(in_text_order(smallest(function)))

    functions = F.sequence(F.lit(0).cast("long"), F.lit(FUNCTIONS - 1).cast("long"))
    return df.select(*own, F.transform(functions, tuple_hash).alias(fingerprint))


def as_text(fingerprint: Column) -> Column:
    """A fingerprint as hexadecimal digits, eight a hash."""
    return F.array_join(F.transform(fingerprint, lambda h: F.lpad(F.lower(F.hex(h)), 8, "0")), "")


def likeness(one: Column, two: Column) -> Column:
    """The share of equal hashes of two fingerprints."""
    equal = F.zip_with(one, two, lambda x, y: (x == y).cast("int"))
    return F.aggregate(equal, F.lit(0), lambda total, x: total + x) / F.lit(float(FUNCTIONS))


def with_next(
    documents: DataFrame, key: str, text: str, prepare: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``prepare(documents)`` with all columns but the key of the document that follows
    in descending ``key``, as ``next_<name>``; the first one follows the last.

    Rows without key come last, rows of one key in order of their texts. Keys are cut
    into ranges of about as many rows, each of which one task sorts: texts move once.
    Only the first row of each range is looked up again, for the last row of the
    range before it.
    """
    spark = documents.sparkSession
    n_ranges = min(10_000, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / n_ranges for i in range(1, n_ranges)]
    bounds = documents.agg(F.percentile_approx(key, shares, 20 * n_ranges)).first()[0]
    bounds = F.array(*(F.lit(b) for b in sorted(set(bounds or [])))).cast("array<long>")
    at = F.when(F.col(key).isNull(), F.lit(n_ranges)).otherwise(
        F.size(F.filter(bounds, lambda bound: bound > F.col(key)))
    )
    ranged = documents.withColumn("_range", at)
    # One row per range, of which there are at most 10,000.
    tops = materialise(ranged.groupBy("_range").agg(F.max(key).alias("_top")), "tops")
    in_order = Window.orderBy("_range")
    before = F.coalesce(F.lag("_range").over(in_order), F.max("_range").over(Window.partitionBy()))
    following = tops.select(before.alias("_before"), F.col("_range").alias("_range_"), "_top")
    heads = ranged.join(
        F.broadcast(following),
        (F.col("_range") == F.col("_range_")) & F.col(key).eqNullSafe(F.col("_top")),
    )
    heads = heads.groupBy("_before").agg(F.min(text).alias(text))
    firsts = prepare(materialise(heads, "heads"))
    columns = [c for c in firsts.columns if c != "_before"]
    firsts = firsts.select("_before", F.struct(*columns).alias("_first"))
    order = Window.partitionBy("_range").orderBy(F.desc_nulls_last(key), text)
    rows = prepare(ranged)
    rows = rows.withColumns(
        {**{f"next_{c}": F.lead(c).over(order) for c in columns}, "_more": F.lead(F.lit(1)).over(order)}
    )
    # Rows stay where the window left them: only the firsts move.
    rows = rows.join(firsts, (F.col("_range") == F.col("_before")) & F.col("_more").isNull(), "left")
    last = F.col("_more").isNull()
    return rows.select(
        key, *columns,
        *(F.when(last, F.col(f"_first.{c}")).otherwise(F.col(f"next_{c}")).alias(f"next_{c}") for c in columns),
    )


def with_edited(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next``
    for every row.

    The edited text is the own one with its last ``floor(n_chars / 2)`` letters
    replaced by as many first ones of the next document, or by all of it if that is
    shorter. NULL texts count as empty; a single document follows itself. Rows that
    repeat a key follow each other in order of their texts.
    """
    rows = documents.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = with_next(rows, "k", "t", lambda df: fingerprints(df, "t", "f"))
    half = F.floor(F.length("t") / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("t"), F.lit(1), F.length("t") - half), F.substring(F.col("next_t"), F.lit(1), half)
    )
    rows = rows.select("k", F.length("t").cast("long").alias("n_chars"), edited.alias("edited"), "f", "next_f")
    rows = fingerprints(rows, "edited", "g")
    return rows.select(
        F.col("k").alias(key),
        "n_chars",
        "edited",
        F.col("f").alias("fingerprint"),
        F.col("g").alias("edited_fingerprint"),
        likeness(F.col("f"), F.col("g")).alias("near_edited"),
        likeness(F.col("f"), F.col("next_f")).alias("near_next"),
    )
