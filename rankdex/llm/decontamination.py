"""Benchmark passages in documents, by SimHash windows, in DataFrame functions.

Documents and items are sequences of words (runs of letters and digits, lower-cased)
and are compared by five-word shingles, counted with their repeats. A window is as
long as an item. It starts where one of the item's shingles puts it, or between two
such starts less than two lengths apart: a window outside of all starts that its common
shingles give can be shifted to the nearest one and lose no common shingle. Windows
with too few shingles of any item of their length to be similar are left out before
they are opened. Windows and items get 64-bit SimHash fingerprints. Eight blocks of eight bits index the items: fingerprints
within 23 bits of each other differ by at most two bits in some block, so looking up
every block within two bits finds them all. A pair of similarity 0.8 is 9.7 bits apart
on average, with a deviation of 2.9. Candidates are verified by the exact weighted
Jaccard similarity of their shingles.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from rankdex.scratch import materialise

WORDS = 5
SIMILARITY = 0.8
BLOCKS, BLOCK_BITS = 8, 8
#: Bits in which a block may differ, and what a lookup of all blocks is sure to find.
BLOCK_RADIUS = 2
RADIUS = (BLOCK_RADIUS + 1) * BLOCKS - 1
#: Items that may be broadcast, at 296 lookups each, their shingles, and shingle places.
BROADCAST_ITEMS = 4_000
BROADCAST_SHINGLES = 2_000_000
BROADCAST_PLACES = 2_000_000


def word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda word: F.xxhash64(word))


def shingles(hashes: str, width: int) -> Column:
    """Hashes of all runs of ``width`` words of an array column, in order."""
    one = lambda i: F.xxhash64(F.lit(width), *(F.get(hashes, i + j) for j in range(width)))
    last = F.size(hashes) - width
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), one)).otherwise(
        F.array().cast("array<long>")
    )


def simhash(column: str) -> Column:
    """The 64-bit SimHash of an array of hashes: a bit is set where more than half of
    them have it, repeats counted."""
    return F.expr(
        f"""aggregate(sequence(0, 63), 0L, (found, b) -> found |
            if(2 * size(filter({column}, x -> (shiftrightunsigned(x, b) & 1L) = 1L)) > size({column}),
                shiftleft(1L, b), 0L))"""
    )


def weighted_jaccard(one: str, two: str) -> Column:
    """Similarity of two arrays as bags: shared repeats over all repeats."""
    return F.expr(
        f"""aggregate(array_intersect({one}, {two}), 0, (n, x) -> n + least(
            size(filter({one}, y -> y = x)), size(filter({two}, y -> y = x))),
            n -> n / cast(size({one}) + size({two}) - n as double))"""
    )


def _block(fingerprint: Column, block: int) -> Column:
    return F.shiftrightunsigned(fingerprint, block * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def _lookups(fingerprint: Column, bits: int) -> Column:
    """``block, value`` pairs of a fingerprint, with all values within ``bits`` of each
    block."""
    flips = [sum(1 << b for b in flip) for n in range(bits + 1) for flip in combinations(range(BLOCK_BITS), n)]
    masks = F.array(*(F.lit(flip).cast("long") for flip in flips))
    pairs = []
    for block in range(BLOCKS):
        value = _block(fingerprint, block)
        near = lambda mask: F.struct(F.lit(block).alias("block"), value.bitwiseXOR(mask).alias("value"))  # noqa: B023, E731
        pairs.append(F.transform(masks, near))
    return F.explode(F.flatten(F.array(*pairs)))


def _starts(similarity: float) -> Column:
    """The starts of all windows that can be similar, of one document and item length.

    ``starts`` are those that a common shingle puts exactly, ``ats`` the places in the
    document of shingles that any item of ``item_len`` words has, both ascending.
    """
    size = F.least("item_len", "n")
    width = F.least(F.col("item_len"), F.lit(WORDS))
    both = size + F.col("item_len") - 2 * width + 2
    # So many shingles are shared at least; windows hold them where so many places lie
    # within one window's reach.
    need = F.greatest(F.lit(1), F.ceil(both * (similarity / (1 + similarity)) - 1e-6).cast("int"))

    def span(i: Column) -> Column:
        low = F.greatest(F.lit(0), F.get("ats", i + need - 1) - (size - width))
        high = F.least(F.get("ats", i), F.col("n") - size)
        # Spans follow each other: each one without what the one before has.
        low = F.when(i > 0, F.greatest(low, F.get("ats", i - 1) + 1)).otherwise(low)
        return F.struct(low.alias("low"), high.alias("high"))

    def gap(start: Column, i: Column) -> Column:
        after = F.get("starts", i + 1)
        return F.sequence(start, F.when(after - start < 2 * F.col("item_len"), after - 1).otherwise(start))

    enough = F.transform(F.sequence(F.lit(0), F.size("ats") - need), span)
    enough = F.filter(enough, lambda x: x["low"] <= x["high"])
    enough = F.flatten(F.transform(enough, lambda x: F.sequence(x["low"], x["high"])))
    near = F.flatten(F.transform("starts", gap))
    return F.when(F.size("ats") >= need, F.array_intersect(enough, near)).otherwise(F.array().cast("array<int>"))


def benchmark_items(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """``entry, item, len, width, shingles, fingerprint`` of each item that has words.
    ``entry`` is a hash of the id and the words, as ids may repeat or be NULL. An item
    of fewer than five words is one shingle."""
    rows = benchmark.select(F.col(item).alias("item"), word_hashes(F.col(text)).alias("words")).where(F.size("words") > 0)
    rows = rows.distinct().withColumns({"entry": F.xxhash64("item", "words"), "len": F.size("words"), "width": F.least(F.size("words"), F.lit(WORDS))})
    of_width = F.coalesce(*(F.when(F.col("width") == w, shingles("words", w)) for w in range(1, WORDS + 1)))
    rows = rows.withColumn("shingles", of_width).drop("words")
    return materialise(rows.withColumn("fingerprint", simhash("shingles")), "items")


def contaminated(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY,
) -> DataFrame:
    """``key, item, similarity, start_word, n_words, row``: every item found in a
    document, with the window that is most like it (the first of equals that were
    opened). ``row`` identifies the document by its key and text where keys repeat or are NULL.

    Whole texts are looked at, and windows as long as the item (a shorter text as a
    whole). NULL and empty texts, on either side, match nothing. Rows that repeat key
    and text are reported once; items that repeat an id and its words once, other
    items with equal texts each, also those without id. The short lists of items and of
    their shingles are counted, and broadcast up to a bound; beyond it they are joined
    by a shuffle. A shingle or item found in a third of all documents then meets a
    single row, and only matching windows travel on.
    """
    items = benchmark_items(benchmark, item, item_text)
    widths = sorted(row[0] for row in items.select("width").distinct().collect())  # 1 to 5
    n_items, n_shingles = items.agg(F.count(F.lit(1)), F.sum(F.size("shingles"))).first()
    few_items = n_items <= BROADCAST_ITEMS and (n_shingles or 0) <= BROADCAST_SHINGLES
    placed = F.posexplode("shingles").alias("offset", "shingle")
    places = materialise(items.select(F.col("len").alias("item_len"), placed).distinct(), "places")
    if places.count() <= BROADCAST_PLACES:
        places = F.broadcast(places)
    rows = documents.select(
        F.col(key).alias("key"), F.xxhash64(key, text).alias("row"), word_hashes(F.col(text)).alias("words")
    )
    found = None
    for width in widths:
        hits = rows.select(
            "key", "row", F.size("words").alias("n"), F.posexplode(shingles("words", width)).alias("at", "shingle")
        ).join(places, "shingle")
        length = F.least("item_len", "n")
        start = F.greatest(F.lit(0), F.least(F.col("at") - F.col("offset"), F.col("n") - length))
        windows = hits.select("key", "row", "n", "item_len", "at", start.alias("start"))
        found = windows if found is None else found.unionAll(windows)
    names = [F.col(c) for c in ("key", "row", "item")]
    if found is None:
        empty = documents.join(benchmark.select(F.col(item).alias("item")), F.lit(False))
        return empty.select(
            F.col(key), F.col("item").alias(item), F.lit(0.0).alias("similarity"), F.lit(0).alias("start_word"),
            F.lit(0).alias("n_words"), F.lit(0).cast("long").alias("row"),
        )
    placed = found.groupBy("row", "key", "n", "item_len").agg(
        F.sort_array(F.collect_set("at")).alias("ats"), F.sort_array(F.collect_set("start")).alias("starts")
    )
    placed = placed.withColumn("open", _starts(similarity)).where(F.size("open") > 0)
    window = lambda start: F.struct(start.alias("start"), F.least("item_len", "n").alias("len"), "item_len")
    placed = placed.select("row", "key", F.transform("open", window).alias("windows"))
    per_document = materialise(
        placed.groupBy("row", "key").agg(F.flatten(F.collect_list("windows")).alias("windows")), "windows"
    )
    # Only documents with a window are read again for its words.
    joined = rows.join(
        per_document.withColumnsRenamed({"row": "row_", "key": "key_"}),
        (F.col("row") == F.col("row_")) & F.col("key").eqNullSafe(F.col("key_")),
    )
    opened = joined.select("key", "row", "words", F.explode("windows").alias("w"))
    opened = opened.select(
        "key", "row", "w.start", "w.len", "w.item_len",
        F.slice(F.col("words"), F.col("w.start") + 1, F.col("w.len")).alias("words"),
    )
    parts = [
        opened.where(F.least(F.col("item_len"), F.lit(WORDS)) == w)
        .select("key", "row", "start", "len", "item_len", F.lit(w).alias("width"), shingles("words", w).alias("shingles"))
        for w in widths
    ]
    windows = parts[0]
    for part in parts[1:]:
        windows = windows.unionAll(part)
    windows = windows.where(F.size("shingles") > 0).withColumn("fingerprint", simhash("shingles"))
    windows = materialise(windows.distinct(), "fingerprints")
    place = ["row", "start", "len", "item_len", "width"]
    asked = windows.select("key", *place, "fingerprint", _lookups(F.col("fingerprint"), 0).alias("at"))
    index = items.select(
        "entry", F.col("width").alias("own_width"), F.col("len").alias("own_len"),
        F.col("fingerprint").alias("item_print"), _lookups(F.col("fingerprint"), BLOCK_RADIUS).alias("item_at"),
    )
    near = asked.join(
        F.broadcast(index) if few_items else index,
        (F.col("at.block") == F.col("item_at.block"))
        & (F.col("at.value") == F.col("item_at.value"))
        & (F.col("width") == F.col("own_width"))
        & (F.col("item_len") == F.col("own_len"))
        & (F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print"))) <= RADIUS),
    )
    near = materialise(near.select("key", *place, "entry").distinct(), "candidates")
    own = windows.select(*place, F.col("key").alias("key_"), "shingles")
    compared = near.join(own, place).where(F.col("key").eqNullSafe(F.col("key_"))).drop("key_")
    theirs = items.select("entry", "item", F.col("shingles").alias("theirs"))
    compared = compared.join(F.broadcast(theirs) if few_items else theirs, "entry")
    compared = compared.withColumn("similarity", weighted_jaccard("shingles", "theirs"))
    compared = compared.where(F.col("similarity") >= similarity)
    best = F.max_by(F.struct("similarity", "start", "len"), F.struct("similarity", -F.col("start"), -F.col("len")))
    return (
        compared.groupBy(*names)
        .agg(best.alias("best"))
        .select(
            F.col("key").alias(key), F.col("item").alias(item), "best.similarity",
            F.col("best.start").alias("start_word"), F.col("best.len").alias("n_words"), "row",
        )
    )


def without_contaminated(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    found = contaminated(documents, benchmark, key, text, **options)
    found = materialise(found.select("row", F.col(key).alias("_key")).distinct(), "contaminated")
    rows = documents.select(F.struct("*").alias("_doc"), F.xxhash64(key, text).alias("_row"))
    clean = rows.join(
        found, (rows["_row"] == found["row"]) & F.col(f"_doc.{key}").eqNullSafe(found["_key"]), "left_anti"
    )
    return clean.select("_doc.*")
