"""SimHash near duplicates by segment counts.

A text's fingerprint has 64 bits, each of which is set where more than half of its
shingle hashes have it. Fingerprints are embedded by the bit counts of their 32
segments of two bits. The Manhattan distance of two embeddings is never more than the
number of differing bits. So of two fingerprints within three bits, one half of the
embeddings is within a distance of one: a grid with a cell for every value of a half is
joined with each fingerprint's own cell and those one step up in one segment, and what
meets is verified on all bits. Two random halves are that near with probability 3.4e-6.

Cells of more than ``DENSE`` different fingerprints, as large groups of near copies
make, are taken apart: fingerprints link to a few leaders of their cell first, and then
only those outside of a cell's largest component meet all others, block by block.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from rankdex.llm import tokens
from rankdex.llm.components import components
from rankdex.scratch import materialise

WORDS = 3
SEED = 42
#: Fingerprints link where at most so many bits differ. Two halves leave one of them with
#: one at most, which is what the grid looks up.
RADIUS = 3
#: Fingerprints of a cell from which on it is taken apart; leaders it gets; rows that are
#: compared with each other at once.
DENSE = 64
LEADERS = 8
BLOCK_ROWS = 4096
#: Cells that may be broadcast, of 8 bytes each.
BROADCAST_CELLS = 1_000_000
#: Bytes of text that are split into words at once.
BLOCK_BYTES = 1 << 20

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = re.compile(rb"[\x09-\x0d\x20]")


def shingle_hashes(content: memoryview, words: int) -> Iterator[np.ndarray]:
    """XXH64 of all shingles of a text, repeats included, block by block: runs of
    ``words`` words (A-Z as a-z, between ASCII white space) joined by one blank, or the
    whole sequence where there are fewer."""
    digest, join, held, at, any_yet = xxhash.xxh64_intdigest, b" ".join, [], 0, False
    while at < len(content):
        cut = _SPACE.search(content, at + BLOCK_BYTES)
        to = cut.end() if cut else len(content)
        held += bytes(content[at:to]).translate(_LOWER).split()
        at = to
        if len(held) >= words:
            any_yet = True
            runs = zip(*(held[i:] for i in range(words)))
            yield np.array([digest(join(run), SEED) for run in runs], np.uint64)
            held = held[len(held) - words + 1 :]
    if held and not any_yet:
        yield np.array([digest(join(held), SEED)], np.uint64)


def simhash(content: memoryview, words: int) -> int:
    """The fingerprint of a text; 0 without words."""
    total, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(content, words):
        for at in range(0, len(hashes), 1 << 14):
            some = hashes[at : at + (1 << 14)].astype("<u8")
            bits = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * total > n, bitorder="little").view("<i8")[0])


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """``key, fingerprint`` of every row, the fingerprint as a signed 64-bit number. Texts
    without words, NULL texts included, have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1).cast(pa.large_binary())
            found = [simhash(memoryview(v.as_buffer()), words) if v.is_valid else 0 for v in column]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["k", "f"])
            tokens.release()

    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return rows.mapInArrow(run, f"k {kind}, f long").withColumnsRenamed({"k": key, "f": "fingerprint"})


def as_text(fingerprint: Column) -> Column:
    """Sixteen lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def differing(one: Column, two: Column) -> Column:
    return F.bit_count(one.bitwiseXOR(two))


def _cells(fingerprint: Column) -> list[Column]:
    """The cell of each half: its number above the counts of its 16 two-bit segments, two
    bits each."""
    cells = []
    for half in (0, 1):
        bits = F.shiftrightunsigned(fingerprint, 32 * half).bitwiseAND(F.lit(0xFFFFFFFF))
        # Of two bits xy, the count is the number xy less x.
        counts = bits - F.shiftrightunsigned(bits, 1).bitwiseAND(F.lit(0x55555555))
        cells.append(counts + F.lit(half << 32))
    return cells


def _around(cell: Column, up: bool = True, down: bool = False) -> Column:
    """A cell and those one step away in one segment, as an array with gaps (NULL)."""
    found = [cell]
    for segment in range(16):
        low, high = 1 << 2 * segment, 2 << 2 * segment
        count = cell.bitwiseAND(F.lit(low | high))
        if up:
            found.append(F.when(count != high, cell + F.lit(low)))
        if down:
            found.append(F.when(count != 0, cell - F.lit(low)))
    return F.array(*found)


def _small(cells: DataFrame) -> DataFrame:
    """Cells for a join, broadcast where there are few enough."""
    return F.broadcast(cells) if cells.count() <= BROADCAST_CELLS else cells


def _grid_links(members: DataFrame, dense: DataFrame, any_dense: bool) -> DataFrame:
    """Links ``a, b`` of fingerprints, neither of them in a dense cell, from the range join
    over the grid. ``members`` holds ``fingerprint, cell`` for either half. A cell holds
    at most ``DENSE`` fingerprints here and is asked by 17 times as many."""
    rows = members.join(_small(dense), "cell", "left_anti") if any_dense else members
    own = rows.select("cell", F.col("fingerprint").alias("a"))
    asking = rows.select(
        F.explode(_around(F.col("cell"))).alias("at"), F.col("cell").alias("from"), F.col("fingerprint").alias("b")
    ).where("at is not null")
    met = own.join(asking, own["cell"] == asking["at"])
    near = differing(F.col("a"), F.col("b")) <= RADIUS
    return met.where(near & ((F.col("from") != F.col("cell")) | (F.col("a") < F.col("b")))).select("a", "b")


def _dense_members(members: DataFrame, dense: DataFrame) -> DataFrame:
    """``group, fingerprint``: each dense cell with the fingerprints in and around it."""
    around = dense.select(F.col("cell").alias("group"), F.explode(_around(F.col("cell"), down=True)).alias("cell"))
    around = materialise(around.where("cell is not null"), "around")
    return materialise(members.join(_small(around), "cell").select("group", "fingerprint"), "dense")


def _leader_links(members: DataFrame, dense: DataFrame, groups: DataFrame) -> DataFrame:
    """Links of fingerprints to those of the leaders of their group that are near."""
    of_cell = members.join(_small(dense), "cell", "left_semi").groupBy(F.col("cell").alias("group"))
    pick = lambda i: F.min(F.struct(F.xxhash64("fingerprint", F.lit(i)), F.col("fingerprint").alias("f")))["f"]
    leaders = of_cell.agg(F.array_distinct(F.array(*(pick(i) for i in range(LEADERS)))).alias("leaders"))
    leaders = materialise(leaders, "leaders")
    near = F.filter("leaders", lambda x: (differing(x, F.col("fingerprint")) <= RADIUS) & (x != F.col("fingerprint")))
    met = groups.join(_small(leaders), "group")
    return met.select(F.col("fingerprint").alias("a"), F.explode(near).alias("b"))


def _block_links(groups: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between different classes within dense groups. Fingerprints outside of a
    group's largest class meet all of the group, in blocks of ``BLOCK_ROWS``; a block
    sends one link less than it joins classes."""
    own = classes.select(F.col("id").alias("fingerprint"), F.col("component").alias("class"))
    rows = groups.join(own, "fingerprint", "left").withColumn("class", F.coalesce("class", "fingerprint"))
    rows = materialise(rows.select("group", "fingerprint", "class"), "classed")
    sizes = rows.groupBy("group", "class").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("group").agg(
        F.max(F.struct("n", "class")).alias("main"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("classes")
    )
    main = main.where("classes > 1").select(
        "group",
        F.col("main.class").alias("main"),
        F.ceil(F.col("n") / BLOCK_ROWS).alias("blocks"),
        F.ceil((F.col("n") - F.col("main.n")) / BLOCK_ROWS).alias("asking_blocks"),
    )
    rows = rows.join(_small(materialise(main, "main")), "group")
    spread = lambda n: F.pmod(F.xxhash64("fingerprint"), n)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    asked = rows.withColumn("at", spread(F.col("blocks"))).withColumn("by", every(F.col("asking_blocks")))
    asking = rows.where("class != main").withColumn("by", spread(F.col("asking_blocks")))
    asking = asking.withColumn("at", every(F.col("blocks")))
    columns = ["group", "at", "by", "fingerprint", "class"]
    both = asked.select(*columns, F.lit(False).alias("asks")).unionAll(asking.select(*columns, F.lit(True).alias("asks")))

    def compare(block: pa.Table) -> pa.Table:
        asks = block.column("asks").to_numpy()
        prints = block.column("fingerprint").to_numpy()
        _, label = np.unique(block.column("class").to_numpy(), return_inverse=True)
        members, bits = np.flatnonzero(~asks), prints.view(np.uint64)
        found: list[tuple[int, int]] = []
        for one in np.flatnonzero(asks):
            near = members[np.bitwise_count(bits[members] ^ bits[one]) <= RADIUS]
            # Labels are those of classes that are joined so far.
            labels, first = np.unique(label[near], return_index=True)
            for other, at in zip(labels.tolist(), first.tolist()):
                if other != label[one]:
                    found.append((prints[one], prints[near[at]]))
                    label[label == other] = label[one]
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return both.groupBy("group", "at", "by").applyInArrow(compare, "a long, b long")


def linked(prints: DataFrame) -> DataFrame:
    """``id, component`` of all different 64-bit numbers in column ``fingerprint`` that
    have another one within ``RADIUS`` bits: the smallest number that can be reached."""
    each = F.explode(F.array(*_cells(F.col("fingerprint")))).alias("cell")
    members = prints.select("fingerprint", each)
    dense = members.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > DENSE).select("cell")
    dense = materialise(dense, "dense")
    any_dense = not dense.isEmpty()
    links = _grid_links(members, dense, any_dense)
    if not any_dense:
        return components(links)
    groups = _dense_members(members, dense)
    links = materialise(links.unionAll(_leader_links(members, dense, groups)).distinct(), "links")
    classes = materialise(components(links), "classes")
    more = _block_links(groups, classes)
    stars = classes.select(F.col("id").alias("a"), F.col("component").alias("b"))
    return components(stars.unionAll(more))


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """``key, fingerprint, component_id`` for every row.

    Fingerprints of at most ``RADIUS`` differing bits are linked; ``component_id`` is the
    smallest key that can be reached from a row's fingerprint, its own included. Every
    row is judged by its own fingerprint, also where rows repeat a key. Texts without
    words, NULL texts included, have fingerprint 0, which is linked like any other. Keys
    are numbers or text; a row without key takes the smallest key of its component, NULL
    where there is none. Other columns are not read.
    """
    every = materialise(fingerprints(documents, key, text, words), "fingerprints")
    prints = materialise(every.groupBy("fingerprint").agg(F.min(key).alias("first")), "different")
    classes = materialise(linked(prints.select("fingerprint")), "classes")
    named = prints.join(classes, prints["fingerprint"] == classes["id"], "left")
    named = named.select("fingerprint", "first", F.coalesce("component", "fingerprint").alias("component"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    of_print = materialise(named.join(least, "component").select("fingerprint", "component_id"), "components")
    return every.join(of_print, "fingerprint").select(key, "fingerprint", "component_id")
