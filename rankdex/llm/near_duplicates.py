"""Near duplicates by chosen-path set similarity join over minwise tokens.

Every text is a set of word shingles. Equal sets are collapsed; what remains gets 64
minwise tokens. Independent trees branch the sets by selected tokens: sets that agree
on the tokens of a path share a node. Small nodes are compared exhaustively, larger
ones branch on. Nodes that a step does not shrink, as those of a large group of
near copies, are compared block by block between what is not linked yet. All links
are confirmed on the full sets, and their components are the classes.

Recall: a pair of similarity s agrees on a token with probability s. The first step of
a tree takes two tokens on four branches, each later one a single token on two
branches. At s = 0.8 a pair survives any number of steps of one tree with probability
0.97 or more, so three trees miss fewer than 1 in 10,000 pairs.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rankdex.llm import tokens
from rankdex.llm.components import components
from rankdex.scratch import materialise

TOKENS = 64
TREES = 3
#: Nodes of up to this many sets are compared exhaustively.
SMALL_NODE = 48
#: Agreeing 2-bit tokens of 64 from which a pair is a candidate. At similarity 0.8
#: their number has mean 54 and deviation 2.9.
LEAST_AGREEING = 43
#: From here on a pair is likely to be confirmed.
LIKELY_AGREEING = 52
#: Ids that may be broadcast, of 8 bytes each.
BROADCAST_IDS = 2_000_000
#: Sets in a block when the sets of nodes that do not shrink are compared.
BLOCK_ROWS = 500

_numbers = random.Random(11)
_XOR = np.array([_numbers.getrandbits(32) for _ in range(TOKENS)], np.uint32)[:, None]
_MUL = np.array([_numbers.getrandbits(32) | 1 for _ in range(TOKENS)], np.uint32)[:, None]


def minwise(shingles: np.ndarray) -> np.ndarray:
    """The minwise tokens of a non-empty set of 64-bit shingles."""
    high = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(TOKENS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(high), 4096):
        x = (high[None, at : at + 4096] ^ _XOR) * _MUL
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        x ^= x >> np.uint32(13)
        np.minimum(least, x.min(axis=1), out=least)
    return least


def _packed(bits: np.ndarray) -> int:
    return int(np.packbits(bits.astype(np.uint8)).view(">i8")[0])


def sketches(documents: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """``id, n, set_a, set_b, tokens, bits_a, bits_b`` per row: the size of the shingle
    set, two sums that stand for it, its minwise tokens, and their two lowest bits."""
    schema = "id long, n long, set_a long, set_b long, tokens binary, bits_a long, bits_b long"

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, signatures, bits = [], [], []
            for shingles in tokens.shingle_sets(batch.column(1), words):
                second = tokens.mix(shingles + np.uint64(0x9E3779B97F4A7C15))
                sums.append((len(shingles), shingles.sum(dtype=np.uint64), second.sum(dtype=np.uint64)))
                if len(shingles):
                    least = minwise(shingles)
                    signatures.append(least.tobytes())
                    bits.append((_packed(least & 1), _packed(least >> 1 & 1)))
                else:
                    signatures.append(None)
                    bits.append((0, 0))
            n, a, b = (np.array(x, np.uint64).view(np.int64) for x in zip(*sums)) if sums else ([],) * 3
            low, high = zip(*bits) if bits else ((), ())
            columns = [n, a, b, pa.array(signatures, pa.binary()), low, high]
            columns = [batch.column(0), *(pa.array(c, pa.int64()) if not isinstance(c, pa.Array) else c for c in columns)]
            names = ["id", "n", "set_a", "set_b", "tokens", "bits_a", "bits_b"]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            tokens.release()

    return documents.select(F.col(key).cast("long"), F.col(text)).mapInArrow(sketch, schema)


def _paths(level: int, known: list[list[int]]) -> list[list[int]]:
    """The token positions of every path of a level, given those of the level above:
    positions never repeat along a path."""
    if level == 1:
        found = []
        for tree in range(TREES):
            order = random.Random(100 + tree).sample(range(TOKENS), 8)
            found += [order[2 * branch : 2 * branch + 2] for branch in range(4)]
        return found
    found = []
    for path, positions in enumerate(known):
        rest = [p for p in range(TOKENS) if p not in positions]
        found += [[*positions, p] for p in random.Random(level * 1_000_003 + path).sample(rest, 2)]
    return found


def _token(position: Column | int) -> Column:
    at = position * 4 + 1 if isinstance(position, Column) else F.lit(position * 4 + 1)
    return F.substring(F.col("tokens"), at, F.lit(4))


def _agreeing(left: str, right: str) -> Column:
    differ = [F.col(f"{left}{b}").bitwiseXOR(F.col(f"{right}{b}")) for b in ("bits_a", "bits_b")]
    return F.lit(TOKENS) - F.bit_count(differ[0].bitwiseOR(differ[1]))


def _sizes_fit(left: str, right: str, percent: int) -> Column:
    a, b = F.col(f"{left}n"), F.col(f"{right}n")
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _pairs(left: Column, right: Column, likely: Column) -> list[Column]:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b"), likely.alias("likely")]


def _small_node_pairs(nodes: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs ``a, b, likely`` within each node, whose ``sets`` are at most
    ``SMALL_NODE``. Each set marks one pair, with the set of the smallest id that it
    is likely to be linked to, as likely."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            rows = lists.flatten()
            ids, n, bits_a, bits_b = (rows.field(i).to_numpy() for i in range(4))
            bits_a, bits_b = bits_a.view(np.uint64), bits_b.view(np.uint64)
            sizes = lists.value_lengths().to_numpy()
            node = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((ids, node))
            ids, n, bits_a, bits_b, node = (x[order] for x in (ids, n, bits_a, bits_b, node))
            found = []
            for step in range(1, int(sizes.max(initial=0))):
                same = np.flatnonzero(node[step:] == node[:-step])
                if not len(same):
                    break
                other = same + step
                differ = (bits_a[same] ^ bits_a[other]) | (bits_b[same] ^ bits_b[other])
                agreeing = TOKENS - np.bitwise_count(differ).astype(np.int64)
                fits = np.minimum(n[same], n[other]) * 100 >= np.maximum(n[same], n[other]) * percent
                ok = fits & (agreeing >= LEAST_AGREEING)
                found.append(np.stack([same[ok], other[ok], agreeing[ok]]))
            left, right, agreeing = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
            # Of each set's pairs with a smaller id, the first likely one, else the best.
            rank = np.lexsort((left, np.where(agreeing >= LIKELY_AGREEING, 0, TOKENS - agreeing), right))
            left, right = left[rank], right[rank]
            likely = np.ones(len(right), bool)
            likely[1:] = right[1:] != right[:-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[left]), pa.array(ids[right]), pa.array(likely)], names=["a", "b", "likely"]
            )
            tokens.release()

    return nodes.select("sets").mapInArrow(compare, "a long, b long, likely boolean")


def _candidates(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs ``a, b, likely`` from all trees, and the ``node, id`` of nodes
    that do not shrink.

    ``sets`` holds ``id, n, tokens, bits_a, bits_b`` once for each different set. A
    node that keeps more than half of the sets of the node above is branched no
    further; the caller compares what is left of it block by block.
    """
    pairs, stuck = [], []
    narrow = ["id", "n", "bits_a", "bits_b"]
    paths = _paths(1, [])
    starts = [
        F.struct(
            F.lit(i).alias("path"),
            F.xxhash64(F.lit(i), *(_token(p) for p in positions)).alias("node"),
        )
        for i, positions in enumerate(paths)
    ]
    total = sets.count()
    rows = sets.select(*narrow, F.explode(F.array(*starts)).alias("_at"))
    rows = rows.select(*narrow, "_at.path", "_at.node", F.lit(total).alias("above"))
    level = 1
    while True:
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.max("above").alias("above"))
        large = materialise(sizes.where(F.col("size") > SMALL_NODE), "large")
        n_large = large.count()
        few = n_large <= BROADCAST_IDS
        small = rows.join(F.broadcast(large) if few else large, "node", "left_anti")
        if not few:  # a plain shuffle join, which can split a large node, and a shuffle of what is left
            small = small.repartition("node")
        grouped = small.groupBy("node").agg(F.collect_list(F.struct(*narrow)).alias("sets"))
        pairs.append(materialise(_small_node_pairs(grouped.where(F.size("sets") > 1), percent), "pairs"))
        if not n_large:
            break
        known = large.select("node", "size", (F.col("size") * 2 > F.col("above")).alias("stuck"))
        opened = rows.drop("above").join(F.broadcast(known) if few else known, "node")
        opened = materialise(opened, "opened")
        row = F.struct(*narrow)
        leaders = opened.groupBy("node").agg(
            F.array(F.min(row), F.min(F.struct(F.xxhash64("id", "node"), row.alias("row")))["row"]).alias("_l")
        )
        leaders = leaders.select("node", F.explode(F.array_distinct("_l")).alias("_l")).select(
            "node", *(F.col(f"_l.{c}").alias(f"leader_{c}") for c in narrow)
        )
        leaders = materialise(leaders, "leaders")
        likely = _agreeing("", "leader_") >= LEAST_AGREEING
        near = opened.join(leaders, "node").where(
            (F.col("id") != F.col("leader_id")) & likely & _sizes_fit("", "leader_", percent)
        )
        pairs.append(near.select(*_pairs(F.col("id"), F.col("leader_id"), F.lit(True))))
        stuck.append(opened.where("stuck").select("node", "id"))
        on = opened.where(~F.col("stuck")).select("node", "path", "id", F.col("size").alias("above"))
        level += 1
        paths = _paths(level, paths)
        if level > TOKENS // 2 or on.isEmpty():
            break
        position = F.array(*(F.lit(p[-1]).cast("int") for p in paths))
        children = F.array(*(F.col("path") * 2 + F.lit(branch) for branch in (0, 1)))
        on = on.withColumn("path", F.explode(children)).join(sets, "id")
        rows = materialise(
            on.select(
                *narrow, "path", "above",
                F.xxhash64("node", "path", _token(F.get(position, F.col("path")))).alias("node"),
            ),
            "branches",
        )
    found = pairs[0]
    for more in pairs[1:]:
        found = found.unionAll(more)
    found = found.groupBy("a", "b").agg(F.max("likely").alias("likely"))
    left = stuck[0] if stuck else None
    for more in stuck[1:]:
        left = left.unionAll(more)
    return materialise(found, "candidates"), left


def _shingle_sets(
    ids: DataFrame, documents: DataFrame, key: str, text: str, words: int
) -> DataFrame:
    """``id, shingles`` of the texts that ``ids`` names; only those are read into sets."""
    ids = materialise(ids.distinct(), "ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    named = documents.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    named = named.join(ids, "id", "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s.tobytes() for s in tokens.shingle_sets(batch.column(1), words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["id", "shingles"])
            tokens.release()

    return materialise(named.select("id", "text").mapInArrow(sets, "id long, shingles binary"), "sets")


def _confirmed(
    pairs: DataFrame, documents: DataFrame, key: str, text: str, words: int, percent: int
) -> DataFrame:
    """The pairs ``a, b`` of ids whose full shingle sets are similar enough."""
    ids = pairs.select(F.col("a").alias("id")).unionAll(pairs.select("b"))
    full = _shingle_sets(ids, documents, key, text, words)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (one, two))
                both = np.concatenate([x, y])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(both) - shared))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
            tokens.release()

    joined = pairs.select("a", "b")
    for end in ("a", "b"):
        joined = joined.join(full.select(F.col("id").alias(end), F.col("shingles").alias(f"{end}_set")), end)
    links = joined.select("a", "b", "a_set", "b_set").mapInArrow(compare, "a long, b long")
    return materialise(links.distinct(), "links")


def _apart(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose ends are not in the same class yet."""
    for end in ("a", "b"):
        own = classes.select(F.col("id").alias(end), F.col("component").alias(f"_{end}"))
        pairs = pairs.join(own, end, "left")
    a, b = F.coalesce("_a", "a"), F.coalesce("_b", "b")
    return pairs.where(a != b).select("a", "b")


def _joined_up(classes: DataFrame, links: DataFrame) -> DataFrame:
    """The classes after more links."""
    stars = classes.select(F.col("id").alias("a"), F.col("component").alias("b"))
    return materialise(components(stars.unionAll(links)), "classes")


def _block_links(
    stuck: DataFrame, classes: DataFrame, documents: DataFrame, key: str, text: str, words: int, percent: int
) -> DataFrame:
    """Links ``a, b`` between different classes within the nodes that do not shrink.

    Most sets of such a node are in one class by now. Nodes of the same largest class
    are taken together; the sets outside of that class meet all sets, in blocks of
    ``BLOCK_ROWS``, on their full shingles. A set gets one link to each class that it
    is linked to in a block, so a large group sends no more than its classes.
    """
    own = classes.select("id", F.col("component").alias("class"))
    rows = stuck.select("node", "id").join(own, "id", "left").withColumn("class", F.coalesce("class", "id"))
    rows = materialise(rows, "stuck")
    per_class = rows.groupBy("node", "class").agg(F.count(F.lit(1)).alias("_n"))
    main = per_class.groupBy("node").agg(
        F.max(F.struct("_n", "class"))["class"].alias("main"), F.count(F.lit(1)).alias("_classes")
    )
    main = materialise(main.where("_classes > 1").drop("_classes"), "main")
    rows = materialise(rows.join(main, "node").select("main", "id", "class").distinct(), "groups")
    outside = F.col("class") != F.col("main")
    sizes = rows.groupBy("main").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("blocks"),
        F.ceil(F.count(F.when(outside, 1)) / BLOCK_ROWS).alias("asking_blocks"),
    )
    full = _shingle_sets(rows.select("id"), documents, key, text, words)
    rows = rows.join(full.distinct(), "id").join(materialise(sizes, "sizes"), "main")
    spread = lambda n: F.pmod(F.xxhash64("id"), n)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    asked = rows.withColumns({"at": spread(F.col("blocks"))}).withColumn("by", every(F.col("asking_blocks")))
    asking = rows.where(outside).withColumns({"by": spread(F.col("asking_blocks"))})
    asking = asking.withColumn("at", every(F.col("blocks")))
    columns = ["main", "at", "by", "id", "class", "shingles"]
    both = asked.select(*columns, F.lit(False).alias("asks")).unionAll(asking.select(*columns, F.lit(True).alias("asks")))

    def compare(block: pa.Table) -> pa.Table:
        asks = block.column("asks").to_numpy()
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in block.column("shingles")]
        ids, groups = block.column("id").to_numpy(), block.column("class").to_numpy()
        members = np.flatnonzero(~asks)
        found: list[tuple[int, int]] = []
        if len(members):
            content = np.concatenate([sets[m] for m in members])
            sizes = np.array([len(sets[m]) for m in members])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            for one in np.flatnonzero(asks):
                own_set = sets[one]
                at = np.minimum(np.searchsorted(own_set, content), len(own_set) - 1)
                shared = np.add.reduceat((own_set[at] == content).astype(np.int64), starts)
                near = 100 * shared >= percent * (len(own_set) + sizes - shared)
                near &= groups[members] != groups[one]
                _, first = np.unique(groups[members[near]], return_index=True)
                found += [(ids[one], ids[members[near][f]]) for f in first]
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return materialise(both.groupBy("main", "at", "by").applyInArrow(compare, "a long, b long"), "links")


def near_duplicates(
    documents: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """``key, n_shingles, component_id, kept`` for every row.

    ``n_shingles`` is the size of the set of distinct ``words``-word shingles (A-Z
    lower-cased, words between ASCII white space; a shorter text is one shingle).
    Texts are linked if ``100 * shared >= percent * all`` shingles, confirmed on full
    sets; ``component_id`` is the smallest id that can be reached, and ``kept`` says
    that it is the row's own.

    Texts without words, NULL texts included, are linked with nothing. Equal sets are
    linked without any search. Rows that repeat an id count as one document, kept or
    not together. A row without id has no component, is linked with nothing and kept.
    Other columns are not read.
    """
    every = materialise(sketches(documents, key, text, words), "sketches")
    same = ["set_a", "set_b", "n"]
    sets = every.where("n > 0 and id is not null").groupBy(*same).agg(
        F.min(F.struct("id", "tokens", "bits_a", "bits_b")).alias("_first")
    )
    sets = materialise(sets.select(*same, "_first.*"), "different")
    pairs, stuck = _candidates(sets.select("id", "n", "tokens", "bits_a", "bits_b"), percent)
    confirm = lambda p: _confirmed(p, documents, key, text, words, percent)
    links = confirm(pairs.where("likely"))
    classes = materialise(components(links), "classes")
    links = confirm(materialise(_apart(pairs.where(~F.col("likely")), classes), "rest"))
    classes = _joined_up(classes, links)
    if stuck is not None:
        links = _block_links(stuck, classes, documents, key, text, words, percent)
        classes = _joined_up(classes, links)
    first = sets.select(*same, F.col("id").alias("_first"))
    own = classes.select(F.col("id").alias("_first"), F.col("component").alias("_class"))
    joined = every.select("id", *same).join(first, same, "left").join(own, "_first", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("_class", "_first", "id"))
    return joined.select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def one_of_each(
    documents: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """The rows that ``near_duplicates`` keeps, with all their columns: of every class
    the one with the smallest id. Rows without id, or without words, all stay."""
    gone = near_duplicates(documents, key, text, words, percent).where(~F.col("kept"))
    gone = materialise(gone.select(F.col(key).alias("_gone")).distinct(), "gone")
    few = gone.count() <= BROADCAST_IDS
    rows = documents.select(F.struct("*").alias("_doc"))
    rows = rows.join(F.broadcast(gone) if few else gone, F.col(f"_doc.{key}") == F.col("_gone"), "left_anti")
    return rows.select("_doc.*")
