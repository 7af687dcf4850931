"""BPE encoding and decoding with a pair occurrence index.

A task gathers the unknown pieces of a block of texts and lays their symbols side by side.
An index maps every pair that has a rank to all its positions. The lowest active rank
is taken, all its positions are merged at once, and only the lists of the pairs next
to them change; then the next rank follows, until no pair has one. Pieces in use are
remembered, and texts are put together from encoded pieces.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from rankdex.llm import tokens

# White space and the pieces of a text, as the vocabulary file has them.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
#: Text encoded at once, and chunks between white space in a generation of those that a
#: task remembers.
BLOCK_CHARS = 1 << 20
KNOWN_CHUNKS = 40_000
#: Chunks whose ids are put in place at once.
GATHERED_CHUNKS = 1 << 17

_NONE = np.int32(2**31 - 1)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: printable bytes for themselves, the
    others in order from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class Vocabulary:
    """A BPE vocabulary file: symbols, ranked merges and special tokens. Bounded by
    the file, so it travels with the tasks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        ids, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.width = 1 + max([*ids.values(), *self.special.values()])
        self.symbols = [b""] * self.width
        for symbol, i in [*ids.items(), *self.special.items()]:
            self.symbols[i] = symbol.encode()
        letters = _byte_letters()
        self.inner = np.array([ids.get(c, -1) for c in letters], np.int32)
        self.last = np.array([ids.get(c + suffix, -1) for c in letters], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        pairs = np.array([ids[a] * self.width + ids[b] for a, b in merges], np.int64)
        self.merged = np.array([ids[a + b] for a, b in merges], np.int32)
        self.rank_order = np.argsort(pairs, kind="stable").astype(np.int32)
        self.pairs = pairs[self.rank_order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.rank_order[at], _NONE)


def encode_pieces(pieces: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all pieces one after the other, and where each piece starts (one
    entry more than pieces). Pieces are not empty."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    at = np.concatenate([[0], np.cumsum(sizes)])
    content = np.frombuffer(b"".join(pieces), np.uint8)
    n = len(content)
    if not n:
        return np.zeros(0, np.int32), at
    symbol = vocabulary.inner[content]
    symbol[at[1:] - 1] = vocabulary.last[content[at[1:] - 1]]
    after = np.arange(1, n + 1, dtype=np.int32)
    after[at[1:] - 1] = -1
    before = np.arange(-1, n - 1, dtype=np.int32)
    before[at[:-1]] = -1
    alive = symbol >= 0  # a byte that the vocabulary lacks leaves no symbol
    for gone in np.flatnonzero(~alive):
        left, right = before[gone], after[gone]
        if left >= 0:
            after[left] = right
        if right >= 0:
            before[right] = left
    rank = np.full(n, _NONE)
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def note(where: np.ndarray) -> None:
        """Set the ranks of the pairs that start at ``where`` and index them."""
        paired = after[where] >= 0
        rank[where[~paired]] = _NONE
        where = where[paired]
        rank[where] = found = vocabulary.ranks(symbol[where], symbol[after[where]])
        ranked = found < _NONE
        where, found = where[ranked], found[ranked]
        order = np.argsort(found, kind="stable")
        where, found = where[order], found[order]
        cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
        if len(found):
            for r, group in zip(found[np.concatenate([[0], cuts])].tolist(), np.split(where, cuts)):
                if r in index:
                    index[r].append(group)
                else:
                    index[r] = [group]
                    heapq.heappush(active, r)

    note(np.flatnonzero(alive))
    while active:
        r = heapq.heappop(active)
        lists = index.pop(r)
        where = np.sort(np.concatenate(lists) if len(lists) > 1 else lists[0])
        where = where[alive[where] & (rank[where] == r)]
        if len(lists) > 1:
            where = where[np.concatenate([[True], where[1:] != where[:-1]])[: len(where)]]
        if len(where) > 1:
            # A symbol may end one pair and start the next: take every other of a run.
            joined = after[where[:-1]] == where[1:]
            if joined.any():
                first = np.concatenate([[True], ~joined])
                run = np.maximum.accumulate(np.where(first, np.arange(len(where)), 0))
                where = where[(np.arange(len(where)) - run) % 2 == 0]
        if not len(where):
            continue
        eaten = after[where]
        symbol[where] = vocabulary.merged[r]
        alive[eaten] = False
        rank[eaten] = _NONE
        right = after[eaten]
        after[where] = right
        before[right[right >= 0]] = where[right >= 0]
        left = before[where]
        other = left >= 0
        other[1:] &= left[1:] != where[:-1]
        note(np.concatenate([where, left[other]]))
    return symbol[alive], np.concatenate([[0], np.cumsum(alive)])[at]


class Encoder:
    """Encodes texts of one task. Chunks between white space, and the pieces that they
    consist of, are remembered in two generations: when the new one is full it becomes
    the old one, and what is met again moves into the new one. So words in use stay, and
    memory holds no more than both generations and one block."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        names = sorted(map(re.escape, vocabulary.special), key=len, reverse=True)
        self.special = re.compile(f"({'|'.join(names)})") if names else None

    def _normal(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        # Letter by letter: a word's last sigma is not told apart.
        return text.lower() if "Σ" not in text else "".join(c.lower() for c in text)

    def _recall(self, chunks: set[str]) -> set[str]:
        """Move what the old generation knows into the new one; the rest is returned."""
        chunks = chunks - self.known.keys()
        for chunk in chunks & self.older.keys():
            self.known[chunk] = self.older.pop(chunk)
        return chunks - self.known.keys()

    def _learn(self, chunks: set[str]) -> None:
        """Encode unknown chunks: their unknown pieces at once, in one index."""
        pieces_of = {c: _PIECES.findall(c) for c in chunks if not c.isalpha()}
        pieces = chunks - pieces_of.keys()
        for found in pieces_of.values():
            pieces.update(found)
        pieces = list(self._recall(pieces))
        ids, at = encode_pieces([p.encode() for p in pieces], self.vocabulary)
        content = ids.astype("<u4").tobytes()
        bounds = (at * 4).tolist()
        known = self.known
        for piece, start, end in zip(pieces, bounds, bounds[1:]):
            known[piece] = content[start:end]
        for chunk, found in pieces_of.items():
            known[chunk] = b"".join([known[p] for p in found])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed little-endian 32-bit ids of each text. Copies, as pyarrow never lets go
        of a memoryview that becomes part of an array, nor of the block behind it."""
        if len(self.known) > KNOWN_CHUNKS:
            self.known, self.older = {}, self.known
        # Texts without special tokens, that is nearly all, are one part.
        parts, ends, fixed = [], [], {}
        for text in texts:
            for part in self.special.split(text) if self.special and "<" in text else (text,):
                if part in self.vocabulary.special:
                    fixed[len(parts)] = self.vocabulary.special[part]
                    part = ""
                parts.append(self._normal(part))
            ends.append(len(parts))
        # White space beyond ASCII is in no piece, so it may stay within chunks.
        chunks = pc.ascii_split_whitespace(pa.array(parts, pa.large_string()))
        place = chunks.offsets.to_numpy()
        coded = chunks.flatten().dictionary_encode()
        which, words = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        self._learn(self._recall(set(words)))
        known = self.known
        packed = [known[word] for word in words]
        if fixed:
            # A special token's part is one empty chunk: let it stand for the token.
            which = which.copy()
            for part, token in fixed.items():
                which[place[part]] = len(packed)
                packed.append(token.to_bytes(4, "little"))
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        first = np.cumsum(sizes) - sizes
        ids = np.frombuffer(b"".join(packed), "<u4")
        after = np.concatenate([[0], np.cumsum(sizes[which])])
        out = np.empty(after[-1], "<u4")
        for at in range(0, len(which), GATHERED_CHUNKS):  # a long text has very many
            some = which[at : at + GATHERED_CHUNKS]
            counts, start = sizes[some], after[at]
            to = after[at + len(some)]
            shift = first[some] - (after[at : at + len(some)] - start)
            out[start:to] = ids[np.repeat(shift, counts) + np.arange(to - start)]
        content, bounds = memoryview(out.view(np.uint8)), (after[place[[0, *ends]]] * 4).tolist()
        return [bytes(content[start:end]) for start, end in zip(bounds, bounds[1:])]


def _blocks(column: pa.Array) -> Iterator[list[str]]:
    texts, held = [], 0
    for value in column:
        texts.append(text := value.as_py() or "")
        held += len(text)
        if held >= BLOCK_CHARS:
            yield texts
            texts, held = [], 0
    if texts:
        yield texts


def decode_ids(packed: bytes | pa.Buffer, symbols: list[bytes]) -> bytes:
    """The symbols of packed ids with a blank between them; ids beyond them are left out."""
    ids = np.frombuffer(packed, "<u4")
    if len(ids) and ids.max() >= len(symbols):
        ids = ids[ids < len(symbols)]
    return b" ".join(map(symbols.__getitem__, ids.tolist()))


def coded(
    batch: pa.RecordBatch, encoder: Encoder, symbols: list[bytes], decoded: bool
) -> Iterator[pa.RecordBatch]:
    """``k, n, ids`` and, if asked for, ``decoded`` of a batch of keys and texts, block by block."""
    at = 0
    for texts in _blocks(batch.column(1)):
        packed = encoder.encode(texts)
        columns = [
            batch.column(0).slice(at, len(texts)),
            pa.array([len(p) // 4 for p in packed], pa.int64()),
            pa.array(packed, pa.binary()),
        ]
        if decoded:
            columns.append(pa.array([decode_ids(p, symbols) for p in packed], pa.binary()).cast(pa.string()))
        yield pa.RecordBatch.from_arrays(columns, names=["k", "n", "ids", "decoded"][: len(columns)])
        at += len(texts)


def _run(
    documents: DataFrame, vocabulary_path: str, key: str, text: str, decoded: bool
) -> DataFrame:
    vocabulary = documents.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, symbols = Encoder(vocabulary.value), vocabulary.value.symbols
        for batch in batches:
            yield from coded(batch, encoder, symbols, decoded)
            tokens.release()
        del encoder
        tokens.release()

    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(F.col(key).alias("k"), F.col(text).alias("t"))
    out = rows.mapInArrow(run, f"k {kind}, n long, ids binary" + ", decoded string" * decoded)
    return out.withColumnsRenamed({"k": key, "n": "n_tokens", "ids": "token_ids"})


def encode(
    documents: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, n_tokens, token_ids`` for every row: the ids of the whole text as packed
    little-endian 32-bit integers, without truncation, padding or added tokens.

    Text is split at special tokens, which become their id; the rest is composed
    (NFC), lower-cased and cut into pieces. NULL, empty and blank texts have no
    tokens. Rows are independent: nothing is shuffled, and repeated rows and NULL
    keys stay as they are.
    """
    return _run(documents, vocabulary_path, key, text, decoded=False)


def round_trip(
    documents: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``key, n_tokens, token_ids, decoded``. A
    task then needs one Python worker for both."""
    return _run(documents, vocabulary_path, key, text, decoded=True)


def decode(
    encoded: DataFrame, vocabulary_path: str, token_ids: str = "token_ids", decoded: str = "decoded"
) -> DataFrame:
    """``encoded`` with the text of its packed ids: their symbols with a blank between
    them, as a vocabulary without a decoder prints them, special tokens included. No
    ids, or NULL, give empty text; an id beyond the vocabulary is left out."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary_path))

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        symbols = vocabulary.value.symbols
        for column in batches:
            texts = [decode_ids(p.as_buffer() if p.is_valid else b"", symbols) for p in column]
            yield pa.array(texts, pa.binary()).cast(pa.string())

    return encoded.withColumn(decoded, run(F.col(token_ids)))
