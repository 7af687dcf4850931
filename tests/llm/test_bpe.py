import gc
import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from rankdex.llm import bpe
from rankdex.llm.queries import op5_bpe_round_trip, word_vocabulary

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(word_vocabulary())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(word_vocabulary())


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


ODD = [
    "", " ", "\n\t", "a", "aaaaaaaaaaa bbbbbb aaaa", "It's we'll they'd can't 's", "x1y22z333 3.14", "Ünï ÇA É é ﬁ",
    "ΣΊΣΥΦΟΣ ΌΔΟΣ", "İstanbul I", "日本語テキスト 中文", "a\x1cb\x1d c", "　wide space\xa0nb\x85x", "🙂👍🏽 é🙂",
    "<|startoftext|>hi<|endoftext|> <|endoftext|>there", "<| startoftext |> <|endof", "|||| --- %%% ###&&&", "ñ" * 50,
    "ǅ ß ẞ ﬀ Å", "٣٤ ½ Ⅷ ²", "​‍x", "a" * 3000, "﻿bom",
]


def test_odd_texts_are_encoded_as_by_the_library(library, vocabulary):
    packed = bpe.Encoder(vocabulary).encode(ODD)
    for text, found in zip(ODD, packed):
        assert ids_of(found) == library.encode(text, add_special_tokens=False).ids, text


# Code points assigned in this Python's Unicode; newer ones depend on the library's age.
ASSIGNED = st.characters(exclude_categories=["Cs", "Cn", "Co"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(ASSIGNED, max_size=40), max_size=5))
def test_any_text_is_encoded_as_by_the_library(texts):
    tokenizer, encoder = Tokenizer.from_file(word_vocabulary()), bpe.Encoder(VOCABULARY)
    for text, found in zip(texts, encoder.encode(texts)):
        assert ids_of(found) == tokenizer.encode(text, add_special_tokens=False).ids


VOCABULARY = bpe.Vocabulary(word_vocabulary())


def test_whole_table_against_the_library(spark, table, library):
    rows = {r.doc_id: r for r in op5_bpe_round_trip(spark, SF).collect()}
    documents = table("documents").select("doc_id", "text").collect()
    assert len(rows) == len(documents)
    for doc_id, text in documents:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        row = rows[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_rows_stay_as_they_are(frame, library):
    rows = [(1, None), (2, ""), (2, ""), (None, "the cat"), (3, "the " * 50_000)]
    df = bpe.decode(bpe.encode(frame(rows), word_vocabulary()), word_vocabulary())
    found = sorted(((r.doc_id, r.n_tokens, r.decoded[:20]) for r in df.collect()), key=repr)
    the = library.decode(library.encode("the the the the the the", add_special_tokens=False).ids)[:20]
    assert found == sorted(
        [(1, 0, ""), (2, 0, ""), (2, 0, ""), (None, 2, "the</w> cat</w>"), (3, 50_000, the)], key=repr
    )
    both = bpe.round_trip(frame(rows), word_vocabulary())
    assert sorted(map(tuple, both.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    assert bpe.encode(frame(rows).limit(0), word_vocabulary()).count() == 0


def test_few_remembered_chunks_change_nothing(monkeypatch, vocabulary):
    texts = [f"word{i} other{i % 7} {'ab' * (i % 9)}" for i in range(200)]
    expected = bpe.Encoder(vocabulary).encode(texts)
    monkeypatch.setattr(bpe, "KNOWN_CHUNKS", 3)
    encoder = bpe.Encoder(vocabulary)
    assert [encoder.encode([t])[0] for t in texts] == expected


def test_nothing_of_a_batch_stays_in_the_worker():
    vocabulary = bpe.Vocabulary(word_vocabulary())
    texts = [f"{i} words of a text <unk> and {i * i} more" for i in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(500)), pa.array(texts)], names=["k", "t"])
    encoder = bpe.Encoder(vocabulary)
    views = lambda: sum(type(x) is memoryview for x in gc.get_objects())
    for _ in range(3):
        rows = sum(b.num_rows for b in bpe.coded(batch, encoder, vocabulary.symbols, True))
        assert rows == 500
        gc.collect()
        assert views() < 100
