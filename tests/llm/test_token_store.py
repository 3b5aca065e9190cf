"""Exact round trips of the token files, and the query against the tokenizers library."""

import os
import zlib
from itertools import chain

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
from tokenizers import Tokenizer  # noqa: E402

from tidemark.llm import token_store  # noqa: E402
from tidemark.llm.common import tokenizer_file  # noqa: E402
from tidemark.llm.queries import QUERIES  # noqa: E402

from .conftest import SF_DIR, frame  # noqa: E402
from .test_bpe import BITS  # noqa: E402

PATH = tokenizer_file()
LIBRARY = Tokenizer.from_file(PATH)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500))
def test_codes_round_trip_and_direct_access(ids):
    file = token_store.TokenFile(token_store.pack(np.array(ids, np.uint32)))
    assert len(file) == len(ids)
    assert file.all().tolist() == ids
    assert [file[i] for i in range(len(ids))] == ids
    with pytest.raises(IndexError):
        file[len(ids)]


def test_size_of_a_large_file():
    ids = np.random.default_rng(1).integers(0, 50257, 200_000)
    data = token_store.pack(ids)
    assert len(data) < 2.35 * len(ids)
    assert token_store.TokenFile(data)[199_999] == ids[-1]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.lists(st.sampled_from(BITS), max_size=20).map("".join)))
def test_words_are_encoded_as_the_whole_text(text):
    got = token_store.library_encoder(PATH).encode(text).tolist()
    assert got == LIBRARY.encode(text, add_special_tokens=False).ids


def test_portions_change_nothing(monkeypatch):
    texts = ["one two one", "", "two\n three ", "a<|endoftext|> b", "é two 漢字 one", "\n", "one  two", "😀 😀"]
    for portion, words in ((1, 1), (8, 2), (1 << 20, 100)):
        monkeypatch.setattr(token_store, "PORTION", portion)
        monkeypatch.setattr(token_store, "WORDS_A_CALL", words)
        got = [i.tolist() for i in token_store.library_encoder(PATH).encode_all(texts)]
        assert got == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_stay_known_within_a_bound(monkeypatch):
    own, given = token_store.LibraryEncoder(PATH), []
    words = own._words
    monkeypatch.setattr(own, "_words", lambda new: given.append(list(new)) or words(new))

    def check(*texts):
        got = [i.tolist() for i in own.encode_all(texts)]
        assert got == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
        return sorted(chain.from_iterable(given)), given.clear()

    assert check("a one two", "b two three")[0] == ["one", "three", "two"]
    assert check("a three one two", "b öne three")[0] == ["öne"]
    monkeypatch.setattr(token_store, "KEPT_WORDS", 4)
    assert check("a two five öne five")[0] == ["five"]
    assert len(own.lengths) == len(own.numbers) == 3  # the words of the last text stay
    assert check("a five one öne", "")[0] == ["one"]
    monkeypatch.setattr(token_store, "KEPT_WORDS", 0)
    assert check("a five", "b one one two five six")[0] == ["six"]
    assert check("", "c") == ([], None) and not len(own.lengths) and not len(own.ids)
    own.numbers["broken"]  # a number without ids
    assert check("a broken one")[0] == ["broken", "one"]


def expected(rows):
    out, at = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_query_against_the_library(spark):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows = QUERIES["op4_token_store"](spark, SF_DIR).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == expected(docs)


def test_edges_small_files_and_single_tokens(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(token_store, "SHARD_IDS", 8)
    rows = [(3, "one two"), (None, "no id"), (1, None), (2, ""), (9, "w " * 3000), (5, "same"), (5, "same"), (7, "<|endoftext|>")]
    folder = token_store.write_store(frame(spark, rows), str(tmp_path / "store"))
    got = token_store.read_documents(spark, folder, ids=True).collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in sorted(got, key=lambda r: r.start)] == expected(rows)
    flat = [t for r in sorted(got, key=lambda r: r.start) for t in r.ids]
    asked = [0, 5, len(flat) - 1, 17, 400]
    found = {r.position: r.token for r in token_store.tokens_at(spark, folder, asked).collect()}
    assert found == {p: flat[p] for p in asked}


def test_empty_table(spark, tmp_path):
    folder = token_store.write_store(frame(spark, []), str(tmp_path / "none"))
    assert token_store.read_documents(spark, folder).collect() == []
