"""The dynamic program against the tokenizers library, and exact round trips."""

import hashlib
import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
from tokenizers import Tokenizer  # noqa: E402

from tidemark.llm import bpe  # noqa: E402
from tidemark.llm.common import tokenizer_file  # noqa: E402
from tidemark.llm.queries import QUERIES  # noqa: E402

from .conftest import SF_DIR, frame  # noqa: E402

PATH = tokenizer_file()
LIBRARY = Tokenizer.from_file(PATH)
BITS = ["a", "aa", "the", " ", "  ", "\n", "\t", "é", "ß", "1", "²", "Ⅷ", "'s", "'", "!!", "<|endoftext|>", "<|end",
        "\x1c", "\x85", "​", "漢字", "😀", "ing", "tion", "\r\n", "_", "٠", "ThE", "\U000323da退", " er", "\x00", " "]


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(), st.lists(st.sampled_from(BITS), max_size=20).map("".join)))
def test_ids_and_text_as_the_library(text):
    own = bpe.codec(PATH)
    ids = own.encode(text)
    assert ids == library_ids(text)
    assert own.decode(ids) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=12))
def test_any_ids_decode_as_the_library(ids):
    assert bpe.codec(PATH).decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_every_token_is_its_own_encoding():
    own = bpe.codec(PATH)
    for number, piece in enumerate(own.words.pieces):
        text = piece.decode("utf-8", "ignore")
        if text.encode() == piece and len(bpe.pieces_of(text)) == 1 and text not in own.words.specials:
            assert own.piece(text) == (number,)


@pytest.mark.parametrize("text", ["a" * 50_000, " " * 50_000, "ab" * 20_000, "é" * 9_000, "the end " * 9_000])
def test_long_runs(text):
    assert bpe.codec(PATH).encode(text) == library_ids(text)


def test_portions_and_table_sizes_change_nothing(monkeypatch):
    texts = ["one two, three", "one two, three four's", "", " lead", None, "trail ", "a  b\n c", "x<|endoftext|> y", "é" * 99]
    for bits, portion, abreast, long in ((1, 1, 1, 1), (2, 10, 3, 4), (20, 1 << 20, 100, 1000)):
        for name, value in (("PAIR_BITS", bits), ("PORTION", portion), ("ABREAST", abreast), ("LONG_BYTES", long)):
            monkeypatch.setattr(bpe, name, value)
        own = bpe.Codec(PATH)
        assert [i.tolist() for i in own.encode_all(texts)] == [library_ids(t or "") for t in texts]
        assert list(own.encode_all([])) == []


def test_pairs_together_as_one_by_one():
    own = bpe.codec(PATH)
    rng = np.random.default_rng(5)
    left, right = rng.integers(0, 50_000, (2, 20_000))
    left[:9_000], right[:9_000] = rng.integers(0, 600, (2, 9_000))
    keep = [own.sizes[a] > 0 and own.sizes[b] > 0 for a, b in zip(left, right)]
    left, right = left[keep], right[keep]
    want = [own.follows(a, b) for a, b in zip(left.tolist(), right.tolist())]
    for _ in range(2):  # the second time from the table
        assert own.follow(left, right).tolist() == want
    assert 0 < sum(want) < len(want)


def test_operators_and_edges(spark):
    rows = [(1, None), (2, ""), (3, "Hi there"), (3, "Hi there"), (None, "a\n b "), (4, "<|endoftext|>x"), (5, "w " * 30000)]
    docs = frame(spark, rows)
    encoded = bpe.encode(docs)
    assert encoded.columns == ["doc_id", "ids"]
    assert sorted((repr(r.doc_id), r.ids) for r in encoded.collect()) == sorted(
        (repr(d), library_ids(t or "")) for d, t in rows
    )
    back = bpe.decode(encoded).collect()
    assert sorted((repr(r.doc_id), r.text) for r in back) == sorted((repr(d), t or "") for d, t in rows)
    assert bpe.round_trip(docs).count() == len(rows)
    assert bpe.encode(frame(spark, [])).collect() == bpe.round_trip(frame(spark, [])).collect() == []
    assert bpe.decode(spark.createDataFrame([(1, None)], "doc_id bigint, ids array<int>")).first().text == ""


def test_query_against_the_library(spark):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    want = set()
    for d in docs:
        ids = library_ids(d.text or "")
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        want.add((d.doc_id, len(ids), sha(",".join(map(str, ids))), sha(decoded)))
    got = QUERIES["op2_bpe"](spark, SF_DIR).collect()
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want
    assert len(got) == len(docs)


def test_classes_of_all_characters():
    own = bpe.codec(PATH)
    spans = [(0, 0xD800), (0xE000, 0x40000), (0xE0000, 0xE1000)]
    wrong = []
    for low, high in spans:
        for at in range(low, high):
            c = chr(at)
            pieces = bpe.pieces_of(f"a{c}1{c}!{c}")
            if pieces != [f"a{c}1{c}!{c}"[a:b] for _, (a, b) in LIBRARY.pre_tokenizer.pre_tokenize_str(f"a{c}1{c}!{c}")]:
                wrong.append(hex(at))
    assert wrong == []
    assert own.encode("\U000323da退") == library_ids("\U000323da退")
