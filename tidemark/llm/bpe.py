"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

The encoding of a text ends in one token, and without that token it is the
encoding of a shorter prefix.  So it is enough to know, for every prefix, the
last token of its encoding: of the vocabulary tokens that end there, it is the
one that may stand after the last token of the prefix before it.  Following the
last tokens back from the end gives the exact ids, without merging anything.

A worker takes the different pieces of many texts at once and goes through them
side by side, one byte of all pieces in a step, so that each step is a few array
operations whatever the number of pieces.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256
from itertools import chain, count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidemark.llm.common import small_batches, tokenizer_file

#: Fixed value: the pattern of the pieces that byte-level BPE never merges across.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Code points, in hexadecimal, that the regex library counts as letters or
# numbers and the tokenizers library, with older tables, as neither.
NEWER = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 "
    "10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 "
    "16EBB-16ED3 16FF2-16FF3 16FF4-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 "
    "1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 "
    "1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
NEWER_SET = "".join(
    "-".join(f"\\U{int(end, 16):08x}" for end in span.split("-")) for span in NEWER.split()
)
HAS_NEWER = regex.compile(f"[{NEWER_SET}]")
PIECE_NEWER = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[\p{{L}}--[{NEWER_SET}]]+| ?[\p{{N}}--[{NEWER_SET}]]+"
    rf"| ?[[^\s\p{{L}}\p{{N}}]||[{NEWER_SET}]]+|\s+(?!\S)|\s+",
    regex.V1,
)
#: A space before another space or at the end, where cutting at spaces would not keep the pieces.
UNEVEN = re.compile(r" (?:\s|\Z)")
#: Characters of the texts taken at once, unless one text is longer.
PORTION = 1 << 21
#: Different pieces that go side by side.
ABREAST = 1 << 14
#: Pieces of more bytes, which are few, go one by one.
LONG_BYTES = 64
#: Places of the table of token pairs tested before, of 8 bytes each; a newer pair takes the place of an older one.
PAIR_BITS = 20
PAIR_FACTOR = np.uint64(0x9E3779B97F4A7C15)
ENDLESS = 1 << 60


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary file.

    Printable Latin-1 characters stand for themselves; the other bytes, in order,
    for the characters from 256 on.
    """
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


@dataclass(frozen=True)
class Ends:
    """Automaton of the vocabulary's bytes: which tokens end where, longest first.

    A state stands for the longest end of what was read that begins a token.  Only
    states with longer ones have a row of transitions of their own.
    """

    row: np.ndarray  # by state
    table: np.ndarray  # rows x 256: next state
    first: np.ndarray  # by state: the longest end of it that is a token, as a state; 0 is none
    following: np.ndarray  # by such a state: the next shorter one
    token: np.ndarray  # by such a state: its id


@dataclass(frozen=True)
class Vocabulary:
    pieces: list[bytes]  # by id
    merged: dict[tuple[int, int], int]  # rank of the merge of two ids
    made_at: list[int]  # rank of the merge that makes an id, -1 for single bytes
    parts: list[tuple[int, int]]  # the two ids an id is merged from
    specials: dict[str, int]
    ends: Ends


def token_ends(spellings: dict[bytes, int]) -> Ends:
    """The automaton of some tokens, made level by level from short to long."""
    places: dict[int, int] = {}
    token, parent, byte, depth = [-1], [0], [0], [0]
    for spelling, number in spellings.items():
        state = 0
        for level, b in enumerate(spelling, 1):
            state, before = places.setdefault(state << 8 | b, len(token)), state
            if state == len(token):
                token.append(-1)
                parent.append(before)
                byte.append(b)
                depth.append(level)
        token[state] = number
    token, parent, byte, depth = map(np.array, (token, parent, byte, depth))
    inner = np.unique(np.r_[0, parent])
    row = np.full(len(token), -1)
    row[inner] = np.arange(len(inner))
    table = np.zeros((len(inner), 256), np.int32)
    fail, first = np.zeros(len(token), np.int64), np.zeros(len(token), np.int64)
    levels = np.split(np.argsort(depth, kind="stable"), np.cumsum(np.bincount(depth))[:-1])
    for level, states in enumerate(levels):
        if level > 1:
            fail[states] = table[row[fail[parent[states]]], byte[states]]
        first[states] = np.where(token[states] >= 0, states, first[fail[states]])
        has_row = row[states] >= 0
        row[states[~has_row]] = row[fail[states[~has_row]]]
        if level:
            table[row[states[has_row]]] = table[row[fail[states[has_row]]]]
        if level + 1 < len(levels):
            longer = levels[level + 1]
            table[row[parent[longer]], byte[longer]] = longer
    return Ends(row, table, first, first[fail], token)


def read_vocabulary(path: str) -> Vocabulary:
    """Tables of a byte-level BPE file of the tokenizers library."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model = content["model"]
    specials = {t["content"]: t["id"] for t in content["added_tokens"]}
    size = max([*model["vocab"].values(), *specials.values()]) + 1
    byte_of = {letter: b for b, letter in enumerate(byte_letters())}
    pieces = [b""] * size
    for spelling, number in model["vocab"].items():
        pieces[number] = bytes(byte_of[c] for c in spelling)
    for text, number in specials.items():
        pieces[number] = text.encode()
    merged, made_at, parts = {}, [-1] * size, [(-1, -1)] * size
    for rank, pair in enumerate(model["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        a, b, c = (model["vocab"][x] for x in (left, right, left + right))
        merged[a, b] = rank
        made_at[c], parts[c] = rank, (a, b)
    spellings = {}
    for number in model["vocab"].values():
        if made_at[number] >= 0 or len(pieces[number]) == 1:  # others never come out of merging
            spellings[pieces[number]] = number
    ends = token_ends(spellings)
    return Vocabulary(pieces, merged, made_at, parts, specials, ends)


def pieces_of(text: str) -> list[str]:
    return (PIECE if text.isascii() or not HAS_NEWER.search(text) else PIECE_NEWER).findall(text)


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, path: str):
        self.words = words = read_vocabulary(path)
        self.names = [str(i) for i in range(len(words.pieces))]
        found = "|".join(re.escape(s) for s in sorted(words.specials, key=len, reverse=True))
        self.special = re.compile(f"({found})") if found else None
        self.sizes = np.array([len(p) for p in words.pieces])
        self.made_at = np.array(words.made_at)
        self.left_part, self.right_part = np.array(words.parts).T.copy()
        keys = np.array([a << 32 | b for a, b in words.merged])
        order = np.argsort(keys)
        self.merge_keys, self.merge_ranks = keys[order], np.array(list(words.merged.values()))[order]
        self.pairs = np.full(1 << PAIR_BITS, -1)  # pair and verdict in one number

    def follows(self, left: int, right: int) -> bool:
        """Whether merging leaves the seam between two tokens alone.

        Both sides are taken apart in reverse order of merging.  What stands at
        the seam at a time may merge if the rank comes before the next merge of
        either side; of equal ranks the one further left comes first.
        """
        merged, made_at, parts = self.words.merged, self.words.made_at, self.words.parts
        a, b, until_a, until_b = left, right, ENDLESS, ENDLESS
        while True:
            rank = merged.get((a, b))
            if rank is not None and rank < until_a and rank <= until_b:
                return False
            if made_at[a] > made_at[b]:
                until_a, a = made_at[a], parts[a][1]
            elif made_at[b] >= 0:
                until_b, b = made_at[b], parts[b][0]
            else:
                return True

    def follow(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``follows`` of many pairs."""
        pair = left.astype(np.int64) << 32 | right
        place = (pair.view(np.uint64) * PAIR_FACTOR >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
        got = self.pairs[place]
        out = (got & 1).astype(bool)
        new = np.flatnonzero(got >> 1 != pair)
        if len(new):
            out[new] = self._taken_apart(left[new], right[new])
            self.pairs[place[new]] = pair[new] << 1 | out[new]
        return out

    def _taken_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out, open_ = np.ones(len(a), bool), np.arange(len(a))
        until_a = np.full(len(a), ENDLESS)
        until_b = until_a.copy()
        while len(open_):
            pair = a.astype(np.int64) << 32 | b
            at = np.minimum(np.searchsorted(self.merge_keys, pair), len(self.merge_keys) - 1)
            rank = np.where(self.merge_keys[at] == pair, self.merge_ranks[at], ENDLESS)
            merges = (rank < until_a) & (rank <= until_b)
            out[open_[merges]] = False
            made_a, made_b = self.made_at[a], self.made_at[b]
            first_a = made_a > made_b
            more = ~merges & (first_a | (made_b >= 0))
            until_a, until_b = np.where(first_a, made_a, until_a)[more], np.where(first_a, until_b, made_b)[more]
            a, b = np.where(first_a, self.right_part[a], a)[more], np.where(first_a, b, self.left_part[b])[more]
            open_ = open_[more]
        return out

    def piece(self, text: str) -> tuple[int, ...]:
        """Ids of one piece, from the last token of each of its prefixes."""
        spelling, ends = text.encode("utf-8"), self.words.ends
        last = [-1] * (len(spelling) + 1)
        state = 0
        for end, b in enumerate(spelling, 1):
            state = ends.table[ends.row[state], b]
            found = ends.first[state]
            while found:
                token = int(ends.token[found])
                start = end - len(self.words.pieces[token])
                if start == 0 or (last[start] >= 0 and self.follows(last[start], token)):
                    last[end] = token
                    break
                found = ends.following[found]
        ids, at = [], len(spelling)
        while at:
            ids.append(last[at])
            at -= len(self.words.pieces[last[at]])
        return tuple(reversed(ids))

    def _abreast(self, spellings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that come in order of length, longest first: numbers of ids, and all ids in a row."""
        ends, lengths = self.words.ends, np.array([len(s) for s in spellings])
        flat = np.frombuffer(b"".join(spellings), np.uint8)
        begins = np.cumsum(lengths) - lengths
        last = np.full((lengths[0] + 1, len(spellings)), -1, np.int32)
        state = np.zeros(len(spellings), np.int64)
        for at in range(lengths[0]):
            here = np.searchsorted(-lengths, -at)  # pieces with a byte there
            state = ends.table[ends.row[state[:here]], flat[begins[:here] + at]]
            found = ends.first[state]
            open_ = np.flatnonzero(found)
            found = found[open_]
            while len(open_):
                token = ends.token[found]
                start = at + 1 - self.sizes[token]
                before = last[start, open_]
                fits = start == 0
                asked = np.flatnonzero(before >= 0)
                fits[asked] = self.follow(before[asked], token[asked])
                last[at + 1, open_[fits]] = token[fits]
                found = ends.following[found]
                more = ~fits & (found > 0)
                open_, found = open_[more], found[more]
        steps, left, open_ = [], lengths.copy(), np.arange(len(spellings))
        number = np.zeros(len(spellings), np.int64)
        while len(open_):
            token = last[left[open_], open_]
            steps.append((open_, token))
            number[open_] += 1
            left[open_] -= self.sizes[token]
            open_ = open_[left[open_] > 0]
        ids, back = np.empty(number.sum(), np.int32), np.cumsum(number) - 1
        for k, (where, token) in enumerate(steps):
            ids[back[where] - k] = token
        return number, ids

    def pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of different pieces or special tokens: where they begin, how many, and all ids."""
        spellings = [t.encode("utf-8") for t in texts]
        sizes = np.fromiter(map(len, spellings), np.int64, len(texts))
        alone = set(np.flatnonzero(sizes > LONG_BYTES).tolist())
        alone |= {k for k, t in enumerate(texts) if t in self.words.specials}
        order = np.argsort(-sizes, kind="stable")
        if alone:
            order = order[~np.isin(order, list(alone))]
        begin, number = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        found, total = [], 0
        for low in range(0, len(order), ABREAST):
            some = order[low : low + ABREAST]
            many, ids = self._abreast([spellings[k] for k in some.tolist()])
            begin[some], number[some] = total + np.cumsum(many) - many, many
            found.append(ids)
            total += len(ids)
        for k in alone:
            special = self.words.specials.get(texts[k])
            ids = np.array(self.piece(texts[k]) if special is None else [special], np.int32)
            begin[k], number[k] = total, len(ids)
            found.append(ids)
            total += len(ids)
        return begin, number, np.concatenate(found) if found else np.zeros(0, np.int32)

    def _cut(self, text: str) -> list[str]:
        """Pieces of a text, and special tokens spelled out in it, which count as such."""
        if self.special is None or not any(s in text for s in self.words.specials):
            return pieces_of(text)
        parts = self.special.split(text)
        return list(chain.from_iterable([p] if p in self.words.specials else pieces_of(p) for p in parts))

    def encode_all(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each whole text in turn; None counts as empty."""
        held: list[list[str]] = []
        size = 0
        for text in texts:
            held.append(self._cut(text or ""))
            size += len(text or "")
            if size >= PORTION:
                yield from self._encoded(held)
                held, size = [], 0
        yield from self._encoded(held)

    def _encoded(self, cut: list[list[str]]) -> Iterator[np.ndarray]:
        parts = list(chain.from_iterable(cut))
        number_of = dict(zip(dict.fromkeys(parts), count()))
        which = np.fromiter(map(number_of.__getitem__, parts), np.int64, len(parts))
        begin, number, ids = self.pieces(list(number_of))
        lengths = number[which]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        flat = ids[np.repeat(begin[which] - ends + lengths, lengths) + np.arange(total)]
        bounds = np.r_[0, ends][np.cumsum([0, *map(len, cut)])]
        for low, high in zip(bounds, bounds[1:]):
            yield flat[low:high]

    def encode(self, text: str) -> list[int]:
        """Ids of the whole text."""
        return next(self.encode_all([text])).tolist()

    def decode(self, ids: list[int]) -> str:
        """Text of the ids; bytes that are not UTF-8 become replacement characters."""
        pieces = self.words.pieces
        return b"".join([pieces[i] for i in ids]).decode("utf-8", "replace")

    def digests(self, ids: list[int]) -> tuple[int, str, str]:
        """Number and hash of ids, and hash of the text decoded from them."""
        names = self.names
        written = ",".join([names[i] for i in ids]).encode()
        return len(ids), sha256(written).hexdigest(), sha256(self.decode(ids).encode()).hexdigest()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The worker's codec, kept between tasks."""
    return Codec(path)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) with the token ids of every whole text.

    NULL counts as empty and has no ids.  Repeated rows come out as often as they
    go in.  ``path`` is the vocabulary file, at the same place on all machines.
    """
    path = path or tokenizer_file()

    def run(doc_id: pa.Array, text: pa.Array) -> list[pa.Array]:
        own = codec(path)
        return [doc_id, pa.array(list(own.encode_all(text.to_pylist())), pa.list_(pa.int32()))]

    return _mapped(docs, "text", run, "ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); NULL ids give an empty text."""
    path = path or tokenizer_file()

    def run(doc_id: pa.Array, ids: pa.Array) -> list[pa.Array]:
        own = codec(path)
        return [doc_id, pa.array([own.decode(i.as_py() or []) for i in ids], pa.string())]

    return _mapped(encoded, "ids", run, "text string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): what encode and decode give, as digests.

    The ids go no further than the worker, so the widest column is a hash.
    """
    path = path or tokenizer_file()

    def run(doc_id: pa.Array, text: pa.Array) -> list[pa.Array]:
        own = codec(path)
        n, ids, decoded = zip(*(own.digests(i.tolist()) for i in own.encode_all(text.to_pylist())))
        return [doc_id, pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]

    return _mapped(docs, "text", run, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _mapped(frame: DataFrame, column: str, run, schema: str) -> DataFrame:
    small_batches(frame.sparkSession)
    rows = frame.select("doc_id", column)
    names = ["doc_id", *(c.split(" ")[0] for c in schema.split(", "))]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                yield pa.RecordBatch.from_arrays(run(part.column(0), part.column(1)), names)

    return rows.mapInArrow(batches, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {schema}")
