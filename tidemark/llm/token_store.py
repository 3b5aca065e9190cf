"""Token files of directly addressable codes.

An id is cut into chunks of 8 bits.  Level 0 holds the lowest chunk of every id,
each next level the next chunk of those ids that have one.  A bitmap beside each
level tells which ids go on, and a rank directory with the number of set bits
before every block of 512 turns a position of one level into that of the next.
So any id is found with one look-up a level; nothing else is decoded.

A store is a folder of two tables.  ``shards`` has one row for each token file:
its bytes and the lengths and ids of its documents.  ``parts`` has the ids before
each part, so that the place of any document in the whole order is known.  Spark
writes both, so they commit as a whole on any file system Spark reaches.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import UNEVEN
from tidemark.llm.common import small_batches, tokenizer_file
from tidemark.session import scratch_dir

MAGIC = b"DAC1"
BLOCK = 512
#: Ids after which a token file is closed at the end of a document.
SHARD_IDS = 1 << 20
END_ID = 2
#: Characters of the texts encoded at once, unless one text is longer.
PORTION = 1 << 22
#: Different words given to the library as one text.
WORDS_A_CALL = 2000
#: Different words, and ids of them, above which an encoder keeps only those of its last texts.
KEPT_WORDS, KEPT_IDS = 1 << 19, 1 << 22


# --- the codes -----------------------------------------------------------------


def pack(ids: np.ndarray) -> bytes:
    """A token file: magic, number of ids and levels, then for each level chunks, bitmap and directory."""
    rest = np.asarray(ids, np.uint32)
    levels = []
    while True:
        more = rest >= 256
        bits = np.packbits(more, bitorder="little").tobytes()
        bits += bytes(-len(bits) % (BLOCK // 8))
        counts = np.bitwise_count(np.frombuffer(bits, np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
        ranks = np.r_[np.uint32(0), np.cumsum(counts, dtype=np.uint32)].astype("<u4")
        levels.append(struct.pack("<Q", len(rest)) + (rest & 255).astype(np.uint8).tobytes() + bits + ranks.tobytes())
        if not more.any():
            break
        rest = rest[more] >> 8
    return MAGIC + struct.pack("<QB", len(ids), len(levels)) + b"".join(levels)


class TokenFile:
    """Read access to the bytes that ``pack`` made."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token file")
        self.length, levels = struct.unpack_from("<QB", data, 4)
        at, self.levels = 13, []
        for _ in range(levels):
            (n,) = struct.unpack_from("<Q", data, at)
            blocks = -(-n // BLOCK)
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            bits = np.frombuffer(data, np.uint8, blocks * BLOCK // 8, at + 8 + n)
            ranks = np.frombuffer(data, "<u4", blocks + 1, at + 8 + n + len(bits))
            self.levels.append((chunks, bits, ranks))
            at += 8 + n + len(bits) + 4 * len(ranks)

    def __len__(self) -> int:
        return self.length

    def __getitem__(self, i: int) -> int:
        """One id, by ranks alone."""
        if not 0 <= i < self.length:
            raise IndexError(i)
        value = 0
        for depth, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * depth)
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            i = self._rank(bits, ranks, i)
        return value

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Set bits before position i."""
        block, byte = i // BLOCK, i >> 3
        inside = bits[block * (BLOCK // 8) : byte]
        last = int(bits[byte]) & ((1 << (i & 7)) - 1)
        return int(ranks[block]) + int(np.bitwise_count(inside).sum()) + last.bit_count()

    def all(self) -> np.ndarray:
        """Every id in order, for readers that want the whole file."""
        values = np.zeros(self.length, np.uint32)
        where = None
        for depth, (chunks, bits, _) in enumerate(self.levels):
            part = chunks.astype(np.uint32) << np.uint32(8 * depth)
            if where is None:
                values |= part
                where = np.arange(self.length) if len(self.levels) > 1 else None
            else:
                values[where] |= part
            if depth + 1 < len(self.levels):
                more = np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)
                where = where[more]
        return values


# --- encoding ------------------------------------------------------------------


class LibraryEncoder:
    """Ids of the tokenizers library for many texts at once.

    A space before something else always begins a piece, so a text may be cut
    there, and each different word encoded once.  Words stay known from texts to
    texts, within a fixed size that saves work and changes nothing.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.sizes = np.zeros(self.library.get_vocab_size(), np.int64)
        for spelling, number in self.library.get_vocab(with_added_tokens=False).items():
            self.sizes[number] = len(spelling)  # a byte-level spelling has one letter a byte
        self._keep([], np.zeros(0, np.int64), np.zeros(0, "<u4"))

    def _keep(self, words: list[str], lengths: np.ndarray, ids: np.ndarray) -> None:
        """Know these words and no others: numbered as they come, ids one word after the other."""
        self.numbers = defaultdict(count(len(words)).__next__, zip(words, count()))
        self.lengths, self.ids = lengths, ids
        self.begins = np.cumsum(lengths) - lengths

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """Ids of each whole text in turn, worked out in portions."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= PORTION:
                yield from self._portion(held)
                held, size = [], 0
        yield from self._portion(held)

    def _portion(self, texts: list[str]) -> Iterator[np.ndarray]:
        whole = [UNEVEN.search(t) is not None or any(s in t for s in self.specials) for t in texts]
        cut = [[] if as_one else t.split(" ")[1:] for t, as_one in zip(texts, whole)]
        firsts = [t if as_one else t.split(" ", 1)[0] for t, as_one in zip(texts, whole)]
        words = list(chain.from_iterable(cut))
        flat, ends = self._known(words)
        bounds = np.r_[0, ends][np.cumsum([0, *map(len, cut)])]
        heads = self.library.encode_batch_fast(firsts, add_special_tokens=False)
        for head, low, high in zip(heads, bounds, bounds[1:]):
            yield np.concatenate([np.array(head.ids, "<u4"), flat[low:high]])

    def _known(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of words with a space before each, and where those of each word end."""
        before = len(self.lengths)
        if len(self.numbers) != before:  # an error came between a word's number and its ids
            self._keep([], self.lengths[:0], self.ids[:0])
            before = 0
        which = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        lengths, ids = self._words(list(islice(self.numbers, before, None)))
        self.begins = np.r_[self.begins, len(self.ids) + np.cumsum(lengths) - lengths]
        self.ids = np.r_[self.ids, ids]
        self.lengths = np.r_[self.lengths, lengths]
        if len(self.lengths) > KEPT_WORDS or len(self.ids) > KEPT_IDS:
            last, which = np.unique(which, return_inverse=True)
            names = list(self.numbers)
            self._keep([names[k] for k in last], self.lengths[last], self._joined(last)[0])
        return self._joined(which)

    def _joined(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of known words by number, and where those of each word end."""
        lengths = self.lengths[which]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.begins[which] - ends + lengths, lengths) + np.arange(total)], ends

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words with a space before each: how many of each, and all of them.

        The library gets many words as one text; they are told apart by the bytes
        their tokens stand for.
        """
        found = []
        for low in range(0, len(words), WORDS_A_CALL):
            (got,) = self.library.encode_batch_fast([" " + " ".join(words[low : low + WORDS_A_CALL])], add_special_tokens=False)
            found.append(np.array(got.ids, "<u4"))
        ids = np.concatenate(found) if found else np.zeros(0, "<u4")
        spelled = np.cumsum(np.fromiter((len(w.encode()) + 1 for w in words), np.int64, len(words)))
        ends = np.searchsorted(np.cumsum(self.sizes[ids]), spelled) + 1
        return np.diff(ends, prepend=0), ids


@lru_cache(maxsize=2)
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


# --- the store -----------------------------------------------------------------

_FILE = "part int, seq int, first bigint, n_ids bigint, lengths array<bigint>, payload binary"


def write_store(docs: DataFrame, folder: str | None = None, path: str | None = None, end_id: int = END_ID) -> str:
    """Write the ids of every whole text, in ascending doc_id order, and return the store's folder.

    Each document ends in ``end_id``.  NULL text counts as empty.  NULL ids come
    first; documents of one id are ordered by text hash and text, repeated rows
    are written as often as they come.  An empty table makes an empty store.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or scratch_dir(spark, "token-store")
    path = path or tokenizer_file()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("_tie"))
    ordered = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = library_encoder(path), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4")
        seq, first, held, ids, lengths = 0, 0, 0, [], []

        def close() -> pa.RecordBatch:
            data = pack(np.concatenate(ids))
            row = [[part], [seq], [first], [held], [lengths], [data], [names]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.list_(id_type)]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], columns)

        columns = ["part", "seq", "first", "n_ids", "lengths", "payload", "doc_ids"]
        names: list = []
        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc_id, got in zip(batch.column(0).to_pylist(), own.encode_all(batch.column(1).to_pylist())):
                ids += [got, end]
                lengths.append(len(got) + 1)
                names.append(doc_id)
                held += len(got) + 1
                if held >= SHARD_IDS:
                    yield close()
                    seq, first, held, ids, lengths, names = seq + 1, first + held, 0, [], [], []
        if names:
            yield close()

    written = ordered.select("doc_id", "text").mapInArrow(files, f"{_FILE}, doc_ids array<{kind}>")
    written.write.parquet(f"{folder}/shards")
    sizes = spark.read.parquet(f"{folder}/shards").groupBy("part").agg(F.sum("n_ids").alias("n"))
    totals = sorted((r.part, r.n) for r in sizes.collect())  # one row for each partition of the write
    starts, at = [], 0
    for part, n in totals:
        starts.append((part, at))
        at += n
    spark.createDataFrame(starts, "part int, before bigint").coalesce(1).write.parquet(f"{folder}/parts")
    return folder


def shards(spark: SparkSession, folder: str) -> DataFrame:
    """The token files with ``start``, the number of ids before each."""
    parts = spark.read.parquet(f"{folder}/parts")
    files = spark.read.parquet(f"{folder}/shards")
    return files.join(F.broadcast(parts), "part").withColumn("start", F.col("before") + F.col("first"))


def read_documents(spark: SparkSession, folder: str, ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files; with the ids too if asked."""
    kind = spark.read.parquet(f"{folder}/shards").schema["doc_ids"].dataType.elementType.simpleString()
    files = shards(spark, folder).select("start", "lengths", "payload", "doc_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                start, lengths, payload = (batch.column(c)[k].as_py() for c in range(3))
                values = TokenFile(payload).all().astype("<u4")
                ends = np.cumsum(lengths)
                begins = ends - lengths
                texts = [values[a:b] for a, b in zip(begins, ends)]
                columns = [
                    batch.column(3)[k].values,
                    pa.array(begins + start, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array([zlib.crc32(t.tobytes()) for t in texts], pa.int64()),
                ]
                if ids:
                    columns.append(pa.array([t.astype(np.int32) for t in texts], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * ids]
    schema = f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * ids
    return files.mapInArrow(run, schema)


def tokens_at(spark: SparkSession, folder: str, positions: list[int]) -> DataFrame:
    """(position, token) of some positions of the whole order; only their files are opened."""
    files = shards(spark, folder)
    asked = F.array(*[F.lit(int(p)).cast("bigint") for p in positions])
    inside = F.filter(asked, lambda p: (p >= F.col("start")) & (p < F.col("start") + F.col("n_ids")))
    wanted = files.select("start", inside.alias("asked"), "payload").where(F.size("asked") > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, asked, payload in zip(*(batch.column(c) for c in range(3))):
                file, places = TokenFile(payload.as_py()), asked.as_py()
                found = [file[p - start.as_py()] for p in places]
                yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(found, pa.int32())], out)

    out = ["position", "token"]
    return wanted.mapInArrow(run, "position bigint, token int")
