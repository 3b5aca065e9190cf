"""What the operators share: text rules, folds, and tables written between stages.

A document is a row with a ``doc_id`` and a ``text``.  Operators read the columns
they need by name.  Those that return whole documents go by other names for all
other columns meanwhile (:func:`apart`), so that these never clash with internal
ones, which start with an underscore.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: White space between words: space and the ASCII controls tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"
#: A table is broadcast only if its measured rows stay below this many bytes.
BROADCAST_BYTES = 32 << 20
#: Rows handed to a Python worker at once, so that long texts stay within its memory.
ROWS_PER_BATCH = 1000


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def fold(doc_id: Column, folds: int) -> Column:
    """Fold of a document by the CRC of its id as text; NULL ids are in fold -1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(-1))


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of texts small; a smaller limit of the session stands."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ROWS_PER_BATCH:
        spark.conf.set(key, ROWS_PER_BATCH)


def apart(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A function from documents to documents, with the columns it does not know out of its way.

    All but doc_id and text go by plain numbered names inside and by their own again
    in what comes out, whatever they are called.
    """

    @wraps(stage)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        own = docs.columns
        held = [c if c in ("doc_id", "text") else f"column{k}" for k, c in enumerate(own)]
        return stage(docs.toDF(*held), *args, **kwargs).select(*held).toDF(*own)

    return run


class Table:
    """A frame written to the cluster's shared folder, with its row count.

    Later work reads the files: nothing is computed twice, and a lost executor
    costs a re-read.  ``drop`` removes a table that no frame in use reads.
    """

    def __init__(self, frame: DataFrame, purpose: str, **totals: Column):
        spark = frame.sparkSession
        seen = Observation()
        self.path = scratch_dir(spark, purpose)
        columns = [total.alias(name) for name, total in totals.items()]
        frame.observe(seen, F.count(F.lit(1)).alias("_rows"), *columns).write.parquet(self.path)
        self.totals = seen.get
        self.rows = self.totals.get("_rows") or 0
        self.frame = spark.read.schema(frame.schema).parquet(self.path)
        self.spark = spark

    def small(self, bytes_per_row: int) -> bool:
        return self.rows * bytes_per_row <= BROADCAST_BYTES

    def hinted(self, bytes_per_row: int) -> DataFrame:
        """The frame, to be broadcast if its measured size allows it."""
        return F.broadcast(self.frame) if self.small(bytes_per_row) else self.frame

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary; TOKENIZER_DIR names a folder of another place."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
