"""Keyed current state on plain files, in hash buckets.

A key's hash names its bucket.  An upsert merges and writes the buckets its batch
has keys of and no other, and then publishes a manifest: one small file in a log,
named by version, that holds the folder of every bucket.  Readers follow the newest
manifest, so they see the old state or the new one and never a half-written one; a
failed run leaves at most unpublished folders.  A version is published once: of two
writers at a time the later one goes over the other's manifest, merging again only
the buckets that both have touched.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_per_key
from tidemark.operators.state import merged
from tidemark.sinks.contract import Contract, conform

#: Buckets of a new state; at scale about the state's size over that of a good file.
BUCKETS = 16
#: Publishings tried before an upsert gives up because others keep getting ahead.
ATTEMPTS = 5
#: Seconds to wait for another writer to finish an entry.
PATIENCE = 10
#: Ends an entry, so that one just begun is not taken for a manifest.
END = "\n"
#: Names the folders of a batch by bucket; not a column of the state.
BUCKET = "state_bucket"


class Manifest(NamedTuple):
    """A published state: how many buckets keys are hashed to, and the folder of each that has rows."""

    version: int
    buckets: int
    folders: dict[int, str]


class StateTable:
    """The state of a contract with a unique key, under one root folder.

    A new root needs :meth:`create` once.
    """

    def __init__(self, spark: SparkSession, root: str, contract: Contract):
        if not contract.unique:
            raise ValueError(f"{contract.name} has no unique key to upsert on")
        self.spark = spark
        self.contract = contract
        self._root = root.rstrip("/")

    def create(self, buckets: int = BUCKETS) -> StateTable:
        """Set up an empty state; on an existing one this changes nothing, its buckets included."""
        fs, log = self._files()
        fs.mkdirs(log)
        if self._newest() is None:
            self._publish(Manifest(0, buckets, {}))
        return self

    def _files(self):
        """The file system of the root, and the log folder in it."""
        path = self._path("log")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _path(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self._root, *names)))

    def _newest(self) -> int | None:
        """Version of the newest entry; only names are listed, however long the log is."""
        fs, log = self._files()
        return max((int(e.getPath().getName()) for e in fs.listStatus(log)), default=None)

    def _published(self) -> Manifest:
        """The newest manifest."""
        newest = self._newest()
        if newest is None:
            raise RuntimeError(f"{self._root} has no state yet; create() sets one up")
        fs, _ = self._files()
        entry = self._path("log", str(newest))
        for _ in range(PATIENCE):
            stream = fs.open(entry)
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            if text.endswith(END):
                held = json.loads(text)
                return Manifest(newest, held["buckets"], {int(b): f for b, f in held["folders"].items()})
            time.sleep(1)
        raise RuntimeError(f"the writer of {entry.toString()} left it unfinished; remove that file if the writer is gone")

    def _rows(self, folders: Sequence[str]) -> DataFrame:
        schema = self.contract.schema
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self._root}/{f}" for f in folders])

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.contract.unique), F.lit(buckets)).cast("int")

    def current(self) -> DataFrame:
        """The last published state; empty before the first upsert."""
        return self._rows(sorted(self._published().folders.values()))

    def rows_of(self, keys: Sequence[tuple]) -> DataFrame:
        """The state's rows of a few keys a caller typed in; only their buckets are read."""
        last = self._published()
        names = list(self.contract.unique)
        kinds = [f"{f.name} {f.type}" for f in self.contract.fields if f.name in names]
        wanted = self.spark.createDataFrame([tuple(k) for k in keys], ", ".join(kinds)).select(*names)
        # One row for each key that was typed in.
        buckets = {r[0] for r in wanted.select(self._bucket(last.buckets)).collect()}
        rows = self._rows([last.folders[b] for b in sorted(buckets) if b in last.folders])
        return rows.join(F.broadcast(wanted), names, "left_semi").select(*self.contract.columns)

    def upsert(self, batch: DataFrame, newest: str, tiebreak: Sequence[str | Column]) -> int:
        """Insert new keys, replace known ones; returns the batch's row count.

        Of several batch rows with one key the newest is taken.  An empty batch
        publishes nothing.  If another writer publishes meanwhile, the buckets that
        both touch are merged again over what it published, so neither batch is lost.
        """
        last = self._published()
        incoming = Observation("incoming")
        rows = latest_per_key(conform(batch, self.contract), list(self.contract.unique), newest, tiebreak)
        counted = rows.observe(incoming, F.count(F.lit(1)).alias("rows"))
        # The batch feeds both sides of the merge: written once, read twice.
        folder, touched = self._write(counted, "batch", last.buckets)
        count = int(incoming.get["rows"])
        if count == 0:
            return 0
        done: dict[int, tuple[str | None, str]] = {}  # by bucket: what was merged over, and where it is now
        for _ in range(ATTEMPTS):
            old = {b: last.folders.get(b) for b in touched}
            open_ = [b for b in touched if b not in done or done[b][0] != old[b]]
            done |= {b: (None, f"{folder}/{BUCKET}={b}") for b in open_ if old[b] is None}
            known = [b for b in open_ if old[b] is not None]
            if known:
                state = self._rows([old[b] for b in known])
                batch_rows = self._rows([f"{folder}/{BUCKET}={b}" for b in known])
                place, _ = self._write(merged(state, batch_rows, list(self.contract.unique)), "merge", last.buckets)
                done |= {b: (old[b], f"{place}/{BUCKET}={b}") for b in known}
            if self._publish(Manifest(last.version + 1, last.buckets, last.folders | {b: done[b][1] for b in touched})):
                return count
            last = self._published()
        raise RuntimeError(f"other writers published to {self._root} {ATTEMPTS} times during one upsert; nothing was changed")

    def _write(self, rows: DataFrame, purpose: str, buckets: int) -> tuple[str, list[int]]:
        """Write rows to a new folder by bucket; gives its name and the buckets that have rows."""
        folder = f"{purpose}-{uuid.uuid4().hex}"
        placed = rows.withColumn(BUCKET, self._bucket(buckets)).hint("rebalance", BUCKET)
        placed.write.partitionBy(BUCKET).parquet(f"{self._root}/{folder}")
        fs, _ = self._files()
        names = [e.getPath().getName() for e in fs.listStatus(self._path(folder))]
        return folder, sorted(int(n.removeprefix(f"{BUCKET}=")) for n in names if n.startswith(BUCKET))

    def _publish(self, state: Manifest) -> bool:
        """Make ``state`` the state of its version; False if another writer has that version.

        The entry is created without overwriting, which one writer can do.
        """
        fs, _ = self._files()
        entry = self._path("log", str(state.version))
        try:
            out = fs.create(entry, False)
        except Py4JJavaError:
            if fs.exists(entry):
                return False
            raise
        folders = {str(b): f for b, f in sorted(state.folders.items())}
        out.write(bytearray((json.dumps({"buckets": state.buckets, "folders": folders}) + END).encode()))
        out.close()
        return True
