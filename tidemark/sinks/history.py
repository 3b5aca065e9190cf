"""Append-only history of findings, one folder and one log entry a run.

A run is written to a folder of its own and then published by an empty file in
the log whose name holds the day, the instant and the counts.  Readers follow the
log: they see a run whole or not at all, know what runs there are without reading
any, and open the folders of the runs they want only.  Counts a day and type come
from the log as well, as a run has one instant.

The small runs of a day can be folded into one folder.  That is published by one
renaming, and readers then take those runs from there; the runs' own folders stay
for the owner's retention rules, so readers that began before are not disturbed.
"""

from __future__ import annotations

import time
import uuid
from datetime import date, datetime, timedelta, timezone
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.ages import resolve_as_of
from tidemark.functions.labels import MISSING, STALE
from tidemark.sinks.contract import Contract, conform

PARTITION = "check_date"
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
#: Folder of a run that found nothing.
NOTHING = "none"
#: In folded days, the folder a row's run was written to.
RUN = "run_folder"


class RunEntry(NamedTuple):
    """A published run: its instant in microseconds since 1970, its counts, its folder's name."""

    check_micros: int
    total: int
    stale: int
    missing: int
    folder: str

    @property
    def check_time(self) -> datetime:
        return EPOCH + timedelta(microseconds=self.check_micros)

    @property
    def day(self) -> date:
        return self.check_time.date()

    @property
    def name(self) -> str:
        return "_".join(str(part) for part in (self.day, *self))

    @property
    def counts(self) -> dict[str, int]:
        """Findings by type, as far as the log tells them apart."""
        return {kind: n for kind, n in ((STALE, self.stale), (MISSING, self.missing)) if n}

    @property
    def told_apart(self) -> bool:
        return self.stale + self.missing == self.total


def append_run(findings: DataFrame, location: str, contract: Contract, as_of: datetime | None = None) -> RunEntry | None:
    """Append conforming findings to the history at ``location`` and publish the run.

    One job: the contract is checked inside the write, unique keys included, and the
    counts are observed on the way, so findings are computed once.  A violation aborts
    the job and leaves the history as it was, as does a writer lost before publishing
    and a frame with more than one check_time.  No findings leave no data: with
    ``as_of`` a run of zeros is published, without it nothing and None comes back.

    Findings are rebalanced first: without it every join task would leave its
    own small file.
    """
    spark = findings.sparkSession
    seen = Observation("written")
    label = F.col("finding_type")
    micros = F.unix_micros("check_time")
    rows = (
        conform(findings, contract, unique=True)
        .hint("rebalance")
        .observe(
            seen,
            F.count(F.lit(1)).alias("total"),
            F.count_if(label == STALE).alias("stale"),
            F.count_if(label == MISSING).alias("missing"),
            F.min(micros).alias("first"),
            F.max(micros).alias("micros"),
        )
    )
    folder = f"run-{uuid.uuid4().hex}"
    rows.write.parquet(f"{location}/runs/{folder}")
    found = seen.get
    if not found["total"] or found["first"] != found["micros"]:
        _files(spark, f"{location}/runs/{folder}", lambda files, path: files.delete(path, True))
        if found["total"]:
            raise ValueError("the findings of a run have one check_time")
        if as_of is None:
            return None
        moment = (resolve_as_of(as_of) - EPOCH) // timedelta(microseconds=1)
        entry = RunEntry(moment, 0, 0, 0, f"{NOTHING}-{uuid.uuid4().hex}")
    else:
        entry = RunEntry(found["micros"], found["total"], found["stale"], found["missing"], folder)
    _files(spark, f"{location}/log/{entry.name}", lambda files, path: files.create(path, False).close())
    return entry


def _files(spark: SparkSession, place: str, do):
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return do(path.getFileSystem(spark._jsc.hadoopConfiguration()), path)


def _names(spark: SparkSession, place: str) -> list[str]:
    return _files(
        spark, place, lambda files, path: [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []
    )


def append_findings(findings: DataFrame, location: str, contract: Contract) -> int:
    """:func:`append_run`, giving the row count."""
    entry = append_run(findings, location, contract)
    return entry.total if entry else 0


def runs(spark: SparkSession, location: str, since: date | None = None) -> list[RunEntry]:
    """The published runs from a day on, oldest first; none for a history that is not there."""
    found = []
    for name in _names(spark, f"{location}/log"):
        _, micros, total, stale, missing, folder = name.split("_")
        found.append(RunEntry(int(micros), int(total), int(stale), int(missing), folder))
    return sorted(e for e in found if since is None or e.day >= since)


def newest_runs(spark: SparkSession, location: str) -> list[RunEntry]:
    """The runs of the newest check that found anything."""
    found = [e for e in runs(spark, location) if e.total]
    return [e for e in found if e.check_micros == found[-1].check_micros]


def read_history(
    spark: SparkSession, location: str, contract: Contract, since: date | None = None, newest: bool = False
) -> DataFrame:
    """The findings of all published runs, of those from a day on, or of the newest check only."""
    wanted = newest_runs(spark, location) if newest else [e for e in runs(spark, location, since) if e.total]
    return _read(spark, location, contract, wanted).drop(RUN).withColumn(PARTITION, F.to_date("check_time"))


def _read(spark: SparkSession, location: str, contract: Contract, wanted: list[RunEntry]) -> DataFrame:
    """The rows of runs, each with its run's folder: from the runs' own folders and from folded days."""
    schema = T.StructType(contract.schema.fields)
    folded = _folded(spark, location, {e.day for e in wanted})
    own, parts = [], []
    by_place: dict[str, list[str]] = {}
    for entry in wanted:
        place, covered = folded.get(entry.day, (None, set()))
        if entry.folder in covered:
            by_place.setdefault(place, []).append(entry.folder)
        else:
            own.append(f"{location}/runs/{entry.folder}")
    if own:
        rows = spark.read.schema(schema).parquet(*own)
        parts.append(rows.select("*", F.regexp_extract("_metadata.file_path", "/runs/([^/]+)/", 1).alias(RUN)))
    if by_place:
        rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(RUN, T.StringType())])).parquet(
            *[f"{location}/days/{place}" for place in sorted(by_place)]
        )
        # A day may have been folded with runs published after the log was listed.
        parts.append(rows.where(F.col(RUN).isin([folder for some in by_place.values() for folder in some])))
    if not parts:
        return spark.createDataFrame([], schema).withColumn(RUN, F.lit(None).cast("string"))
    return reduce(DataFrame.unionByName, parts)


def _folded(spark: SparkSession, location: str, days: set[date]) -> dict[date, tuple[str, set[str]]]:
    """Of each folded day, the folder of its newest folding and the runs in it."""
    newest: dict[str, str] = {}
    for name in _names(spark, f"{location}/folded"):
        day = name.split("_")[0]
        newest[day] = max(name, newest.get(day, name))
    found = {}
    for day in days:
        if name := newest.get(str(day)):
            text = _files(spark, f"{location}/folded/{name}", lambda files, path: _text(spark, files, path))
            found[day] = (name.split("_")[2], set(text.split()))
    return found


def _text(spark: SparkSession, files, path) -> str:
    stream = files.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def fold_day(spark: SparkSession, location: str, contract: Contract, day: date) -> int:
    """Fold the runs of a day into one folder of well-sized files; gives how many runs are in it.

    Rows are kept in order of their runs, so that reading one run skips the rest.
    Readers see the runs' own folders until the folding is published and the folded
    ones after, each row once either way.  Runs that come later keep their own
    folders until the day is folded again.  A day of fewer than two runs stays as it is.
    """
    found = [e for e in runs(spark, location, day) if e.day == day and e.total]
    if len(found) < 2:
        return 0
    place = f"{day}-{uuid.uuid4().hex}"
    rows = _read(spark, location, contract, found).hint("rebalance").sortWithinPartitions("check_time", RUN)
    rows.write.parquet(f"{location}/days/{place}")
    name = f"{day}_{time.time_ns():020d}_{place}"

    def publish(files, path):
        draft = spark._jvm.org.apache.hadoop.fs.Path(f"{location}/drafts/{name}")
        out = files.create(draft, False)
        out.write(bytearray("\n".join(e.folder for e in found).encode()))
        out.close()
        files.mkdirs(path.getParent())
        if not files.rename(draft, path):
            raise RuntimeError(f"could not publish the folded runs of {day}")

    _files(spark, f"{location}/folded/{name}", publish)
    return len(found)


def run_summary(spark: SparkSession, location: str) -> DataFrame:
    """(check_time, total, stale, missing) of every published run, from the log alone."""
    rows = [(e.check_time, e.total, e.stale, e.missing) for e in runs(spark, location)]
    return spark.createDataFrame(rows, "check_time timestamp, total bigint, stale bigint, missing bigint")


def type_counts(spark: SparkSession, location: str, contract: Contract, wanted: list[RunEntry]) -> DataFrame:
    """(check_date, finding_type, count) of each of ``wanted``.

    From the log alone; only runs with findings of other types than it tells apart
    are read.
    """
    rows = [(e.day, kind, n) for e in wanted if e.told_apart for kind, n in e.counts.items()]
    counts = spark.createDataFrame(rows, "check_date date, finding_type string, count bigint")
    others = [e for e in wanted if not e.told_apart]
    if not others:
        return counts
    read = _read(spark, location, contract, others).groupBy(F.to_date("check_time").alias("check_date"), "finding_type")
    return counts.unionByName(read.agg(F.count(F.lit(1)).alias("count")))
