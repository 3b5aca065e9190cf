"""Named source tables.

A :class:`Lake` maps the role a table plays (``netbox_vm``, ``nutanix_host``,
...) to where it lives: files, a catalog table, any reader format with options
(JDBC included), or a DataFrame that is already at hand.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import staged


# Formats whose files don't change under a reader; all others are read as they are at that moment.
FILE_FORMATS = ("parquet", "orc", "avro", "json", "csv", "text", "xml")


@dataclass(frozen=True)
class TableSource:
    """Where a table lives.  ``format="table"`` reads a catalog table.

    ``live`` says whether two reads may see different rows; unless given, sources
    that are no files are taken to be.
    """

    format: str
    location: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    live: bool | None = None

    @property
    def may_change(self) -> bool:
        return self.format not in FILE_FORMATS if self.live is None else self.live

    def load(self, spark: SparkSession) -> DataFrame:
        if self.format == "table":
            return as_instants(spark.table(self.location))
        frame = self._reader(spark).load(self.location)
        if self.format == "parquet" and _has_wall_clock(frame):
            # Parquet can read wall-clock columns as UTC instants at the scan,
            # whatever the session's time zone, and time filters reach the files.
            return self._reader(spark).schema(_instant_schema(frame.schema)).load(self.location)
        return as_instants(frame)

    def _reader(self, spark: SparkSession):
        return spark.read.format(self.format).options(**self.options)


class Lake:
    """The tables a check may ask for, by role.

    A check reads a source in more than one branch of its plan.  With ``pinned``, the
    rows and columns a check needs of a source that may change meanwhile are landed
    in the shared folder once, and all branches read that copy.
    """

    def __init__(
        self, spark: SparkSession, tables: Mapping[str, TableSource | JdbcSource | DataFrame], pinned: bool = False
    ):
        self.spark = spark
        self._tables = dict(tables)
        self._pinned = pinned

    def pin(self) -> Lake:
        """The same tables, landed once where they may change."""
        return Lake(self.spark, self._tables, pinned=True)

    def table(self, role: str) -> DataFrame:
        source = self._source(role)
        return source if isinstance(source, DataFrame) else source.load(self.spark)

    def needed(self, role: str, columns: Sequence[str], where: Callable[[], Column] | None = None) -> DataFrame:
        """The rows of a role that a check reads, with their columns; landed if they are to be and may change."""
        rows = self.table(role)
        if where:
            rows = rows.where(where())
        source = self._source(role)
        if not self._pinned or isinstance(source, DataFrame) or not source.may_change:
            return rows
        return staged(rows.select(*dict.fromkeys(columns)), f"pinned-{role}", {})[0]

    def _source(self, role: str) -> TableSource | JdbcSource | DataFrame:
        if role not in self._tables:
            raise KeyError(f"no source table for role {role!r}; known: {sorted(self._tables)}")
        return self._tables[role]


def parquet(location: str) -> TableSource:
    return TableSource("parquet", location)


@dataclass(frozen=True)
class ByRange:
    """Parts of about equal ranges of a number, date or time column, from its least and greatest value."""

    column: str
    parts: int


@dataclass(frozen=True)
class ByHash:
    """Parts by the hash of a key of any type, for keys without an even spread.

    ``hash_sql`` gives the database's whole-number hash of ``{column}``, not negative;
    the default is PostgreSQL's.
    """

    column: str
    parts: int
    hash_sql: str = "(hashtext(cast({column} as text)) & 2147483647)"

    def predicates(self) -> list[str]:
        """One for each part: every row fulfils exactly one, rows without a key the first."""
        hashed = self.hash_sql.format(column=self.column)
        first = f"({hashed} % {self.parts} = 0 or {self.column} is null)"
        return [first, *[f"({hashed} % {self.parts} = {k} and {self.column} is not null)" for k in range(1, self.parts)]]


@dataclass(frozen=True)
class JdbcSource:
    """A database table, read over as many connections as ``by`` has parts, or over one if it is None."""

    url: str
    table: str
    by: ByRange | ByHash | None
    options: Mapping[str, str] = field(default_factory=dict)
    live: bool = True

    @property
    def may_change(self) -> bool:
        return self.live

    def load(self, spark: SparkSession) -> DataFrame:
        if isinstance(self.by, ByHash):
            frame = spark.read.jdbc(self.url, self.table, predicates=self.by.predicates(), properties=dict(self.options))
            return as_instants(frame)
        bounds = {}
        if self.by is not None:
            # One row, from one connection.
            ends = self._reader(spark).option("query", self.bounds_query()).load().first()
            bounds = self.bounds(*ends)
        return as_instants(self._reader(spark).option("dbtable", self.table).options(**bounds).load())

    def bounds_query(self) -> str:
        return f"select min({self.by.column}) as least, max({self.by.column}) as most from {self.table}"

    def bounds(self, least: object, most: object) -> dict[str, str]:
        """Spark's options for the ranges; none for a table without any value.  Values outside and NULL are read too."""
        if least is None:
            return {}
        ends = {"lowerBound": str(least), "upperBound": str(most), "numPartitions": str(self.by.parts)}
        return {"partitionColumn": self.by.column, **ends}

    def _reader(self, spark: SparkSession):
        return spark.read.format("jdbc").options(url=self.url, **self.options)


def jdbc(
    url: str, table: str, by: ByRange | ByHash | None = None, single_connection: bool = False, **options: str
) -> JdbcSource:
    """A database table, read in parallel ``by`` ranges or hashes; one connection only if asked for.

    ``options`` are those of Spark's reader but for its own ways to split a table.
    """
    taken = {"partitionColumn", "lowerBound", "upperBound", "numPartitions", "dbtable", "query", "url"} & set(options)
    if taken:
        raise ValueError(f"{', '.join(sorted(taken))} are set by the source: say how to split the table with by=")
    if single_connection == (by is not None):
        raise ValueError("a database table is read either by parts (by=) or with single_connection=True")
    if by is not None and by.parts < 1:
        raise ValueError("a table has at least one part")
    return JdbcSource(url, table, by, options)


def as_instants(frame: DataFrame) -> DataFrame:
    """Wall-clock timestamps as instants in the session's time zone (UTC)."""
    if not _has_wall_clock(frame):
        return frame
    return frame.select(
        [F.col(f.name).cast("timestamp").alias(f.name) if _is_wall_clock(f) else F.col(f.name) for f in frame.schema]
    )


def _is_wall_clock(column: T.StructField) -> bool:
    return isinstance(column.dataType, T.TimestampNTZType)


def _has_wall_clock(frame: DataFrame) -> bool:
    return any(_is_wall_clock(f) for f in frame.schema)


def _instant_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField(f.name, T.TimestampType() if _is_wall_clock(f) else f.dataType, f.nullable) for f in schema]
    )
