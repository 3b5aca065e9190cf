"""Contracts of the result tables and their enforcement.

Enforcement is part of the written projection: a violating row fails its task,
the write job is aborted, and nothing of it becomes visible.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool = False
    max_length: int | None = None
    default: Callable[[], Column] | None = None


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    unique: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, T.DataType.fromDDL(f.type)) for f in self.fields])


def _number_type(field: Field) -> T.DecimalType | None:
    kind = T.DataType.fromDDL(field.type)
    return kind if isinstance(kind, T.DecimalType) else None


# A decimal this wide stands for a number without a declared size.
UNBOUNDED_PRECISION = 38

# First value above each whole-number type's range; its negative is the lowest.
_WHOLE_BOUNDS = {"int": 2**31, "bigint": 2**63}


def _whole(number: int) -> Column:
    """A whole-number literal just wide enough, so that comparing it with a
    decimal costs no fraction digits."""
    return F.lit(str(number)).cast(f"decimal({len(str(abs(number)))},0)")


def _source(frame: DataFrame, field: Field) -> Column:
    """The value offered for a field: the column, else its default, else NULL.

    A default stands in for a column that is not there, not for a NULL in one.
    """
    if field.name in frame.columns:
        return F.col(field.name)
    return field.default() if field.default else F.lit(None)


def _is_fractional(frame: DataFrame, field: Field) -> bool:
    return field.name in frame.columns and isinstance(
        frame.schema[field.name].dataType, (T.DecimalType, T.DoubleType, T.FloatType)
    )


def _rules(frame: DataFrame, field: Field) -> list[tuple[str, Column]]:
    """The ways a row can break a field's contract."""
    value = _source(frame, field)
    rules = []
    number = _number_type(field)
    if field.required:
        rules.append(("not null", value.isNull()))
    if field.max_length is not None:
        rules.append((f"at most {field.max_length} characters", F.length(value) > field.max_length))
    if number is not None and number.precision == UNBOUNDED_PRECISION:
        # The declared type would keep any number, so one that ours does not is not to be changed.
        if field.name in frame.columns and not isinstance(frame.schema[field.name].dataType, T.NullType):
            kept = value.try_cast(number)
            same = kept.cast(frame.schema[field.name].dataType) == value
            rules.append((f"kept exactly by {field.type}", value.isNotNull() & ~F.coalesce(same, F.lit(False))))
    elif number is not None:
        bound = _whole(10 ** (number.precision - number.scale))
        rules.append((f"fits {field.type}", F.abs(F.round(value, number.scale)) >= bound))
    elif field.type in _WHOLE_BOUNDS and _is_fractional(frame, field):
        bound = _WHOLE_BOUNDS[field.type]
        rounded = F.round(value, 0)
        rules.append((f"fits {field.type}", (rounded >= _whole(bound)) | (rounded < _whole(-bound))))
    return rules


def conform(frame: DataFrame, contract: Contract, unique: bool = False) -> DataFrame:
    """``frame`` with exactly the contract's columns and types, defaults filled in.

    A row that breaks the contract fails the query.  Fractions are rounded, not
    cut, where a whole number or a number of digits is declared.  With ``unique`` a
    repeated key fails it as well, in the same pass: rows meet by key once.
    """
    columns = []
    for field in contract.fields:
        value = _source(frame, field)
        number = _number_type(field)
        if number is not None and number.precision < UNBOUNDED_PRECISION:
            value = F.round(value, number.scale)
        elif field.type in _WHOLE_BOUNDS and _is_fractional(frame, field):
            value = F.round(value, 0)
        # Rules come first: an out-of-range value must not reach the cast.
        guarded = value.cast(field.type)
        for rule, broken in reversed(_rules(frame, field)):
            message = F.lit(f"{contract.name}.{field.name} must be: {rule}")
            guarded = F.when(broken, F.raise_error(message)).otherwise(guarded)
        columns.append(guarded.cast(field.type).alias(field.name))
    rows = frame.select(columns)
    if not unique or not contract.unique:
        return rows
    place = F.row_number().over(Window.partitionBy(*contract.unique).orderBy(*contract.unique))
    message = F.lit(f"{contract.name}.({', '.join(contract.unique)}) must be: unique")
    first = contract.unique[0]
    checked = F.when(F.col("_place") > 1, F.raise_error(message)).otherwise(F.col(first)).alias(first)
    return rows.withColumn("_place", place).select(*[checked if c == first else c for c in contract.columns])


def violations(frame: DataFrame, contract: Contract) -> DataFrame:
    """How many rows break each rule: ``column_name, rule, violations``.

    Only broken rules are returned.  One pass, and a second over the keys if the
    contract has a unique key; there the rows too many are counted.
    """
    checks = [(f.name, rule, broken) for f in contract.fields for rule, broken in _rules(frame, f)]
    counts = frame.agg(*[F.count_if(broken).alias(f"c{i}") for i, (_, _, broken) in enumerate(checks)])
    entries = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), F.lit(rule).alias("rule"), F.col(f"c{i}").alias("violations"))
            for i, (name, rule, _) in enumerate(checks)
        ]
    )
    found = counts.select(F.explode(entries).alias("v")).select("v.*")
    if contract.unique:
        repeated = frame.groupBy(*contract.unique).agg((F.count(F.lit(1)) - 1).alias("extra"))
        found = found.unionByName(
            repeated.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("violations")).select(
                F.lit(", ".join(contract.unique)).alias("column_name"), F.lit("unique").alias("rule"), "violations"
            )
        )
    return found.where(F.col("violations") > 0)
