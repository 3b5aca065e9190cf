"""Joining a possibly skewed side to a side with unique keys.

Spark's own skew-join handling needs a shuffle directly below both sides of the
join.  The unique side here comes out of ``latest_per_key`` already partitioned
on its key, which is what saves a shuffle in the normal case but rules that
handling out.  So the heavy keys are looked up first, and only if there are any
is the join salted.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class HeavyKeys:
    """Keys of one column that own a large share of the rows, each with about how many; None stands for NULL."""

    rows: Mapping[object, int] = field(default_factory=dict)

    def __bool__(self) -> bool:
        return bool(self.rows)

    def salts(self, rows_per_salt: int) -> dict[object, int]:
        """Into how many parts the rows of each key go, so that none has many more than ``rows_per_salt``."""
        return {key: max(2, math.ceil(count / rows_per_salt)) for key, count in self.rows.items()}


NO_HEAVY_KEYS = HeavyKeys()

# A key is heavy from one row in HEAVY_SHARE on, so there are at most that many.
HEAVY_SHARE = 100
# Below this many rows one task handles any key.
HEAVY_MIN_ROWS = 500_000


def key_sketches(columns: Sequence[str], share: int = HEAVY_SHARE) -> dict[str, Column]:
    """Aggregates to take along in any pass over a frame that :func:`heavy_from` reads heavy keys from.

    Each is a frequency sketch of fixed size that gives at most ``share`` keys.
    """
    sketches = {f"_top_{c}": F.expr(f"approx_top_k(`{c}`, {share}, 10000)") for c in columns}
    return {"_rows": F.count(F.lit(1)), **sketches}


def heavy_from(
    seen: Mapping[str, object], columns: Sequence[str], min_rows: int = HEAVY_MIN_ROWS, share: int = HEAVY_SHARE
) -> dict[str, HeavyKeys]:
    """Heavy keys of each column, from the values of its :func:`key_sketches`.

    Sketches only steer a join: a key they miss or add changes the partitioning,
    never the result.
    """
    # A key is heavy from one row in ``share`` on, so there are at most that many.
    limit = max((seen["_rows"] or 0) / share, min_rows)
    return {c: HeavyKeys({e["item"]: int(e["count"]) for e in seen[f"_top_{c}"] or [] if e["count"] >= limit}) for c in columns}


def lookup(
    many: DataFrame,
    one: DataFrame,
    many_key: str,
    one_key: str,
    how: str,
    heavy: HeavyKeys = NO_HEAVY_KEYS,
    spread: Column | None = None,
    rows_per_salt: int = HEAVY_MIN_ROWS,
) -> DataFrame:
    """Join ``many`` to ``one``, whose keys are unique; ``how`` is inner, left or left_anti.

    With heavy keys, the rows of each are spread by ``spread`` over as many parts
    as its row count asks for, and the few matching rows of ``one`` are copied to
    each of them; all other rows keep salt 0.  ``spread`` must give a row the same value
    whenever a task is run again, and different values to rows of one key.
    """
    if how not in ("inner", "left", "left_anti"):
        raise ValueError(f"lookup joins are inner, left or left_anti, not {how!r}")
    on = F.col(many_key) == F.col(one_key)
    if not heavy:
        return many.join(one, on, how)
    if spread is None:
        raise ValueError("a salted lookup needs a column to spread rows by")

    salts = heavy.salts(rows_per_salt)
    # A NULL key matches nothing, so its rows may go anywhere.
    nulls = F.lit(salts.pop(None, 1))
    parts = F.lit(1)
    if salts:
        by_key = F.create_map(*[F.lit(x) for pair in salts.items() for x in pair])
        parts = F.coalesce(by_key[F.col(many_key)], F.lit(1))
    many_salt = F.pmod(spread, F.when(F.col(many_key).isNull(), nulls).otherwise(parts)).cast("int")
    copies = F.coalesce(by_key[F.col(one_key)], F.lit(1)) if salts else F.lit(1)
    one_salts = F.sequence(F.lit(0), copies - 1)
    left = many.withColumn("_many_salt", many_salt)
    right = one.withColumn("_one_salt", F.explode(one_salts))
    return left.join(right, on & (F.col("_many_salt") == F.col("_one_salt")), how).drop("_many_salt", "_one_salt")


def repeatable_spread(frame: DataFrame) -> Column:
    """A number that tells rows apart and comes out the same whenever a task is run again.

    That is the row's place in its file for rows of Parquet files; for other
    sources a hash of all columns, which does not tell exact copies apart.
    """
    try:
        known = frame.select("_metadata").schema["_metadata"].dataType.names
    except AnalysisException:
        known = []
    if "row_index" in known:
        return F.xxhash64("_metadata.file_path", "_metadata.row_index")
    return F.xxhash64(*[F.col(name) for name, kind in frame.dtypes if "map<" not in kind])
