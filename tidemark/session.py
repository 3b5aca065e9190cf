"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the checks rely on: UTC wall clock and AQE.

    Partition counts, memory and the like are the cluster's business and are
    only set when passed in ``conf`` (``spark__sql__x`` stands for ``spark.sql.x``).
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # The JVM does not compile methods over 8000 bytes of bytecode.  Stages
        # with large expressions (item parsing) run faster as split methods.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the cluster's shared folder.

    The shared folder is ``spark.checkpoint.dir``.  Only a local session may go
    without it (tests, laptops); executors elsewhere could not see a local path.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder when running on {master}")
        shared = tempfile.mkdtemp(prefix="tidemark-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def staged(frame: DataFrame, purpose: str, seen: dict[str, Column]) -> tuple[DataFrame, dict[str, object]]:
    """``frame`` written to the shared folder and read back, with aggregates of it by name.

    Cuts the lineage: what follows is planned with the real size, and a lost
    executor costs a re-read rather than a recomputation.  The aggregates are
    observed in the write; those of no rows at all may be NULL.
    """
    metrics = Observation(purpose)
    location = scratch_dir(frame.sparkSession, purpose)
    columns = [value.alias(name) for name, value in seen.items()]
    frame.observe(metrics, F.count(F.lit(1)).alias("_written"), *columns).write.parquet(location)
    values = {name: metrics.get.get(name) for name in seen}
    return frame.sparkSession.read.schema(frame.schema).parquet(location), values
