"""Landed pages of a paged JSON inventory.

Whoever lands a page writes the address it was fetched from into it as ``url``, so
that the chain of ``next`` links can be followed over the landed pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the inventory keeps clusters of this type only.
CLUSTER_TYPE_SLUG = "acropolis-cls"

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("next", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField(
            "results",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.IntegerType()),
                        T.StructField("display", T.StringType()),
                        T.StructField("name", T.StringType()),
                        T.StructField(
                            "type",
                            T.StructType(
                                [T.StructField("display", T.StringType()), T.StructField("slug", T.StringType())]
                            ),
                        ),
                    ]
                )
            ),
        ),
    ]
)


def read_pages(spark: SparkSession, location: str, multiline: bool = False) -> DataFrame:
    """Pages as landed, one JSON object per line, or per file with ``multiline``.

    A page that is not JSON fails the read; skipping it would lose records.
    """
    reader = spark.read.schema(PAGE_SCHEMA).option("mode", "FAILFAST").option("multiLine", multiline)
    return reader.json(location)


def chain_faults(pages: DataFrame) -> DataFrame:
    """One row: what keeps the pages from being one whole chain, by kind; zeros if nothing does.

    ``missing``: addresses some page links to that were not landed; ``repeated``: addresses
    landed more than once; ``forked``: addresses more than one page links to; ``beginnings``:
    pages no page links to, less the one there has to be; ``unnamed``: pages without an
    address; ``short``: records too few (or too many, negative) against the total that
    the pages announce, where they do.

    Pages and links meet by address in one aggregate; records are only counted.
    """
    records = F.coalesce(F.size("results"), F.lit(0)).cast("bigint")
    page = F.struct(F.col("url").alias("at"), F.lit(1).alias("page"), F.lit(0).alias("link"), records.alias("n"), "count")
    link = F.struct(
        F.col("next").alias("at"), F.lit(0).alias("page"), F.lit(1).alias("link"), F.lit(0).cast("bigint").alias("n"),
        F.lit(None).cast("bigint").alias("count"),
    )
    places = pages.select(F.explode(F.array(page, link)).alias("e")).select("e.*").groupBy("at")
    places = places.agg(*[F.sum(c).alias(c) for c in ("page", "link", "n")], F.max("count").alias("count"))
    known = F.col("at").isNotNull()
    return places.agg(
        F.count_if(known & (F.col("page") == 0)).alias("missing"),
        F.count_if(known & (F.col("page") > 1)).alias("repeated"),
        F.count_if(known & (F.col("link") > 1)).alias("forked"),
        (F.count_if(known & (F.col("link") == 0)) - F.least(F.count_if(known), F.lit(1))).alias("beginnings"),
        F.coalesce(F.sum(F.when(~known, F.col("page"))), F.lit(0)).alias("unnamed"),
        F.coalesce(F.max("count") - F.sum("n"), F.lit(0)).alias("short"),
    )


def whole_chain(pages: DataFrame) -> DataFrame:
    """The pages, if they are one whole chain from a first to a last page; the query fails otherwise.

    Reading pages can't follow links, so it could miss a page that following them
    would have met.  No pages are a chain as well.  Rings of pages beside the chain
    show in the announced total only.
    """
    faults = chain_faults(pages)
    kinds = [c for c in faults.columns]
    told = F.concat_ws(", ", *[F.when(F.col(k) != 0, F.concat(F.lit(f"{k} "), F.col(k).cast("string"))) for k in kinds])
    fault = F.raise_error(F.concat(F.lit("the landed pages are no whole chain: "), told))
    checked = faults.select(F.when(told == "", F.lit(True)).otherwise(fault).alias("whole"))
    return pages.where(checked.scalar())


def page_records(pages: DataFrame) -> DataFrame:
    """One row per record of any page: ``id, name, type_display, type_slug``.

    The name is ``display``, or ``name`` where ``display`` is missing or empty.
    """
    record = pages.select(F.explode("results").alias("r"))
    return record.select(
        F.col("r.id").alias("id"),
        F.coalesce(F.nullif(F.col("r.display"), F.lit("")), F.col("r.name")).alias("name"),
        F.col("r.type.display").alias("type_display"),
        F.col("r.type.slug").alias("type_slug"),
    )


def with_type_slug(records: DataFrame, slug: str = CLUSTER_TYPE_SLUG) -> DataFrame:
    return records.where(F.col("type_slug") == slug)


def cluster_inventory(
    spark: SparkSession, location: str, slug: str = CLUSTER_TYPE_SLUG, multiline: bool = False, chained: bool = True
) -> DataFrame:
    """Records of one type of all landed pages; ``chained=False`` for pages landed without their address."""
    pages = read_pages(spark, location, multiline)
    return with_type_slug(page_records(whole_chain(pages) if chained else pages), slug)
