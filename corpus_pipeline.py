"""From a table of documents to token ids in five stages.

Each stage works on all that the one before it kept, given as ``docs``; all but
the last return the columns of ``documents``.  ``run`` writes each stage to the
cluster's shared folder as Parquet and reads it back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, line_dedup, mixing, simhash, toxicity
from tidemark.llm.common import documents
from tidemark.llm.queries import WEIGHTS, domains_of
from tidemark.session import scratch_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model accepts, learned from all labels of these documents."""
    return toxicity.drop_toxic(docs, documents(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of passages that came before; wholly repeated documents go."""
    return line_dedup.drop_repeated_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates by op10's rule: three-word shingles, 2 of 64 bits.

    Lightly edited copies mostly differ in more bits and stay; README has figures.
    """
    return simhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the domains below their weight come more than once.

    Rates are 1 at least: earlier stages choose what goes, and this one keeps all
    they kept.
    """
    labelled = domains_of(docs, documents(spark, sf_dir, "labels"))
    good = tuple(d for d in WEIGHTS if d.endswith("-good"))
    return mixing.mixed(docs, mixing.fit(docs, labelled, WEIGHTS, good, at_least=1.0))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): ids of each text, decoded again, as digests."""
    return bpe.round_trip(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near duplicates", drop_near_duplicates),
    ("mixing", mix),
    ("bpe", encode),
]

#: Learned models decide in two stages, so SQL can't give the rows of ``run``.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            place = scratch_dir(spark, f"pipeline-{k}")
            docs.write.parquet(place)
            docs = spark.read.parquet(place)
    return docs
