"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    centroids,
    exact_dedup,
    hard_negatives,
    langid,
    line_dedup,
    mixing,
    passage_dedup,
    quality,
    simhash,
    token_store,
    topk,
    toxicity,
)
from tidemark.llm.common import Table, documents, fold
from tidemark.llm.vectors import integer_vectors, scaled, usable


#: Target weights of language and quality, of the tokens of the corpus.
WEIGHTS = {
    "en-good": 0.48, "de-good": 0.16, "fr-good": 0.16, "es-good": 0.12,
    "en-poor": 0.02, "de-poor": 0.02, "fr-poor": 0.02, "es-poor": 0.02,
}


def domains_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled documents: language and labelled quality."""
    marked = labels.where("quality is not null").select(F.col("doc_id").alias("_id"), "quality")
    known = docs.where("lang is not null").join(marked, F.col("doc_id") == F.col("_id"))
    quality_name = F.when(F.col("quality") == 1, "-good").otherwise("-poor")
    return known.select("doc_id", F.concat("lang", quality_name).alias("domain"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), documents(spark, sf_dir, "labels")
    mixer = mixing.fit(docs, domains_of(docs, labels), WEIGHTS)
    rated = mixer.rated
    names = F.array(*[F.lit(d) for d in mixer.classifier.domains])
    likeliest = F.array_position("_posteriors", F.array_max("_posteriors")).cast("int")
    return rated.select(
        "doc_id",
        F.col("_n_tokens").alias("n_tokens"),
        F.get(names, likeliest - 1).alias("domain"),
        F.array_max("_posteriors").alias("posterior"),
        F.col("_rate").alias("rate"),
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.fit(docs, fold(F.col("doc_id"), 4) != 2)
    found = langid.predict(docs, model)
    held_out = fold(F.col("doc_id"), 4) == 2
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.read_documents(spark, token_store.write_store(documents(spark, sf_dir)))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.repeated_lines(documents(spark, sf_dir))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir), digest_all=True)


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passage_dedup.repeated_passages(documents(spark, sf_dir))
    words = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["n"])
    return found.select("doc_id", F.size("spans").alias("n_spans"), words.alias("n_words"), "kept_in")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), documents(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, labels, ~held_out)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(documents(spark, sf_dir))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir, "embeddings").where("label is not null")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = integer_vectors(rows.withColumn("label", label), 256, "label")
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(integer_vectors(documents(spark, sf_dir, "embeddings"), 64), F.col("vec_id") % 20 == 0, 20)


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir, "embeddings").where((F.size("embedding") == 64) & usable(F.col("embedding")))
    vectors = rows.select("vec_id", scaled(F.col("embedding"), 1024).alias("vector"))
    first = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256)
    found = centroids.cluster(vectors, first, many=8, rounds=10, width=64)
    assigned = Table(found.assigned(), "op13-assigned").frame
    # One row for each cluster.
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = assigned.agg(F.sum("distance").alias("inertia"))
    written = [F.sha2(F.lit(",".join(map(str, c))), 256) for c in found.centroids.tolist()]
    digest = F.get(F.array(*written), F.col("cluster")) if written else F.lit(None).cast("string")
    return assigned.join(F.broadcast(sums), "cluster").select(
        "vec_id",
        "cluster",
        "distance",
        "cluster_inertia",
        whole.scalar().alias("inertia"),
        digest.alias("centroid_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_bpe": op2_bpe,
    "op3_langid": op3_langid,
    "op4_token_store": op4_token_store,
    "op5_line_dedup": op5_line_dedup,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_passages": op7_passages,
    "op8_toxicity": op8_toxicity,
    "op9_quality_rules": op9_quality_rules,
    "op10_simhash": op10_simhash,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_topk": op12_topk,
    "op13_centroids": op13_centroids,
}
