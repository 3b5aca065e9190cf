"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8

# Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in a is that for it on was with be as by are this from or have not at an which "
    "der die das und ist nicht mit auf für ein eine den dem des im von zu sich auch als "
    "le la les de des et un une est que qui dans pour pas sur avec par au aux du ne se en "
    "el los las y que del por con para una su al lo como más"
).split()


@dataclass(frozen=True)
class Rule:
    """``metric`` must lie in [low, high]; an end that is None is open."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        value = F.col(self.metric)
        held = F.lit(True)
        if self.low is not None:
            held = held & (value >= self.low)
        if self.high is not None:
            held = held & (value <= self.high)
        return held


RULES = (
    Rule("mean_word_length", "mean_word_chars", 2.0, 25.0),
    Rule("longest_word", "longest_word", None, 1000),
    Rule("symbols", "symbol_ratio", None, 0.25),
    Rule("stop_words", "stop_ratio", 0.03, None),
    Rule("duplicate_lines", "dup_line_ratio", None, 0.35),
    Rule("shouting", "bang_ratio", None, 0.3),
)


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts, ratios and the verdict of every row: ``doc_id`` and the columns below.

    Words are runs of anything but ASCII white space, in the whole text.
    n_repeat_words counts words in 8-word windows that occur twice or more in
    the text.  base_failed: fewer than 20 words, or over 30 % repeated.  kept:
    not base_failed and every rule holds; ``failed`` names the rules that do not.

    NULL and empty texts have no words and fail the base rule; ratios without a
    denominator are 0.  Repeated rows and ids are judged row by row.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    base = docs.select(docs["doc_id"], text.alias("_text"))
    base = base.select("doc_id", "_text", F.array_remove(F.split("_text", SPACES), "").alias("_words"))
    base = base.select(
        "doc_id",
        F.col("_words"),
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.regexp_count("_text", F.lit("!")).alias("_bangs"),
        F.array_compact(
            F.transform(F.split("_text", "\n"), lambda line: F.when(line.rlike(r"[^\x20\x09-\x0D]"), line))
        ).alias("_lines"),
        _window_hashes(F.col("_words")).alias("_windows"),
    )
    counted = base.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("_windows")) == F.size("_windows"), F.lit(0))
        .otherwise(_covered(F.col("_windows")))
        .cast("bigint")
        .alias("n_repeat_words"),
        _ratio(F.col("word_chars"), F.col("n_words")).alias("mean_word_chars"),
        _ratio(F.col("n_symbols"), F.col("n_words")).alias("symbol_ratio"),
        _ratio(F.col("_bangs"), F.col("n_words")).alias("bang_ratio"),
        _ratio(F.size("_lines") - F.size(F.array_distinct("_lines")), F.size("_lines")).alias("dup_line_ratio"),
        _ratio(
            F.size(F.filter("_words", lambda w: F.lower(w).isin(STOP_WORDS))), F.col("n_words")
        ).alias("stop_ratio"),
        F.coalesce(F.array_max(F.transform("_words", F.length)), F.lit(0)).alias("longest_word"),
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    failed = F.array_compact(F.array(*[F.when(~rule.holds(), F.lit(rule.name)) for rule in rules]))
    judged = counted.withColumn("base_failed", base_failed).withColumn("failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _window_hashes(words: Column) -> Column:
    """A hash of every run of eight words, by its first position."""
    last = F.size(words) - WINDOW
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i + 1, WINDOW)))


def _covered(windows: Column) -> Column:
    """Words covered by the windows whose hash occurs twice or more.

    Equal hashes stand together after sorting; the positions found are sorted
    again, and each adds its eight words less what the next one covers too.
    """
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.aggregate(
        F.array(placed),
        F.lit(0),
        lambda total, ordered: total + _union_length(_repeated(ordered)),
    )


def _repeated(ordered: Column) -> Column:
    def twin(x: Column, i: Column) -> Column:
        before = F.get(ordered, i - 1)
        after = F.get(ordered, i + 1)
        return F.coalesce(before["h"] == x["h"], F.lit(False)) | F.coalesce(after["h"] == x["h"], F.lit(False))

    return F.array_sort(F.transform(F.filter(ordered, twin), lambda x: x["i"]))


def _union_length(starts: Column) -> Column:
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        starts,
        start,
        lambda acc, i: F.struct(
            (acc["n"] + WINDOW - F.greatest(acc["end"] - i, F.lit(0))).alias("n"), (i + WINDOW).alias("end")
        ),
        lambda acc: acc["n"],
    )
