"""Quality rules with thresholds taken from the data of each language and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.common import WORD, null_safe_key, require, words
from tallyfield.operators.scale import keyed_join
from tallyfield.session import pin

#: Fences lie this many quartile distances beyond the quartiles.
REACH = 3.0
#: Accuracy of the quantile sketches: ranks are off by at most one in so many.
ACCURACY = 10_000
#: Least quartile distance of each measure, so that a group without spread keeps its ordinary documents.
LEAST_SPREAD = {"symbols": 0.02, "dup_lines": 0.1, "repeats": 0.1, "capitals": 0.1, "length": 0.5}
#: Measures that can be too small, too.
TWO_SIDED = ("length",)


def _windows(tokens: Column, n: Column) -> Column:
    """A 64-bit hash of each window of three words."""
    at = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)))


def _in_order(hashes: Column) -> Column:
    """Windows as (hash, place), sorted; empty for a text without any repeated window."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    nothing = F.array().cast("array<struct<h:bigint,i:int>>")
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), nothing).otherwise(pairs)


def _repeated(order: str) -> Column:
    """Sorted places of the windows that have an equal neighbour in the column ``order``."""
    pairs, h = F.col(order), "h"

    def twin(x: Column, k: Column) -> Column:
        before = (k > 0) & (F.get(pairs, k - 1).getField(h) == x.getField(h))
        return before | F.coalesce(F.get(pairs, k + 1).getField(h) == x.getField(h), F.lit(False))

    return F.sort_array(F.transform(F.filter(pairs, twin), lambda x: x.getField("i")))


def _covered(starts: Column) -> Column:
    """Words inside repeated windows: places p1 < p2 < ... cover min(3, p2 - p1) + ... + 3 of them."""
    return F.aggregate(
        starts,
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("p")),
        lambda acc, p: F.struct((acc.n + F.least(F.lit(3), p - acc.p)).cast("bigint").alias("n"), p.alias("p")),
        lambda acc: acc.n,
    )


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """Counts per document: id, group key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_capitals."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), null_safe_key(*group_cols).alias("key"), F.col(text_col).alias("text"))
    # Each step is a projection of its own, so that the words are split once.
    split = rows.withColumn("words", words(text)).withColumn("n", F.size("words"))
    hashed = split.withColumn("hashes", _windows(F.col("words"), F.col("n")))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    ordered = hashed.withColumn("order", _in_order(F.col("hashes")))
    counted = ordered.withColumn("starts", _repeated("order")).withColumn("lines", lines)
    return counted.select(
        "id",
        "key",
        F.col("n").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _covered(F.col("starts")).alias("n_repeat_words"),
        F.length(F.regexp_replace(text, r"[^A-Z]+", "")).cast("bigint").alias("n_capitals"),
        F.size("lines").cast("bigint").alias("n_lines"),
    )


def _measures() -> dict[str, Column]:
    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)

    return {
        "symbols": share("n_symbols", "word_chars"),
        "dup_lines": share("n_dup_lines", "n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
        "capitals": share("n_capitals", "word_chars"),
        "length": share("word_chars", "n_words"),
    }


def fences(measured: DataFrame, reach: float = REACH, accuracy: int = ACCURACY) -> DataFrame:
    """(key, upper and lower fences per measure) from mergeable quantile sketches of every group.

    Sketches are built before the shuffle and merged after it, so a group of any size costs one sketch
    per task. Only documents that pass the fixed base rules are counted.
    """
    shares = measured.select("key", *[m.alias(name) for name, m in _measures().items()])
    quartiles = shares.groupBy("key").agg(
        *[
            F.percentile_approx(name, [0.25, 0.75], accuracy).alias(name)
            for name in _measures()
        ]
    )
    out = []
    for name, least in LEAST_SPREAD.items():
        low, high = F.col(name)[0], F.col(name)[1]
        spread = F.greatest(high - low, F.lit(least)) * reach
        out.append((high + spread).alias(f"{name}_most"))
        if name in TWO_SIDED:
            out.append((low - spread).alias(f"{name}_least"))
    return quartiles.select("key", *out)


def apply_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_cols: tuple[str, ...] = ("lang", "source"),
    reach: float = REACH,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Base counts, base_failed and kept for every row.

    base_failed: fewer than 50 words, or more than half the words in repeated windows. Other documents
    are kept unless a measure (symbols, repeated lines, repeated words, capitals, word length) lies
    beyond the fence of its language and source. Null languages and sources form groups of their own;
    a group whose documents all fail the base rules has no fences and keeps nothing. Null and empty
    texts have no words and fail. Repeated rows count as often as they occur. An empty table gives no rows.
    """
    require(docs, id_col, text_col, *group_cols)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = pin(measure(docs, id_col, text_col, group_cols).withColumn("base_failed", failed), "measured")
    limits = pin(fences(measured.filter(~F.col("base_failed")), reach, accuracy), "fences")
    joined = keyed_join(measured, limits, ["key"], "left")
    inside = F.lit(True)
    for name, value in _measures().items():
        inside = inside & (value <= F.col(f"{name}_most"))
        if name in TWO_SIDED:
            inside = inside & (value >= F.col(f"{name}_least"))
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    return joined.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "n_capitals", "base_failed", kept.alias("kept"),
    )
