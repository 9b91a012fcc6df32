"""Mix sources to target word counts with nested hash thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.llm.common import null_safe_key, require, word_count
from tallyfield.operators.scale import keyed_join, prefix_sums
from tallyfield.session import pin

#: Weights of the sources in name order, repeating; share of all words to take; most repeats of a document.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
#: Bits of the hash that each level of the histogram looks at: 64 of the row's content, 64 of its place.
LEVELS = (12, 12, 12, 12, 16)


def _digits(content: Column, place: Column) -> Column:
    """A row's hash as an array of level buckets, compared from left to right."""
    out = []
    for value in (content, place):
        left = 64
        for bits in LEVELS:
            left -= bits
            out.append(F.shiftrightunsigned(value, left).bitwiseAND(F.lit((1 << bits) - 1)).cast("int"))
    return F.array(*out)


def source_targets(
    totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS
) -> DataFrame:
    """(key, source, source_size) plus target: weights share ``share`` of all words.

    A target stops at ``repeats`` times its source's size and the excess is shared anew by weight until
    none is above. That is the level at which min(cap, level * weight) sums to the goal: with sources in
    order of cap / weight, the level is found from running sums.
    """
    ranked = prefix_sums(totals, [], [F.col("source").asc_nulls_last()], {"rank": F.lit(1)})
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    capped = pin(
        ranked.withColumn("weight", weight)
        .withColumn("cap", repeats * F.col("source_size").cast("double"))
        .withColumn("ratio", F.col("cap") / F.col("weight")),
        "caps",
    )
    whole = capped.agg(F.sum("source_size"), F.sum("weight")).first()
    if whole[1] is None:
        return capped.withColumn("target", F.lit(0.0)).select("key", "source", "source_size", "target")
    goal = min(share, repeats) * whole[0]
    run = prefix_sums(capped, [], ["ratio", F.col("source").asc_nulls_last()], {"caps": F.col("cap"), "met": F.col("weight")})
    level = (F.lit(goal) - (F.col("caps") - F.col("cap"))) / (F.lit(whole[1]) - (F.col("met") - F.col("weight")))
    open_ = run.withColumn("level", level).filter(F.col("ratio") > F.col("level"))
    found = open_.agg(F.min_by("level", F.struct("ratio", "rank"))).first()[0]
    target = F.col("cap") if found is None else F.least("cap", F.lit(found) * F.col("weight"))
    return capped.withColumn("target", target).select("key", "source", "source_size", "target")


def _with_copies(rows: DataFrame, weights: tuple[int, ...], share: float, repeats: int) -> DataFrame:
    """``rows`` (pinned: key, source, size, digits, ...) plus source_size, target and copies."""
    totals = rows.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    targets = source_targets(totals, weights, share, repeats)
    full = F.when(F.col("source_size") == 0, 0).otherwise(F.floor(F.col("target") / F.col("source_size"))).cast("int")
    bounds = pin(
        targets.withColumn("full", full)
        .withColumn("rest", F.col("target") - F.col("full") * F.col("source_size"))
        .withColumn("prefix", F.array().cast("array<int>"))
        .withColumn("before", F.lit(0).cast("bigint"))
        .withColumn("inside", F.col("source_size"))
        .withColumn("n", F.lit(2).cast("bigint")),
        "bounds",
    )
    columns = bounds.columns
    for depth in range(2 * len(LEVELS)):
        unsure = bounds.filter((F.col("n") > 1) & (F.col("rest") > 0) & (F.size("prefix") == depth))
        if unsure.isEmpty():
            break
        # Only rows of a boundary bucket are looked at again: one bucket in 4096 of each source.
        edge = unsure.select("key", "prefix")
        met = keyed_join(rows.select("key", "size", "digits"), edge, ["key"], "inner")
        met = met.filter(F.slice("digits", 1, depth) == F.col("prefix")) if depth else met
        cells = met.groupBy("key", F.element_at("digits", depth + 1).alias("bucket")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows")
        )
        run = prefix_sums(cells, ["key"], ["bucket"], {"upto": F.col("words")})
        first = (
            run.join(unsure.select("key", "before", "rest"), "key")
            .filter(F.col("before") + F.col("upto") >= F.col("rest"))
            .groupBy("key")
            .agg(F.min_by(F.struct("bucket", "words", "rows", "upto"), "bucket").alias("cut"))
        )
        cut = unsure.join(first, "key").select(
            "key", "source", "source_size", "target", "full", "rest",
            F.concat("prefix", F.array("cut.bucket")).alias("prefix"),
            (F.col("before") + F.col("cut.upto") - F.col("cut.words")).alias("before"),
            F.col("cut.words").alias("inside"),
            F.col("cut.rows").alias("n"),
        )
        settled = bounds.join(first.select("key"), "key", "left_anti")
        bounds = pin(settled.select(columns).unionByName(cut.select(columns)), "bounds")
    # The last bucket is taken when that comes nearer to the budget.
    near = F.abs(F.col("before") + F.col("inside") - F.col("rest")) < F.abs(F.col("before") - F.col("rest"))
    final = pin(
        bounds.select("key", "source_size", "target", "full", "rest", "prefix", near.alias("with_last")), "thresholds"
    )
    joined = keyed_join(rows, final, ["key"], "inner")
    mine = F.slice("digits", 1, F.greatest(F.size("prefix"), F.lit(1)))
    extra = (F.col("rest") > 0) & ((mine < F.col("prefix")) | ((mine == F.col("prefix")) & F.col("with_last")))
    return joined.withColumn("copies", F.col("full") + extra.cast("int"))


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    content = F.xxhash64(F.lit("mix"), F.col(id_col), F.col(source_col), F.col(text_col))
    return [
        F.col(source_col).cast("string").alias("source"),
        null_safe_key(source_col).alias("key"),
        word_count(F.col(text_col)).alias("size"),
        _digits(content, F.xxhash64(F.monotonically_increasing_id())).alias("digits"),
    ]


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
) -> DataFrame:
    """How many words of each document the mix takes: id, source, size, source_size, target, taken.

    Words are summed by source and hash bucket; the bucket in which a source's budget ends is cut finer
    until one row is left, and every document below the threshold is taken, without a sort. A larger
    budget takes a superset of a smaller one. A document is taken once per whole multiple of its
    source and once more below the threshold of the rest. Null sources are a source of their own; null
    and empty texts have size 0; equal rows are told apart by place, so a huge group of copies is cut
    within the group. An empty table gives no rows.
    """
    require(docs, id_col, text_col, source_col)
    rows = pin(docs.select(F.col(id_col).alias("id"), *_rows(docs, id_col, text_col, source_col)), "sizes")
    found = _with_copies(rows, weights, share, repeats)
    return found.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def mixed_rows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
) -> DataFrame:
    """The mixed table itself: rows of ``docs``, each as often as ``mix`` takes it."""
    require(docs, id_col, text_col, source_col)
    whole = pin(docs.select(F.struct(*docs.columns).alias("doc"), *_rows(docs, id_col, text_col, source_col)), "whole")
    found = _with_copies(whole, weights, share, repeats).filter(F.col("copies") > 0)
    repeated = found.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return repeated.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
