"""Evaluation metrics as aggregates over scored rows."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfield.functions import ratio
from tallyfield.operators.running import top_k_per_group
from tallyfield.operators.scale import prefix_sums
from tallyfield.session import pin


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """One row of binary counts and rates in one pass; a rate with no base is null."""
    y, p = F.col(label), F.col(pred)
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(y == 1).alias("positive"),
        F.count_if(y == 0).alias("negative"),
        F.count_if(p == 1).alias("predicted_positive"),
        F.count_if(p == 0).alias("predicted_negative"),
        F.count_if((p == 1) & (y == 1)).alias("tp"),
        F.count_if((p == 1) & (y == 0)).alias("fp"),
        F.count_if((p == 0) & (y == 1)).alias("fn"),
        F.count_if((p == 0) & (y == 0)).alias("tn"),
    )
    return counts.withColumns(
        {
            "precision": ratio("tp", F.col("tp") + F.col("fp")),
            "recall": ratio("tp", F.col("tp") + F.col("fn")),
            "accuracy": ratio(F.col("tp") + F.col("tn"), "total"),
        }
    )


def auroc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve as a one-row table; equal scores count half.

    Scores are counted first and the running count goes over distinct scores,
    so neither a sort in one task nor a bin limit is involved.
    """
    steps = (
        df.filter(F.col(score).isNotNull())
        .groupBy(score)
        .agg(F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_n"))
    )
    steps = prefix_sums(pin(steps, "scores"), [], [score], {"_upto": F.col("_n")})
    below = F.col("_upto") - F.col("_n") + F.col("_n") / 2
    won = F.sum((F.col("_p") * below).cast("double"))
    return steps.agg(ratio(won, F.sum("_p") * F.sum("_n").cast("double")).alias("auroc"))


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """(label, prediction, n) for every pair that occurs."""
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def per_class_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """(class, support, precision, recall, f1), for classes seen as label or prediction."""
    cells = confusion_matrix(df, label, pred)
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("s"), F.lit(0).cast("bigint").alias("q")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("s"), F.col("n").alias("q")),
    )
    hit = F.when((F.col("label") == F.col("prediction")) & (F.col("s") > 0), F.col("n")).otherwise(0)
    per = (
        cells.select("label", "prediction", "n", F.inline(sides))
        .groupBy("class")
        .agg(F.sum("s").alias("support"), F.sum("q").alias("_predicted"), F.sum(hit).alias("_tp"))
    )
    precision = F.coalesce(ratio("_tp", "_predicted"), F.lit(0.0))
    recall = F.coalesce(ratio("_tp", "support"), F.lit(0.0))
    return (
        per.withColumn("precision", precision)
        .withColumn("recall", recall)
        .withColumn("f1", F.coalesce(ratio(F.col("precision") * F.col("recall") * 2, F.col("precision") + F.col("recall")), F.lit(0.0)))
        .drop("_predicted", "_tp")
    )


def multiclass_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """One row: accuracy, and precision, recall and F1 weighted by class size."""
    per = per_class_metrics(df, label, pred)
    rows = F.sum("support")

    def weighted(c: str) -> Column:
        return ratio(F.sum(F.col(c) * F.col("support")), rows)

    # A class's recall times its size is its number of hits, so this is accuracy.
    return per.agg(
        weighted("recall").alias("accuracy"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
        weighted("f1").alias("f1"),
    )


def drop_nan(df: DataFrame, col: str) -> DataFrame:
    """Rows whose value is a number: neither NaN nor null."""
    return df.filter(F.col(col).isNotNull() & ~F.isnan(col))


def rmse(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Root mean squared error over rows with a prediction."""
    error = F.pow(F.col(label).cast("double") - F.col(pred).cast("double"), F.lit(2.0))
    return drop_nan(df, pred).agg(F.sqrt(F.avg(error)).alias("rmse"))


def ranking_lists(
    recs: DataFrame, truth: DataFrame, k: int, user: str, item: str, score: str, rating: str
) -> DataFrame:
    """(user, predicted, actual): both cut to ``k`` items, best first, ties by item.

    Users on both sides only. The cut comes before any list is built, so a list
    never has more than ``k`` items.
    """
    predicted = _top_list(recs, user, item, score, k, "predicted")
    actual = _top_list(truth, user, item, rating, k, "actual")
    return predicted.join(actual, user)


def _top_list(df: DataFrame, user: str, item: str, by: str, k: int, out: str) -> DataFrame:
    top = top_k_per_group(df, [user], [F.desc(by), F.asc(item)], k, "_rank")
    packed = F.sort_array(F.collect_list(F.struct("_rank", F.col(item).cast("double").alias("item"))))
    return top.groupBy(user).agg(packed.alias("_list")).select(user, F.col("_list.item").alias(out))


def precision_at(df: DataFrame, k: int) -> DataFrame:
    """Mean share of the first ``k`` predicted items that were actually used."""
    hits = F.size(F.array_intersect(F.slice("predicted", 1, k), F.col("actual")))
    return df.agg(F.avg(hits / F.lit(float(k))).alias("precision_at"))


def ndcg_at(df: DataFrame, k: int) -> DataFrame:
    """Mean normalised discounted gain of the first ``k`` items, gain 1 per hit."""
    wanted = F.size(F.array_distinct("actual"))
    gain = _discounted(
        F.transform(
            F.slice("predicted", 1, k),
            lambda x, i: F.when(F.array_contains("actual", x), _discount(i)).otherwise(F.lit(0.0)),
        )
    )
    ideal = _discounted(
        F.transform(F.sequence(F.lit(0), F.least(wanted, F.lit(k)) - 1), lambda i: _discount(i))
    )
    return df.agg(F.avg(F.when(wanted > 0, gain / ideal).otherwise(0.0)).alias("ndcg_at"))


def _discount(i: Column) -> Column:
    return F.lit(1.0) / F.log2((i + 2).cast("double"))


def _discounted(terms: Column) -> Column:
    return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)


def mean_average_precision(df: DataFrame) -> DataFrame:
    """Mean over users of the average precision at each hit, over the number of wanted items."""
    step = F.aggregate(
        F.transform("predicted", lambda x, i: F.struct(F.array_contains("actual", x).alias("hit"), (i + 1).alias("pos"))),
        F.struct(F.lit(0).alias("hits"), F.lit(0.0).alias("total")),
        lambda acc, x: F.struct(
            (acc["hits"] + x["hit"].cast("int")).alias("hits"),
            (
                acc["total"]
                + F.when(x["hit"], (acc["hits"] + 1) / x["pos"]).otherwise(F.lit(0.0))
            ).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    wanted = F.size(F.array_distinct("actual"))
    return df.agg(F.avg(F.when(wanted > 0, step / wanted).otherwise(0.0)).alias("map"))


def ranking_rows(
    recs: DataFrame,
    truth: DataFrame,
    k: int,
    user: str,
    item: str,
    score: str,
    rating: str | None = None,
    truth_items: int | None = None,
) -> DataFrame:
    """(user, wanted, rank, hit): the ``k`` best items of each user, each marked as used or not.

    ``wanted`` is the number of items the user used. The whole truth counts, however long; with
    ``truth_items`` only that many of a user's items, best ``rating`` first, do. One join by user and
    item marks the hits, so nothing is gathered per user. Users on both sides only; a repeated item of
    the truth counts once. Ties go to the smaller item.
    """
    ranked = top_k_per_group(recs, [user], [F.desc(score), F.asc(item)], k, "rank").select(user, item, "rank")
    used = truth.select(user, item).distinct()
    if truth_items:
        if rating is None:
            raise ValueError("truth_items needs a rating to choose by")
        used = truth.groupBy(user, item).agg(F.max(rating).alias("_by"))
        used = top_k_per_group(used, [user], [F.desc("_by"), F.asc(item)], truth_items, "_rank")
    used = pin(used.select(user, item), "used")
    sizes = used.groupBy(user).agg(F.count(F.lit(1)).alias("wanted"))
    marked = ranked.join(used.withColumn("_hit", F.lit(1)), [user, item], "left").join(sizes, user)
    return marked.select(user, "wanted", "rank", F.coalesce("_hit", F.lit(0)).alias("hit"))


def _ranked_users() -> Column:
    """Users of ranking rows: each has exactly one first place."""
    return F.count_if(F.col("rank") == 1)


def hit_precision(rows: DataFrame, k: int) -> DataFrame:
    """Mean share of the first ``k`` places that are hits, from ranking rows; places left empty count as misses."""
    hits = F.sum(F.when(F.col("rank") <= k, F.col("hit")).otherwise(0))
    return rows.agg(ratio(hits, _ranked_users() * k).alias("precision_at"))


def hit_ndcg(rows: DataFrame, k: int) -> DataFrame:
    """Mean normalised discounted gain of the first ``k`` places, from ranking rows.

    A hit adds its discount over the best sum the user could reach, so gains add up over all rows at once.
    """
    best, total = [], 0.0
    for place in range(1, k + 1):
        total += 1.0 / math.log2(place + 1)
        best.append(F.lit(total))
    ideal = F.element_at(F.array(*best), F.least(F.col("wanted"), F.lit(k)).cast("int"))
    gain = F.when((F.col("rank") <= k) & (F.col("hit") == 1), F.lit(1.0) / F.log2(F.col("rank") + F.lit(1.0)) / ideal)
    return rows.agg(ratio(F.sum(F.coalesce(gain, F.lit(0.0))), _ranked_users()).alias("ndcg_at"))


def hit_average_precision(rows: DataFrame, user: str) -> DataFrame:
    """Mean over users of the precision at each hit, over the number of wanted items, from ranking rows."""
    upto = Window.partitionBy(user).orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = rows.withColumn("_hits", F.sum("hit").over(upto))
    gain = F.when(F.col("hit") == 1, F.col("_hits") / F.col("rank") / F.col("wanted")).otherwise(0.0)
    return counted.agg(ratio(F.sum(gain), _ranked_users()).alias("map"))


def compare_samplings(
    splits: dict[str, tuple[DataFrame, DataFrame]],
    fit_predict: Callable[[DataFrame, DataFrame], DataFrame],
    label: str,
    pred: str,
    score: str,
) -> DataFrame:
    """The same model over several (train, test) parts, one row of metrics per sampling."""
    out = None
    for name, (train, test) in splits.items():
        scored = fit_predict(train, test)
        row = confusion(scored, label, pred).withColumn("auroc", auroc(scored, label, score).scalar())
        row = row.select(F.lit(name).alias("sampling"), "*")
        out = row if out is None else out.unionByName(row)
    return out
