"""Evaluation metrics over scored rows and ranked lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfield.catalog.registry import query
from tallyfield.catalog.views import Tables
from tallyfield.operators.evaluation import (
    auroc,
    confusion,
    confusion_matrix,
    hit_average_precision,
    hit_ndcg,
    hit_precision,
    mean_average_precision,
    multiclass_metrics,
    ndcg_at,
    per_class_metrics,
    precision_at,
    ranking_lists,
    ranking_rows,
    rmse,
)
from tallyfield.operators.scale import keyed_join


def _rounded(df, *cols, places: int = 6):
    return df.withColumns({c: F.round(c, places) for c in cols})


@query(
    "confusion_counts",
    """SELECT count(*) AS total, count(*) FILTER (y = 1) AS positive, count(*) FILTER (y = 0) AS negative,
              count(*) FILTER (yhat = 1) AS predicted_positive, count(*) FILTER (yhat = 0) AS predicted_negative,
              count(*) FILTER (yhat = 1 AND y = 1) AS tp, count(*) FILTER (yhat = 1 AND y = 0) AS fp,
              count(*) FILTER (yhat = 0 AND y = 1) AS fn, count(*) FILTER (yhat = 0 AND y = 0) AS tn,
              round(count(*) FILTER (yhat = 1 AND y = 1) / nullif(count(*) FILTER (yhat = 1), 0)::DOUBLE, 6) AS precision,
              round(count(*) FILTER (yhat = 1 AND y = 1) / nullif(count(*) FILTER (y = 1), 0)::DOUBLE, 6) AS recall,
              round(count(*) FILTER (yhat = y) / count(*)::DOUBLE, 6) AS accuracy
       FROM scored""",
)
def _(t: Tables):
    return _rounded(confusion(t.scored, "y", "yhat"), "precision", "recall", "accuracy")


@query(
    "area_under_roc",
    """WITH ranked AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS r FROM scored)
       SELECT round((sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0::DOUBLE)
                    / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0))::DOUBLE, 6) AS auroc FROM ranked""",
)
def _(t: Tables):
    return _rounded(auroc(t.scored, "y", "score"), "auroc")


PER_CLASS = """
    WITH classes AS (SELECT cls AS c FROM scored UNION SELECT cls_hat FROM scored),
         per AS (SELECT c, (SELECT count(*) FROM scored WHERE cls = c) AS support,
                        (SELECT count(*) FROM scored WHERE cls_hat = c) AS predicted,
                        (SELECT count(*) FROM scored WHERE cls = c AND cls_hat = c) AS hits FROM classes),
         rates AS (SELECT c, support, coalesce(hits / nullif(predicted, 0)::DOUBLE, 0) AS p,
                          coalesce(hits / nullif(support, 0)::DOUBLE, 0) AS r FROM per),
         f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f1 FROM rates)"""


@query(
    "per_class_metrics",
    PER_CLASS
    + ' SELECT c AS "class", support, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1 FROM f',
)
def _(t: Tables):
    return _rounded(per_class_metrics(t.scored, "cls", "cls_hat"), "precision", "recall", "f1")


@query(
    "multiclass_metrics",
    PER_CLASS
    + """ SELECT round((SELECT count(*) FROM scored WHERE cls = cls_hat) / (SELECT count(*) FROM scored)::DOUBLE, 6) AS accuracy,
            round(sum(p * support) / sum(support), 6) AS weighted_precision,
            round(sum(r * support) / sum(support), 6) AS weighted_recall,
            round(sum(f1 * support) / sum(support), 6) AS f1 FROM f""",
)
def _(t: Tables):
    out = multiclass_metrics(t.scored, "cls", "cls_hat")
    return _rounded(out, "accuracy", "weighted_precision", "weighted_recall", "f1")


@query(
    "confusion_matrix",
    "SELECT cls AS label, cls_hat AS prediction, count(*) AS n FROM scored GROUP BY cls, cls_hat",
)
def _(t: Tables):
    return confusion_matrix(t.scored, "cls", "cls_hat")


@query(
    "root_mean_squared_error",
    "SELECT round(sqrt(avg(pow(y - score, 2))), 6) AS rmse FROM scored WHERE score <> 0",
)
def _(t: Tables):
    pred = F.when(F.col("score") == 0, F.lit(float("nan"))).otherwise(F.col("score"))
    return _rounded(rmse(t.scored.withColumn("pred", pred), "y", "pred"), "rmse")


# Predicted: the user's items by largest line price; actual: by plays.
LISTS = """
    WITH offers AS (SELECT o_custkey AS user_id, l_partkey AS item_id, max(l_extendedprice) AS score
                    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2),
         p AS (SELECT * FROM (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS pos FROM offers) WHERE pos <= 10),
         a AS (SELECT * FROM (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY play_count DESC, item_id) AS pos FROM plays) WHERE pos <= 10),
         users AS (SELECT user_id, count(*) AS wanted FROM a WHERE user_id IN (SELECT user_id FROM p) GROUP BY user_id),
         hits AS (SELECT p.user_id, p.pos, row_number() OVER (PARTITION BY p.user_id ORDER BY p.pos) AS so_far
                  FROM p JOIN a ON p.user_id = a.user_id AND p.item_id = a.item_id)"""


def _offers(t: Tables):
    lines = t("lineitem").select("l_orderkey", F.col("l_partkey").alias("item_id"), "l_extendedprice")
    orders = t("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id"))
    return (
        keyed_join(lines, orders, ["l_orderkey"], "inner")
        .groupBy("user_id", "item_id")
        .agg(F.max("l_extendedprice").alias("score"))
    )


def _lists(t: Tables):
    return ranking_lists(_offers(t), t.plays, 10, "user_id", "item_id", "score", "play_count")


@query(
    "ranking_lists",
    LISTS
    + """ SELECT p.user_id, p.items AS predicted, a.items AS actual FROM
            (SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY pos) AS items FROM p GROUP BY user_id) p JOIN
            (SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY pos) AS items FROM a GROUP BY user_id) a
            ON p.user_id = a.user_id""",
)
def _(t: Tables):
    def joined(c: str):
        return F.array_join(F.col(c).cast("array<bigint>").cast("array<string>"), ",").alias(c)

    return _lists(t).select("user_id", joined("predicted"), joined("actual"))


@query(
    "precision_at_5",
    LISTS
    + """ SELECT round(avg(coalesce(n, 0) / 5.0::DOUBLE), 6) AS precision_at FROM users
          LEFT JOIN (SELECT user_id, count(*) AS n FROM hits WHERE pos <= 5 GROUP BY user_id) h ON users.user_id = h.user_id""",
)
def _(t: Tables):
    return _rounded(precision_at(_lists(t), 5), "precision_at")


@query(
    "ndcg_at_10",
    LISTS
    + """, gain AS (SELECT user_id, sum(1 / log2(pos + 1)) AS g FROM hits WHERE pos <= 10 GROUP BY user_id),
           ideal AS (SELECT user_id, sum(1 / log2(i + 1)) AS g FROM (SELECT user_id, unnest(range(1, least(wanted, 10) + 1)) AS i FROM users) GROUP BY user_id)
          SELECT round(avg(coalesce(gain.g, 0) / ideal.g), 6) AS ndcg_at FROM ideal LEFT JOIN gain ON ideal.user_id = gain.user_id""",
)
def _(t: Tables):
    return _rounded(ndcg_at(_lists(t), 10), "ndcg_at")


@query(
    "mean_average_precision",
    LISTS
    + """ SELECT round(avg(coalesce(s, 0) / wanted), 6) AS map FROM users
          LEFT JOIN (SELECT user_id, sum(so_far / pos::DOUBLE) AS s FROM hits GROUP BY user_id) h ON users.user_id = h.user_id""",
)
def _(t: Tables):
    return _rounded(mean_average_precision(_lists(t)), "map")


# The same with every even-numbered item a user bought as the truth, or with the 3 most played of them.
TRUTH = """
    WITH offers AS (SELECT o_custkey AS user_id, l_partkey AS item_id, max(l_extendedprice) AS score
                    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2),
         p AS (SELECT * FROM (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS pos FROM offers) WHERE pos <= 10),
         ranked AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY play_count DESC, item_id) AS pos
                    FROM plays WHERE item_id % 2 = 0),
         a AS (SELECT user_id, item_id FROM ranked WHERE pos <= {cut}),
         users AS (SELECT user_id, count(*) AS wanted FROM a WHERE user_id IN (SELECT user_id FROM p) GROUP BY user_id),
         places AS (SELECT p.user_id, wanted, pos, CAST(a.item_id IS NOT NULL AS INTEGER) AS hit
                    FROM p JOIN users ON p.user_id = users.user_id
                    LEFT JOIN a ON p.user_id = a.user_id AND p.item_id = a.item_id)"""
FORMS = {"whole_truth": (1_000_000_000, None), "truth_of_3": (3, 3)}


def _places(t: Tables, cut: int | None):
    truth = t.plays.filter(F.col("item_id") % 2 == 0)
    return ranking_rows(_offers(t), truth, 10, "user_id", "item_id", "score", "play_count", cut)


def _ranking_queries(form: str, limit: int, cut: int | None) -> None:
    head = TRUTH.format(cut=limit)

    @query(f"ranking_places_{form}", head + " SELECT user_id, wanted, pos AS rank, hit FROM places")
    def _(t: Tables):
        return _places(t, cut)

    @query(
        f"precision_at_5_{form}",
        head + """ SELECT round(sum(hit) FILTER (pos <= 5) / (5.0::DOUBLE * count(DISTINCT user_id)), 6) AS precision_at FROM places""",
    )
    def _(t: Tables):
        return _rounded(hit_precision(_places(t, cut), 5), "precision_at")

    @query(
        f"ndcg_at_10_{form}",
        head + """, gain AS (SELECT user_id, sum(hit / log2(pos + 1)) AS g FROM places GROUP BY user_id),
           ideal AS (SELECT user_id, sum(1 / log2(i + 1)) AS g FROM (SELECT user_id, unnest(range(1, least(wanted, 10) + 1)) AS i FROM users) GROUP BY user_id)
          SELECT round(avg(gain.g / ideal.g), 6) AS ndcg_at FROM ideal JOIN gain ON ideal.user_id = gain.user_id""",
    )
    def _(t: Tables):
        return _rounded(hit_ndcg(_places(t, cut), 10), "ndcg_at")

    @query(
        f"mean_average_precision_{form}",
        head + """, run AS (SELECT *, sum(hit) OVER (PARTITION BY user_id ORDER BY pos) AS so_far FROM places),
           per AS (SELECT user_id, sum(hit * so_far / pos::DOUBLE) / max(wanted) AS s FROM run GROUP BY user_id)
          SELECT round(avg(s), 6) AS map FROM per""",
    )
    def _(t: Tables):
        return _rounded(hit_average_precision(_places(t, cut), "user_id"), "map")


for _form, (_limit, _cut) in FORMS.items():
    _ranking_queries(_form, _limit, _cut)
