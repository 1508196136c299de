"""Queries that evaluate fixed predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.functions.scalar import indicator
from statloom.operators import evaluate
from statloom.plans.profiling import rounded
from statloom.plans.registry import query
from statloom.sources.tables import table

SCORED = """
    (SELECT doc_id, quality, (n_chars % 100) / 100.0::double AS score,
            CASE WHEN (n_chars % 100) / 100.0::double >= 0.5 THEN 1 ELSE 0 END AS predicted
     FROM labels JOIN documents USING (doc_id))
"""


def scored(spark, root):
    """Labelled documents with a score taken from their length, and its class at 0.5."""
    lengths = table(spark, root, "documents").select("doc_id", "n_chars")
    score = (F.col("n_chars") % 100) / F.lit(100.0)
    return (
        table(spark, root, "labels")
        .join(lengths, "doc_id")
        .select("doc_id", "quality", score.alias("score"), indicator(score >= 0.5).alias("predicted"))
    )


@query(
    "probability_class",
    "F14",
    f"SELECT doc_id, predicted, round(score * 100, 2) AS percent FROM {SCORED}",
)
def probability_class(spark, root):
    return scored(spark, root).select("doc_id", "predicted", F.round(F.col("score") * 100, 2).alias("percent"))


@query(
    "regression_metrics",
    "E1 E2 E3",
    """
    SELECT round(avg(abs(l_extendedprice - 2000 * l_quantity)), 2) AS mae,
           round(sqrt(avg((l_extendedprice - 2000 * l_quantity) ** 2)), 2) AS rmse,
           round(1 - sum((l_extendedprice - 2000 * l_quantity) ** 2) / (var_pop(l_extendedprice) * count(*)), 4) AS r2
    FROM lineitem
    """,
)
def regression_metrics(spark, root):
    lines = table(spark, root, "lineitem")
    metrics = evaluate.regression_metrics(lines, "l_extendedprice", F.col("l_quantity") * 2000)
    return metrics.select(F.round("mae", 2).alias("mae"), F.round("rmse", 2).alias("rmse"), F.round("r2", 4).alias("r2"))


@query(
    "binary_metrics",
    "E4 E5",
    f"""
    WITH c AS (SELECT count(*) FILTER (quality = 1 AND predicted = 1) AS tp, count(*) FILTER (quality = 0 AND predicted = 1) AS fp,
                      count(*) FILTER (quality = 1 AND predicted = 0) AS fn, avg((quality = predicted)::int) AS acc FROM {SCORED})
    SELECT round(acc, 4) AS accuracy, round(tp / (tp + fp), 4) AS precision, round(tp / (tp + fn), 4) AS recall,
           round(2 * tp / (2 * tp + fp + fn), 4) AS f1 FROM c
    """,
)
def binary_metrics(spark, root):
    metrics = evaluate.binary_metrics(scored(spark, root), "quality", "predicted")
    return rounded(metrics, "accuracy", "precision", "recall", "f1")


@query(
    "confusion",
    "E8",
    f"""
    SELECT a.c AS actual, p.c AS predicted, count(s.doc_id) AS n
    FROM (VALUES (0), (1)) a(c), (VALUES (0), (1)) p(c)
    LEFT JOIN {SCORED} s ON s.quality = a.c AND s.predicted = p.c GROUP BY 1, 2
    """,
)
def confusion(spark, root):
    return evaluate.confusion(scored(spark, root), "quality", "predicted")


@query(
    "class_report",
    "E6",
    f"""
    WITH k AS (SELECT c, (SELECT count(*) FROM {SCORED} WHERE quality = c AND predicted = c) AS hit,
                      (SELECT count(*) FROM {SCORED} WHERE quality = c) AS support,
                      (SELECT count(*) FROM {SCORED} WHERE predicted = c) AS guessed FROM (VALUES (0), (1)) v(c)),
    m AS (SELECT c::varchar AS label, hit / guessed AS precision, hit / support AS recall,
                 2 * hit / (guessed + support) AS f1, support, hit FROM k),
    r AS (SELECT label, precision, recall, f1, support FROM m
          UNION ALL SELECT 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support), sum(support)::bigint FROM m
          UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::bigint FROM m
          UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                           sum(f1 * support) / sum(support), sum(support)::bigint FROM m)
    SELECT label, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1, support FROM r
    """,
)
def class_report(spark, root):
    report = evaluate.classification_report(scored(spark, root), "quality", "predicted")
    return rounded(report, "precision", "recall", "f1")


@query(
    "roc_curve",
    "E9",
    f"""
    WITH s AS {SCORED},
    g AS (SELECT score, count(*) FILTER (quality = 1) AS pos, count(*) FILTER (quality = 0) AS neg FROM s GROUP BY 1)
    SELECT score AS threshold, round(sum(neg) OVER w / sum(neg) OVER (), 4) AS fpr,
           round(sum(pos) OVER w / sum(pos) OVER (), 4) AS tpr
    FROM g WINDOW w AS (ORDER BY score DESC)
    UNION ALL SELECT NULL, 0, 0
    """,
)
def roc_curve(spark, root):
    return rounded(evaluate.roc_curve(scored(spark, root), "quality", "score"), "fpr", "tpr")


@query(
    "roc_auc",
    "E7",
    f"""
    WITH s AS {SCORED}
    SELECT round(sum(CASE WHEN p.score > n.score THEN 1 WHEN p.score = n.score THEN 0.5 ELSE 0 END) / count(*), 6)::double AS auc
    FROM s p JOIN s n ON p.quality = 1 AND n.quality = 0
    """,
)
def roc_auc(spark, root):
    return evaluate.roc_auc(scored(spark, root), "quality", "score").select(F.round("auc", 6).alias("auc"))


@query(
    "roc_auc_orders",
    "E7",
    """
    WITH g AS (SELECT o_totalprice AS score, count(*) FILTER (o_orderstatus = 'F') AS pos,
                      count(*) FILTER (o_orderstatus <> 'F') AS neg FROM orders GROUP BY 1),
    w AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) - pos AS above FROM g)
    SELECT round(sum(neg * (above + pos / 2)) / (sum(pos) * sum(neg)), 6)::double AS auc FROM w
    """,
)
def roc_auc_orders(spark, root):
    """Nearly every order has a score of its own: the case a window over all scores would not survive."""
    orders = table(spark, root, "orders").select(
        indicator(F.col("o_orderstatus") == "F").alias("done"), "o_totalprice"
    )
    return evaluate.roc_auc(orders, "done", "o_totalprice").select(F.round("auc", 6).alias("auc"))
