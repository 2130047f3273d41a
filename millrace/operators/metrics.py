"""Ranking and threshold metrics of scored rows, from running sums over distinct scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ranges import dealt_by_range


def score_curve(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per (group and) distinct score with running sums over descending scores.

    (by..., score, pos, n, cum_pos, cum_n, all_pos, all_n). Rows are counted per score first, which takes out hot
    scores. The distinct scores are dealt by ranges of (group, score), so a large group lies in many tasks; each task sums
    up its own stretch, and the totals of the stretches before it in its group, of which there is one per task and group,
    are added. Rows without score or label are left out.
    """
    keys = list(by)
    # The group as one value: a struct equals another with the same NULLs, so it can be joined on like any other key.
    group = F.struct(*keys) if keys else F.lit(0)
    rows = df.select(group.alias("g"), F.col(score).cast("double").alias("score"), F.col(label).cast("long").alias("label"))
    rows = rows.filter(F.col("score").isNotNull() & F.col("label").isNotNull())
    counts = rows.groupBy("g", "score").agg(F.sum("label").alias("pos"), F.count(F.lit(1)).alias("n"))
    stretches = dealt_by_range(counts, ["g", F.col("score").desc()], "curve")

    totals = stretches.groupBy("g", "part").agg(F.sum("pos").alias("p_pos"), F.sum("n").alias("p_n"))
    whole = Window.partitionBy("g")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "g", "part",
        F.coalesce(F.sum("p_pos").over(before), F.lit(0)).alias("o_pos"),
        F.coalesce(F.sum("p_n").over(before), F.lit(0)).alias("o_n"),
        F.sum("p_pos").over(whole).alias("all_pos"), F.sum("p_n").over(whole).alias("all_n"),
    )
    upto = Window.partitionBy("g", "part").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = stretches.select(
        "g", "part", "score", "pos", "n",
        F.sum("pos").over(upto).alias("i_pos"), F.sum("n").over(upto).alias("i_n"),
    )
    return running.join(offsets, ["g", "part"]).select(
        *[F.col("g")[key].alias(key) for key in keys], "score", "pos", "n",
        (F.col("i_pos") + F.col("o_pos")).alias("cum_pos"), (F.col("i_n") + F.col("o_n")).alias("cum_n"),
        "all_pos", "all_n",
    )


def ranking_metrics(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., n, n_pos, auc_pr, auc_roc, threshold, f1) per group.

    ``auc_pr`` is the step-wise average precision with tied scores taken together, ``auc_roc`` counts ties as half, and
    ``threshold`` maximises F1 (the lowest one on ties). A group of one class has no ``auc_roc``; one without positives
    has ``auc_pr`` 0.
    """
    curve = score_curve(df, score, label, by)
    precision = F.col("cum_pos") / F.col("cum_n")
    recall = F.try_divide("cum_pos", "all_pos")
    f1 = F.coalesce(F.when(F.col("cum_pos") > 0, 2 * precision * recall / (precision + recall + 1e-9)), F.lit(0.0))
    neg = F.col("n") - F.col("pos")
    best = F.max(F.struct(f1.alias("f1"), (-F.col("score")).alias("_low"), F.col("score").alias("threshold")))
    return (
        curve.groupBy(*by)
        .agg(
            F.sum("n").alias("n"),
            F.sum("pos").alias("n_pos"),
            F.coalesce(F.try_divide(F.sum(precision * F.col("pos")), F.sum("pos")), F.lit(0.0)).alias("auc_pr"),
            F.try_divide(
                F.sum(neg * (F.col("cum_pos") - F.col("pos") / 2)),
                F.sum("pos").cast("double") * F.sum(neg).cast("double"),
            ).alias("auc_roc"),
            best.alias("_best"),
        )
        .select(
            *by, "n", "n_pos", "auc_pr", "auc_roc",
            F.col("_best.threshold").alias("threshold"), F.col("_best.f1").alias("f1"),
        )
    )


def average_precision(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., auc_pr): step-wise area under the precision-recall curve."""
    return ranking_metrics(df, score, label, by).select(*by, "auc_pr")


def roc_auc(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., auc_roc): probability that a positive outranks a negative, ties as half."""
    return ranking_metrics(df, score, label, by).select(*by, "auc_roc")


def optimal_threshold(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., threshold, f1): the score cut with the highest F1, the lowest such cut on ties."""
    return ranking_metrics(df, score, label, by).select(*by, "threshold", "f1")


def classification_metrics(
    df: DataFrame, score: str, label: str, threshold: float | str, by: Sequence[str] = ()
) -> DataFrame:
    """(by..., tp, fp, fn, tn, precision, recall, f1, n, prevalence) at a threshold or threshold column.

    A ratio with a zero denominator is 0. One pass, no shuffle beyond one partial row per task and group.
    """
    cut = F.col(threshold) if isinstance(threshold, str) else F.lit(float(threshold))
    rows = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    said, real = F.col(score) >= cut, F.col(label).cast("long") == 1
    counts = rows.groupBy(*by).agg(
        F.count_if(said & real).alias("tp"), F.count_if(said & ~real).alias("fp"),
        F.count_if(~said & real).alias("fn"), F.count_if(~said & ~real).alias("tn"),
    )

    def ratio(top, bottom):
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *by, "tp", "fp", "fn", "tn",
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (tp + fp + fn + tn).alias("n"),
        ratio(tp + fn, tp + fp + fn + tn).alias("prevalence"),
    )


def best_of_grid(metrics: DataFrame, metric: str, order: str) -> DataFrame:
    """The row with the highest metric, the first in grid order on ties; NULL metrics never win."""
    ranked = metrics.filter(F.col(metric).isNotNull())
    best = F.max_by(F.struct(*metrics.columns), F.struct(F.col(metric), -F.col(order)))
    return ranked.agg(best.alias("b")).filter(F.col("b").isNotNull()).select("b.*")


def promotion_decisions(
    challengers: DataFrame, champion: DataFrame | None, min_auc_pr: float = 0.35, min_auc_roc: float = 0.65
) -> DataFrame:
    """Add ``decision`` to test metrics of challengers: both gates first, then strictly beat the champion's AUC-PR.

    'champion', 'rejected_gate' or 'rejected_champion'. ``champion`` is one row of test metrics, None without one.
    """
    gates = (F.col("auc_pr") >= min_auc_pr) & (F.coalesce(F.col("auc_roc"), F.lit(0.0)) >= min_auc_roc)
    beats = F.lit(True) if champion is None else F.col("auc_pr") > champion.select("auc_pr").scalar()
    decision = F.when(~gates, "rejected_gate").when(~beats, "rejected_champion").otherwise("champion")
    return challengers.withColumn("decision", decision)


def prediction_summary(predictions: DataFrame, prob: str, pred: str) -> DataFrame:
    """One row: scored rows, predicted positives and negatives, mean, least and greatest probability."""
    return predictions.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(pred) == 1).alias("n_pos"),
        F.count_if(F.col(pred) == 0).alias("n_neg"),
        F.avg(prob).alias("mean_prob"),
        F.min(prob).alias("min_prob"),
        F.max(prob).alias("max_prob"),
    )


def retrain_due(df: DataFrame, label: str, last_trained: int, threshold: int) -> DataFrame:
    """One row: labelled rows, how many are new since the last training, and whether that reaches the threshold."""
    counted = df.agg(F.count(label).alias("n_labeled"))
    new = F.col("n_labeled") - F.lit(last_trained)
    return counted.select("n_labeled", new.alias("n_new"), (new >= F.lit(threshold)).alias("is_due"))
