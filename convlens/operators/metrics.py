"""Binary classification metrics, overall or per group, as tables.

Predictions carry a label of 0 or 1, a predicted class and a score in [0, 1].
Everything starts from counts per (group, class, prediction) or (group, score),
which combine before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convlens import constants as K
from convlens.operators import profile, ranking

CLASSES = ("unharmful", "harmful")


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def outcomes(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp per group."""
    y, p = F.col(label), F.col(pred)
    return df.groupBy(*by).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def confusion_matrix(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """All four cells per group: (label, pred, n); a cell without rows is 0."""
    cells = [
        F.struct(F.lit(y).alias("label"), F.lit(p).alias("pred"), F.col(n).alias("n"))
        for y, p, n in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
    ]
    return outcomes(df, label, pred, by).select(*by, F.inline(F.array(*cells)))


def _scores(tp, fp, fn) -> tuple[Column, Column, Column]:
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return precision, recall, ratio(2 * tp, 2 * tp + fp + fn)


def binary_metrics(df: DataFrame, label: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """n, accuracy, and precision, recall, F1 of the positive class; macro F1."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    precision, recall, f1 = _scores(tp, fp, fn)
    other = _scores(tn, fn, fp)[2]
    n = tn + fp + fn + tp
    return outcomes(df, label, pred, by).select(
        *by,
        n.alias("n"),
        ratio(tp + tn, n).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
        ((f1 + other) / 2).alias("f1_macro"),
    )


def classification_report(df: DataFrame, label: str, pred: str, by: Sequence[str] = (), names: Sequence[str] = CLASSES) -> DataFrame:
    """Rows per class, then accuracy, macro and weighted averages."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    support = (tn + fp, tp + fn)
    per_class = (_scores(tn, fn, fp), _scores(tp, fp, fn))
    accuracy = ratio(tp + tn, n)

    def row(name, values, total):
        cells = [v.alias(c) for v, c in zip(values, ("precision", "recall", "f1"), strict=True)]
        return F.struct(F.lit(name).alias("class"), *cells, total.alias("support"))

    macro = [(a + b) / 2 for a, b in zip(*per_class, strict=True)]
    weighted = [ratio(a * support[0] + b * support[1], n) for a, b in zip(*per_class, strict=True)]
    rows = [
        row(names[0], per_class[0], support[0]),
        row(names[1], per_class[1], support[1]),
        row("accuracy", [accuracy] * 3, n),
        row("macro avg", macro, n),
        row("weighted avg", weighted, n),
    ]
    return outcomes(df, label, pred, by).select(*by, F.inline(F.array(*rows)))


def score_steps(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts at each distinct score, from the highest down.

    `pos`/`neg` at the score, running `tp`/`fp`, and the group totals
    `n_pos`/`n_neg`. Tied scores are one step.
    """
    by = list(by)
    counts = df.groupBy(*by, score).agg(
        F.sum(label).cast("bigint").alias("pos"), F.sum(1 - F.col(label)).cast("bigint").alias("neg")
    )
    return ranking.running_totals(
        counts, [F.desc(score)], -ranking.quantile_bucket(counts, score), {"tp": F.col("pos"), "fp": F.col("neg")}, by,
        {"tp": "n_pos", "fp": "n_neg"},
    )


def roc_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, and the start point at infinity."""
    steps = score_steps(df, label, score, by)
    points = steps.select(
        *by, F.col(score).alias("threshold"), ratio(F.col("fp"), F.col("n_neg")).alias("fpr"),
        ratio(F.col("tp"), F.col("n_pos")).alias("tpr"),
    )
    start = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
    start = start.select(*by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(start)


def pr_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(threshold, precision, recall) at every distinct score, and the end point (1, 0)."""
    steps = score_steps(df, label, score, by)
    points = steps.select(
        *by, F.col(score).alias("threshold"), _step_precision().alias("precision"), _step_recall().alias("recall")
    )
    end = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
    end = end.select(*by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return points.unionByName(end)


def _step_precision() -> Column:
    return F.col("tp") / (F.col("tp") + F.col("fp"))


def _step_recall() -> Column:
    return ratio(F.col("tp"), F.col("n_pos"))


def curve_areas(df: DataFrame, label: str, score: str, by: Sequence[str] = (), target_precision: float = K.TARGET_PRECISION) -> DataFrame:
    """ROC-AUC, average precision, trapezoid PR area and recall at a precision.

    ROC-AUC is null where a group has one class only.
    """
    steps = score_steps(df, label, score, by)
    pos, neg, tp, fp = (F.col(c) for c in ("pos", "neg", "tp", "fp"))
    n_pos, n_neg = F.col("n_pos"), F.col("n_neg")
    before = tp + fp - pos - neg
    last_precision = F.when(before == 0, F.lit(1.0)).otherwise((tp - pos) / before)
    gain = ratio(pos, n_pos)
    both = (F.max("n_pos") > 0) & (F.max("n_neg") > 0)
    area = F.sum(neg * (2 * tp - pos) / 2) / F.max(n_pos * n_neg)
    reached = F.max(F.when(_step_precision() >= target_precision, _step_recall()))
    return steps.groupBy(*by).agg(
        F.max("n_pos").alias("n_pos"),
        F.max("n_neg").alias("n_neg"),
        F.when(both, area).alias("roc_auc"),
        F.sum(gain * _step_precision()).alias("average_precision"),
        F.sum(gain * (_step_precision() + last_precision) / 2).alias("pr_auc"),
        F.coalesce(reached, F.lit(0.0)).alias("recall_at_precision"),
    )


def subgroup_metrics(df: DataFrame, label: str, pred: str, score: str, by: str) -> DataFrame:
    """Metrics and ROC-AUC of each subgroup."""
    return ranking.join_null_safe(
        binary_metrics(df, label, pred, [by]), curve_areas(df, label, score, [by]).select(by, "roc_auc"), [by]
    )


def group_accuracy(df: DataFrame, by: Sequence[str], correct: str = "correct") -> DataFrame:
    """Group size and share of correct predictions."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.avg(F.col(correct).cast("int")).alias("accuracy"))


def miss_rates(df: DataFrame, label: str, pred: str, by: str) -> DataFrame:
    """Missed positives, total positives and miss rate per group; groups without positives are left out."""
    return (
        df.filter(F.col(label) == 1)
        .groupBy(by)
        .agg(F.count_if(F.col(pred) == 0).alias("missed"), F.count("*").alias("total"))
        .withColumn("miss_rate", F.col("missed") / F.col("total"))
    )


def false_alarm_rates(df: DataFrame, label: str, pred: str, by: str) -> DataFrame:
    """False alarms, total negatives and their rate per group, highest rate first; groups without negatives are left out."""
    return (
        df.filter(F.col(label) == 0)
        .groupBy(by)
        .agg(F.count_if(F.col(pred) == 1).alias("false_alarms"), F.count("*").alias("total"))
        .withColumn("false_alarm_rate", F.col("false_alarms") / F.col("total"))
        .orderBy(F.desc("false_alarm_rate"), by)
    )


def calibration(df: DataFrame, label: str, pred: str, score: str, include_lowest: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """n, accuracy and share of positives per tenth of the score, per group; a score of exactly 0 has no bucket."""
    limits = [i / 10 for i in range(11)]
    bucket = profile.cut(F.col(score), limits, include_lowest)
    name = F.format_string("%.1f-%.1f", (F.col("_b") - 1) / 10, F.col("_b") / 10)
    return (
        df.withColumn("_b", bucket)
        .filter("_b is not null")
        .groupBy(*by, "_b")
        .agg(
            F.count("*").alias("n"),
            F.avg((F.col(label) == F.col(pred)).cast("int")).alias("accuracy"),
            F.avg(label).alias("actual_rate"),
        )
        .select(*by, name.alias("bucket"), "n", "accuracy", "actual_rate")
    )


def seed_comparison(results: DataFrame, arm: str, metric: str, baseline: str, candidate: str) -> DataFrame:
    """Medians of two arms, spread of the baseline (ddof 0), their difference, and whether it exceeds the spread."""
    per_arm = results.groupBy(arm).agg(F.median(metric).alias("median"), F.stddev_pop(metric).alias("sigma"))
    base, other = F.col(arm) == baseline, F.col(arm) == candidate
    one = per_arm.agg(
        F.max(F.when(base, F.col("median"))).alias("median_a"),
        F.max(F.when(other, F.col("median"))).alias("median_b"),
        F.max(F.when(base, F.col("sigma"))).alias("sigma_a"),
    )
    return one.withColumn("delta", F.col("median_b") - F.col("median_a")).withColumn(
        "reject", F.col("delta") > F.col("sigma_a")
    )


def best_runs(results: DataFrame, arm: str, metric: str, run: str) -> DataFrame:
    """Best run of each arm; ties go to the lowest run."""
    order = F.struct(F.col(metric), -F.col(run))
    return results.groupBy(arm).agg(F.max_by(run, order).alias(run), F.max(metric).alias(metric))
