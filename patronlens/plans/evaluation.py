"""Model quality as Spark jobs: class metrics, threshold curves, areas and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronlens.functions.numbers import ratio
from patronlens.plans.tables import staged

# Score ranges whose running totals are worked out side by side: at least so many, and as many as
# the session has shuffle partitions.
RANGES = 256


def _rows(weight: str | None):
    """How many rows a row stands for."""
    return F.lit(1) if weight is None else F.col(weight)


def class_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", weight: str | None = None
) -> DataFrame:
    """One row: accuracy, weighted precision, weighted recall and weighted F1.

    With ``weight`` a row counts that often, as if it were repeated.

    The data is read once, into a (label, prediction) count table of a few rows; each of its
    rows then speaks for its true class and for its predicted class.
    """
    counts = df.groupBy(label, prediction).agg(F.sum(_rows(weight)).alias("n"))
    n, hit = F.col("n"), F.when(F.col(label) == F.col(prediction), F.col("n")).otherwise(F.lit(0))
    as_true = F.struct(F.col(label).alias("cls"), n.alias("support"), hit.alias("hits"), F.lit(0).cast("long").alias("predicted"))
    as_predicted = F.struct(
        F.col(prediction).alias("cls"), F.lit(0).cast("long").alias("support"), F.lit(0).cast("long").alias("hits"), n.alias("predicted")
    )
    classes = (
        counts.select(F.explode(F.array(as_true, as_predicted)).alias("r"))
        .select("r.*")
        .groupBy("cls")
        .agg(F.sum("support").alias("support"), F.sum("hits").alias("hits"), F.sum("predicted").alias("predicted"))
        .withColumn("precision", ratio(F.col("hits"), F.col("predicted")))
        .withColumn("recall", ratio(F.col("hits"), F.col("support")))
        .withColumn(
            "f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
        )
    )
    support = F.col("support")
    return classes.agg(
        ratio(F.sum("hits"), F.sum(support)).alias("accuracy"),
        ratio(F.sum(F.col("precision") * support), F.sum(support)).alias("weighted_precision"),
        ratio(F.sum(F.col("recall") * support), F.sum(support)).alias("weighted_recall"),
        ratio(F.sum(F.col("f1") * support), F.sum(support)).alias("f1"),
    )


def _f_measure(beta: float):
    b = beta * beta
    return ratio((1 + b) * F.col("precision") * F.col("recall"), b * F.col("precision") + F.col("recall"))


def threshold_counts(
    df: DataFrame, score: str, label: str = "label", weight: str | None = None, ranges: int | None = None
) -> DataFrame:
    """Per distinct score: positives and negatives at it, and at or above it.

    Rows whose score is null or NaN have no place in an order of scores: they are left out of the
    counts and of the totals alike. With ``weight`` a row counts that often.

    A running total over one global order would put all scores in one task. Here scores are
    first reduced to one row each, cut into ranges at approximate quantiles, and summed within
    each range in parallel; the ranges above add one number per range. The cut points only
    decide who does the work: the totals are exact for any cut.
    """
    positive, n = F.col(label) > 0.5, _rows(weight)
    ranges = ranges or max(RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    threshold = F.col(score).cast("double")
    scores = staged(
        df.filter(threshold.isNotNull() & ~F.isnan(threshold)).groupBy(threshold.alias("threshold")).agg(
            F.sum(F.when(positive, n).otherwise(n * 0)).alias("pos"), F.sum(F.when(~positive, n).otherwise(n * 0)).alias("neg")
        ),
        "scores",
    )
    cuts = sorted(set(scores.approxQuantile("threshold", [i / ranges for i in range(1, ranges)], min(0.0005, 0.1 / ranges))))
    splits = [float("-inf"), *cuts, float("inf")]
    if len(splits) > 2:
        cutter = Bucketizer(splits=splits, inputCol="threshold", outputCol="range", handleInvalid="keep")
        ranged = cutter.transform(scores)
    else:
        ranged = scores.withColumn("range", F.lit(0.0))

    # At most ``ranges`` + 1 rows from here to the join: one task and a broadcast are enough.
    above = Window.orderBy(F.col("range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = (
        ranged.groupBy("range")
        .agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
        .select(
            "range",
            F.coalesce(F.sum("p").over(above), F.lit(0)).alias("pos_above"),
            F.coalesce(F.sum("n").over(above), F.lit(0)).alias("neg_above"),
            F.sum("p").over(everything).alias("all_pos"),
            F.sum("n").over(everything).alias("all_neg"),
        )
    )
    within = (
        Window.partitionBy("range").orderBy(F.col("threshold").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return ranged.join(F.broadcast(totals), "range").select(
        "threshold",
        "pos",
        "neg",
        (F.col("pos_above") + F.sum("pos").over(within)).alias("tp"),
        (F.col("neg_above") + F.sum("neg").over(within)).alias("fp"),
        "all_pos",
        "all_neg",
    )


def threshold_curve(df: DataFrame, score: str, label: str = "label", weight: str | None = None) -> DataFrame:
    """Precision, recall and F-measure (beta 1 and 0.5) at every distinct score."""
    tp, fp = F.col("tp"), F.col("fp")
    return (
        threshold_counts(df, score, label, weight)
        .select(
            "threshold",
            ratio(tp, tp + fp).alias("precision"),
            ratio(tp, F.col("all_pos")).alias("recall"),
        )
        .select("*", _f_measure(1.0).alias("f1"), _f_measure(0.5).alias("f05"))
    )


def curve_areas(df: DataFrame, score: str, label: str = "label", weight: str | None = None) -> DataFrame:
    """One row: areas under the ROC and the precision-recall curve, by trapezoids.

    Every point knows the point before it (its own counts taken off its running totals), so
    the areas are plain sums. The precision-recall curve starts at recall 0 with the
    precision of the highest score.
    """
    return threshold_counts(df, score, label, weight).agg(*_areas())


def _areas() -> list[Column]:
    """The two areas as sums over the points of a curve."""
    tp, fp, pos, neg = (F.col(x) for x in ("tp", "fp", "pos", "neg"))
    tp0, fp0 = tp - pos, fp - neg
    precision = ratio(tp, tp + fp)
    precision0 = F.when(tp0 + fp0 > 0, ratio(tp0, tp0 + fp0)).otherwise(precision)
    roc = ratio(neg, F.col("all_neg")) * (ratio(tp, F.col("all_pos")) + ratio(tp0, F.col("all_pos"))) / 2
    pr = ratio(pos, F.col("all_pos")) * (precision + precision0) / 2
    return [
        F.coalesce(F.sum(roc), F.lit(0.0)).alias("area_under_roc"),
        F.coalesce(F.sum(pr), F.lit(0.0)).alias("area_under_pr"),
    ]


def grouped_areas(df: DataFrame, by: Sequence[str], score: str, label: str = "label", weight: str | None = None) -> DataFrame:
    """Both areas for every group of the columns ``by``, all in one job.

    Scores are reduced to one row each per group and sorted in ranges of (group, score). A range is
    a task's share, whichever groups it holds, so a group may be as large as it likes; it is summed
    inside each range, and the ranges above add one number per range and group. Scores that are null
    or NaN are left out; a group in which only they occur has no row.
    """
    by, threshold = list(by), F.col(score).cast("double")
    positive, n = F.col(label) > 0.5, _rows(weight)
    counted = staged(
        df.filter(threshold.isNotNull() & ~F.isnan(threshold)).groupBy(*by, threshold.alias("threshold")).agg(
            F.sum(F.when(positive, n).otherwise(n * 0)).alias("pos"), F.sum(F.when(~positive, n).otherwise(n * 0)).alias("neg")
        ),
        "group_scores",
    )
    ranged = staged(counted.repartitionByRange(*by, F.desc("threshold")).withColumn("range", F.spark_partition_id()), "group_ranges")
    # A row per group and range: as many as there are tasks and groups.
    above = Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*by)
    totals = (
        ranged.groupBy(*by, "range")
        .agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"))
        .select(
            *by, "range",
            F.coalesce(F.sum("p").over(above), F.lit(0)).alias("pos_above"),
            F.coalesce(F.sum("n").over(above), F.lit(0)).alias("neg_above"),
            F.sum("p").over(everything).alias("all_pos"),
            F.sum("n").over(everything).alias("all_neg"),
        )
    )
    within = Window.partitionBy(*by, "range").orderBy(F.col("threshold").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = ranged.join(totals, [*by, "range"]).select(
        *by, "pos", "neg",
        (F.col("pos_above") + F.sum("pos").over(within)).alias("tp"),
        (F.col("neg_above") + F.sum("neg").over(within)).alias("fp"),
        "all_pos", "all_neg",
    )
    return running.groupBy(*by).agg(*_areas())


def hard_auc(
    df: DataFrame, label: str = "label", prediction: str = "prediction", weight: str | None = None
) -> DataFrame:
    """One row: the ROC area when the 0/1 prediction itself is the score."""
    return curve_areas(df, prediction, label, weight).select(F.col("area_under_roc").alias("auc"))


def score_counts(
    df: DataFrame, score: str = "score", label: str = "label", prediction: str = "prediction", weight: str | None = None
) -> DataFrame:
    """(score, label, prediction, rows), staged: all that metrics and curves need of predictions."""
    columns = list(dict.fromkeys([score, label, prediction]))
    return staged(df.groupBy(*columns).agg(F.sum(_rows(weight)).alias("rows")), "score_counts")


def report(
    df: DataFrame,
    model: str,
    split: str,
    score: str = "score",
    label: str = "label",
    prediction: str = "prediction",
    weight: str | None = None,
) -> DataFrame:
    """(model, split, metric, value): every single-number metric of one set of predictions.

    The predictions are read once, into a count per (score, prediction, label).
    """
    df, weight = score_counts(df, score, label, prediction, weight), "rows"

    def tall(wide: DataFrame) -> DataFrame:
        return wide.unpivot([], wide.columns, "metric", "value")

    metrics = (
        tall(class_metrics(df, label, prediction, weight))
        .unionByName(tall(hard_auc(df, label, prediction, weight)))
        .unionByName(tall(curve_areas(df, score, label, weight)))
    )
    return metrics.select(F.lit(model).alias("model"), F.lit(split).alias("split"), "metric", "value")
