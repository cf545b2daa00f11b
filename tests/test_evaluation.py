import random

import pytest
from conftest import MEDIUM
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.mllib.evaluation import BinaryClassificationMetrics

from checks.queries import _scored_documents
from patronlens.plans import evaluation
from patronlens.sources import write_report


@pytest.fixture(scope="module")
def scored(spark):
    return _scored_documents(spark, MEDIUM).cache()


def brute_curve(rows):
    """{threshold: (tp, fp)} by looking at every row for every threshold."""
    return {
        t: (sum(1 for s, y in rows if s >= t and y > 0.5), sum(1 for s, y in rows if s >= t and y <= 0.5))
        for t in {s for s, _ in rows}
    }


def test_class_metrics_match_the_evaluator(scored):
    got = evaluation.class_metrics(scored).first().asDict()
    names = {"accuracy": "accuracy", "weighted_precision": "weightedPrecision", "weighted_recall": "weightedRecall", "f1": "f1"}
    for ours, theirs in names.items():
        want = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=theirs).evaluate(scored)
        assert got[ours] == pytest.approx(want, abs=1e-12)
    assert got["accuracy"] == pytest.approx(0.228070175, abs=1e-9)
    assert got["f1"] == pytest.approx(0.218224132, abs=1e-9)


def test_hard_auc_matches_the_evaluator(scored):
    want = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="prediction").evaluate(scored)
    assert evaluation.hard_auc(scored).first().auc == pytest.approx(want, abs=1e-12)
    assert want == pytest.approx(0.483997371, abs=1e-9)


@pytest.mark.parametrize(
    ("score", "label", "roc", "pr"),
    [("score", "label", 0.546819699, 0.874097547), ("label", "prediction", 0.482167005, 0.123577661)],
)
def test_areas_match_the_metrics_class(scored, score, label, roc, pr):
    got = evaluation.curve_areas(scored, score, label).first()
    pairs = scored.select(score, label).rdd.map(lambda r: (float(r[0]), float(r[1])))
    jvm = BinaryClassificationMetrics(pairs)
    assert got.area_under_roc == pytest.approx(jvm.areaUnderROC, abs=1e-12)
    assert got.area_under_pr == pytest.approx(jvm.areaUnderPR, abs=1e-12)
    assert (got.area_under_roc, got.area_under_pr) == (pytest.approx(roc, abs=1e-9), pytest.approx(pr, abs=1e-9))


@pytest.mark.parametrize("ranges", [2, 7, 256])
def test_running_totals_are_exact_for_any_cut(spark, monkeypatch, ranges):
    monkeypatch.setattr(evaluation, "RANGES", ranges)
    rng = random.Random(ranges)
    rows = [(rng.choice([0.25, rng.random(), round(rng.random(), 1)]), float(rng.random() < 0.3)) for _ in range(400)]
    df = spark.createDataFrame(rows, "score double, label double").repartition(5)
    got = {r.threshold: (r.tp, r.fp) for r in evaluation.threshold_counts(df, "score").collect()}
    assert got == brute_curve(rows)


def test_curve_formulas(spark):
    rows = [(0.9, 1.0), (0.8, 0.0), (0.7, 1.0), (0.1, 0.0)]
    df = spark.createDataFrame(rows, "score double, label double")
    curve = {r.threshold: r for r in evaluation.threshold_curve(df, "score").collect()}
    assert (curve[0.9].precision, curve[0.9].recall) == (1.0, 0.5)
    assert curve[0.9].f1 == pytest.approx(2 / 3)
    assert curve[0.9].f05 == pytest.approx(1.25 * 0.5 / (0.25 + 0.5))
    assert (curve[0.1].precision, curve[0.1].recall) == (0.5, 1.0)


@pytest.mark.parametrize("label", [0.0, 1.0])
def test_one_class_only(spark, label):
    df = spark.createDataFrame([(0.2, label), (0.4, label)], "score double, label double")
    curve = evaluation.threshold_curve(df, "score").collect()
    assert {r.recall for r in curve} == ({0.0} if label == 0 else {0.5, 1.0})
    areas = evaluation.curve_areas(df, "score").first()
    assert areas.area_under_roc == 0.0
    assert areas.area_under_pr == (0.0 if label == 0 else 1.0)


def test_empty_predictions(spark):
    df = spark.createDataFrame([], "score double, label double, prediction double")
    assert evaluation.threshold_curve(df, "score").count() == 0
    assert evaluation.report(df, "none", "all").count() == 7


def test_report_is_written_and_read_back(spark, scored, tmp_path):
    report = evaluation.report(scored, "documents", "all")
    write_report(report, str(tmp_path / "report"))
    back = spark.read.json(str(tmp_path / "report"))
    assert {r.metric for r in back.collect()} == {
        "accuracy", "weighted_precision", "weighted_recall", "f1", "auc", "area_under_roc", "area_under_pr",
    }


def test_null_and_nan_scores_have_no_place(spark):
    rows = [(0.9, 1.0), (None, 0.0), (0.2, 0.0), (float("nan"), 1.0), (0.5, 1.0)]
    df = spark.createDataFrame(rows, "score double, label double")
    got = {r.threshold: (r.tp, r.fp, r.all_pos, r.all_neg) for r in evaluation.threshold_counts(df, "score").collect()}
    assert got == {0.9: (1, 0, 2, 1), 0.5: (2, 0, 2, 1), 0.2: (2, 1, 2, 1)}
    assert evaluation.curve_areas(df, "score").first().area_under_roc == 1.0
