import pytest
from conftest import SMALL
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from checks.queries import queries
from patronlens import FeatureConfig
from patronlens.operators.split import keyed_split, with_fold
from patronlens.plans import full_features, jobs, sizing, training
from patronlens.plans.tables import staged
from patronlens.sources.adapters import inputs

CORRECTED = FeatureConfig(semantics="corrected")
TINY = {
    "rf": {"numTrees": [3], "maxDepth": [2, 3]},
    "lr": {"threshold": [0.3, 0.7], "maxIter": [3]},
    "dt": {"maxDepth": [2, 3]},
    "gbt": {"maxDepth": [2], "maxIter": [2]},
}


@pytest.fixture(scope="module")
def rows(spark):
    return staged(keyed_split(full_features(*inputs(spark, SMALL), CORRECTED)), "test_rows")


@pytest.mark.parametrize(("name", "points", "fits"), [("rf", 9, 3), ("lr", 9, 3), ("dt", 9, 9), ("gbt", 6, 3)])
def test_full_grids_in_few_fits(name, points, fits):
    grid = training.grid_points(name)
    assert len(grid) == points and training.FOLDS == 5
    for param, values in training.GRIDS[name].items():
        assert {point[param] for point in grid} == set(values)
    shared = training.distinct_fits(name, grid)
    assert len(shared) == fits
    assert sorted(i for _, numbers in shared for i in numbers) == list(range(points))


def vectors_of(rows, weight=None, folds=2):
    kept = ["label", "features", "fold", *([weight] if weight else [])]
    return staged(training.prepare(with_fold(rows, folds), training.input_columns()).select(*kept), "test_vectors", by="fold")


@pytest.mark.parametrize(("name", "size", "model"), [("rf", "numTrees", RandomForestClassificationModel), ("gbt", "maxIter", GBTClassificationModel)])
def test_beginnings_score_as_models_of_their_trees(rows, name, size, model):
    vectors = vectors_of(rows)
    points = [{size: n, "maxDepth": 3} for n in (2, 3, 6)]
    whole = training.classifier(name, points[-1])._fit_java(vectors)
    got = training.point_scores(name, whole, points, [0, 1, 2], vectors.select("features")).toPandas()
    for i, point in enumerate(points):
        alone = model(training.segments(name, whole, [point[size]])[0]).setFeaturesCol("features")
        want = alone.transform(vectors).select(vector_to_array("rawPrediction")[1].alias("s")).toPandas()
        assert got[f"score_{i}"].to_numpy() == pytest.approx(want["s"].to_numpy(), abs=1e-9)
        assert alone.getNumTrees == point[size] or len(alone.trees) == point[size]


def test_short_boosting_is_the_beginning_of_a_long_one(rows):
    vectors = vectors_of(rows).coalesce(1)
    points = [{"maxIter": 2, "maxDepth": 3}, {"maxIter": 4, "maxDepth": 3}]
    shared = training.point_scores("gbt", training.classifier("gbt", points[1])._fit_java(vectors), points, [0], vectors.select("features")).toPandas()
    alone = training.classifier("gbt", points[0]).fit(vectors).transform(vectors).select(vector_to_array("rawPrediction")[1].alias("s")).toPandas()
    assert shared["score_0"].to_numpy() == pytest.approx(alone["s"].to_numpy(), abs=1e-9)


@pytest.mark.parametrize("name", ["lr", "dt", "gbt"])
def test_search_agrees_with_cross_validator(rows, name):
    """The same areas and choice as MLlib's own search, which fits every point anew."""
    vectors = vectors_of(rows).coalesce(1)
    classifier = training.classifier(name, {})
    builder = ParamGridBuilder()
    for param, values in TINY[name].items():
        builder = builder.addGrid(classifier.getParam(param), values)
    evaluator = BinaryClassificationEvaluator(numBins=0)
    theirs = CrossValidator(estimator=classifier, evaluator=evaluator, estimatorParamMaps=builder.build(), numFolds=2, foldCol="fold").fit(vectors)
    _, points = training.search(vectors, name, TINY[name], folds=2)
    got = {tuple(sorted((k, v) for k, v in p.items() if k in TINY[name])): p["area_under_roc"] for p in points}
    want = {tuple(sorted((k.name, v) for k, v in m.items())): a for m, a in zip(theirs.getEstimatorParamMaps(), theirs.avgMetrics, strict=True)}
    assert got == pytest.approx(want, abs=1e-9)


def test_fits_read_the_other_folds_files_only(rows):
    vectors = vectors_of(rows, folds=5)
    plan = vectors.where(F.col("fold") != 3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(fold" in plan and "NOT (fold" in plan
    assert not any("fold=3" in f for f in vectors.where(F.col("fold") != 3).select(F.input_file_name()).distinct().toPandas().iloc[:, 0])


def test_the_same_question_is_fitted_once(rows, monkeypatch):
    train = rows.filter("split = 'train'").repartition(3)
    first = training.train(train, "dt", {"maxDepth": [2, 3]}, folds=3)
    monkeypatch.setattr(training, "search", None)
    again = training.train(train.repartition(5), "dt", {"maxDepth": [2, 3]}, folds=3)
    assert again.points == first.points
    assert training.score(first, rows).exceptAll(training.score(again, rows)).count() == 0
    for other in ({"folds": 2}, {"seed": 3}, {"max_fit_pairs": 50}, {"keep": False}):
        with pytest.raises(TypeError):
            training.train(train, "dt", {"maxDepth": [2, 3]}, **{"folds": 3, **other})
    with pytest.raises(TypeError):
        training.train(train.union(train.limit(1)), "dt", {"maxDepth": [2, 3]}, folds=3)


def test_the_five_queries_end(monkeypatch, spark):
    """Run as registered, on short grids; the listed pairs are scored by what the others fitted."""
    monkeypatch.setattr(training, "GRIDS", TINY)
    monkeypatch.setattr(training, "FOLDS", 2)
    monkeypatch.setattr(training.train, "__defaults__", (None, 2, *training.train.__defaults__[2:]))
    for name in ("rf", "lr", "dt", "gbt"):
        report = queries()[f"cv_{name}"](spark, SMALL).collect()
        assert len(report) == 14 and {r.model for r in report} == {name}
    monkeypatch.setattr(training, "search", None)
    scored = queries()["score_pairs"](spark, SMALL)
    listed = inputs(spark, SMALL)[1].count()
    counts = {r.model: r["count"] for r in scored.groupBy("model").count().collect()}
    assert set(counts) == {"rf", "lr", "dt", "gbt"} and set(counts.values()) == {listed}


def test_queries_search_the_full_grids(monkeypatch, spark):
    """The registered queries pass no grid and no folds of their own, and ask for all models."""
    asked = []

    class Seen(Exception):
        pass

    def seen(features, name, *args, **options):
        asked.append((name, args, options))
        raise Seen

    monkeypatch.setattr(training, "train", seen)
    for query in ("cv_rf", "cv_lr", "cv_dt", "cv_gbt", "score_pairs"):
        with pytest.raises(Seen):
            queries()[query](spark, SMALL)
    assert [name for name, *_ in asked] == ["rf", "lr", "dt", "gbt", "rf"]
    assert all(args == () and set(options) == {"weight", "max_fit_pairs"} for _, args, options in asked)


@pytest.mark.parametrize("name", ["rf", "lr", "dt", "gbt"])
def test_search_and_score(rows, name):
    train = rows.filter("split = 'train'")
    trained = training.train(train, name, TINY[name], folds=2)
    points = training.search_points(trained)
    assert [p["area_under_roc"] for p in points if p["chosen"]] == [max(p["area_under_roc"] for p in points)]
    scored = training.score(trained, rows)
    assert scored.columns == ["user_id", "seller_id", "prediction", "probability"]
    out = scored.agg(F.count("*"), F.min("probability"), F.max("probability")).first()
    assert out[0] == rows.count() and 0 <= out[1] <= out[2] <= 1


def test_same_seed_same_model(rows):
    train = rows.filter("split = 'train'")
    first, second = (
        training.score(training.train(train.repartition(3), "dt", TINY["dt"], folds=2), rows) for _ in range(2)
    )
    assert first.exceptAll(second).count() == 0


def test_vector_inputs():
    assert len(training.input_columns(everything=True)) == 76
    assert len(training.input_columns()) == 73
    assert "label" not in training.input_columns()


def test_split_and_folds_go_by_pair(spark):
    features = full_features(*inputs(spark, SMALL))
    placed = with_fold(keyed_split(features), 5)
    per_pair = placed.groupBy("user_id", "seller_id").agg(
        F.count_distinct("split").alias("sides"), F.count_distinct("fold").alias("folds"), F.first("split").alias("split")
    )
    row = per_pair.agg(F.max("sides"), F.max("folds"), F.count_if(F.col("split") == "train"), F.count("*")).first()
    assert (row[0], row[1]) == (1, 1)
    assert 0.75 < row[2] / row[3] < 0.85
    again = keyed_split(features.repartition(7))
    assert keyed_split(features).exceptAll(again).count() == 0


def test_whole_job_from_files_to_reports(spark, tmp_path):
    log, labels, info = inputs(spark, SMALL, "events")
    paths = {name: str(tmp_path / name) for name in ("log", "info", "train", "test", "out")}
    asked = labels.withColumn("label", F.lit(None).cast("int"))
    for frame, name in ((log, "log"), (info, "info"), (labels, "train"), (asked.union(asked), "test")):
        frame.write.csv(paths[name], header=True)
    jobs.run_training_job(
        spark, paths["log"], paths["info"], paths["train"], paths["test"], paths["out"],
        models=["lr", "dt"], grids=TINY, folds=2, config=CORRECTED,
    )
    report = spark.read.json(f"{paths['out']}/report").collect()
    assert {(r.model, r.split) for r in report} == {(m, s) for m in ("lr", "dt") for s in ("train", "test")}
    predictions = spark.read.parquet(f"{paths['out']}/predictions")
    assert {r.model: r["count"] for r in predictions.groupBy("model").count().collect()} == {"lr": 2 * 99, "dt": 2 * 99}
    curves = spark.read.parquet(f"{paths['out']}/curves")
    assert set(curves.columns) >= {"model", "split", "threshold", "precision", "recall", "f1", "f05"}


def test_feature_job_writes_both_tables(spark, tmp_path):
    log, labels, info = inputs(spark, SMALL, "events")
    paths = {name: str(tmp_path / name) for name in ("log", "info", "labels")}
    for frame, name in ((log, "log"), (info, "info"), (labels, "labels")):
        frame.write.csv(paths[name], header=True)
    for table, columns, rows in (("full", 76, 498), ("basic", 64, 99)):
        out = str(tmp_path / table)
        jobs.run_feature_job(spark, paths["log"], paths["info"], paths["labels"], out, table=table)
        back = spark.read.csv(out)
        assert (len(back.columns), back.count()) == (columns, rows)


def test_row_split_does_not_follow_the_partitioning(rows):
    from patronlens.operators import random_split

    few = rows.select("user_id", "seller_id", "label")
    few = few.union(few.limit(1).crossJoin(rows.sparkSession.range(9000)).drop("id"))  # one row above two chunks
    train, test = random_split(few.repartition(2))
    assert train.columns == few.columns
    assert train.union(test).exceptAll(few).count() == few.exceptAll(train.union(test)).count() == 0
    assert 0.75 < train.count() / few.count() < 0.85
    again, _ = random_split(few.repartition(7))
    assert train.exceptAll(again).count() == again.exceptAll(train).count() == 0


def test_row_split_of_weights_is_that_of_rows(spark):
    from patronlens.operators import fan_out, row_split

    weighted = spark.createDataFrame([(i, i % 2, i % 5 * 1000) for i in range(12)] + [(None, 1, 3)], "a long, b int, weight long")
    by_weight = row_split(weighted, weight="weight").collect()
    assert {tuple(r) for r in by_weight} == {tuple(r) for r in row_split(fan_out(weighted, "weight")).collect()}
    assert sum(r.train_rows + r.test_rows for r in by_weight) == weighted.agg(F.sum("weight")).first()[0]


@pytest.mark.parametrize("split", ["pair", "row"])
def test_jobs_tell_of_days_that_cannot_be_read(spark, tmp_path, split):
    log, labels, info = inputs(spark, SMALL, "events")
    spoilt = log.withColumn("time_stamp", F.when(F.col("item_id") % 9 == 0, "1x").otherwise(F.col("time_stamp")))
    paths = {name: str(tmp_path / name) for name in ("log", "info", "labels", "out", "rejects")}
    for frame, name in ((spoilt, "log"), (info, "info"), (labels, "labels")):
        frame.write.csv(paths[name], header=True)
    want = {"rows": log.count(), "bad_days": log.filter("item_id % 9 = 0").count()}
    given = (spark, paths["log"], paths["info"], paths["labels"])
    if split == "pair":
        got = jobs.run_feature_job(*given, paths["out"], table="basic", rejects_path=paths["rejects"])
        with pytest.raises(Exception, match="not an MMdd day"):
            jobs.run_feature_job(*given, paths["out"], config=FeatureConfig(on_bad_day="fail"))
        nobody = str(tmp_path / "nobody")
        labels.limit(0).coalesce(1).write.csv(nobody, header=True)
        none = jobs.run_feature_job(spark, paths["log"], paths["info"], nobody, paths["out"], table="basic")
        assert none == want
    else:
        got = jobs.run_training_job(
            *given, paths["labels"], paths["out"], models=["dt"], grids=TINY, folds=2, config=CORRECTED, split=split, rejects_path=paths["rejects"]
        )
        assert PipelineModel.load(f"{paths['out']}/models/dt").stages[-1].depth > 0
    assert got == want
    assert spark.read.parquet(paths["rejects"]).count() == want["bad_days"] > 0


def test_jobs_size_their_shuffles_by_the_log(spark, tmp_path, monkeypatch):
    log, labels, info = inputs(spark, SMALL, "events")
    paths = {name: str(tmp_path / name) for name in ("log", "info", "labels", "out")}
    for frame, name in ((log, "log"), (info, "info"), (labels, "labels")):
        frame.write.csv(paths[name], header=True)
    key, seen = "spark.sql.shuffle.partitions", []
    before = spark.conf.get(key)
    assert sizing.path_bytes(spark, paths["log"]) > 10_000
    monkeypatch.setattr(jobs, "full_features", lambda *a: seen.append(spark.conf.get(key)) or spark.range(1))
    monkeypatch.setattr(jobs, "_rejects", lambda *a: {})
    for stated in (None, 10**15):
        jobs.run_feature_job(spark, paths["log"], paths["info"], paths["labels"], paths["out"], log_bytes=stated)
    assert seen[0] == before == spark.conf.get(key) and int(seen[1]) > 1_000_000


def test_shared_log_changes_no_features(spark):
    log, labels, info = inputs(spark, SMALL, "events")
    parts = [labels.filter("user_id % 2 = 0"), labels.filter("user_id % 2 = 1")]
    shared = jobs.log_of_pairs(log, parts)
    for part in parts:
        want, got = full_features(log, part, info), full_features(shared, part, info)
        assert want.exceptAll(got).count() == got.exceptAll(want).count() == 0


def test_a_weight_is_so_many_rows(spark):
    """Reports on weighted rows equal reports on the rows they stand for."""
    from patronlens.operators import fan_out
    from patronlens.plans import evaluation

    rows = spark.createDataFrame(
        [(i, i % 3, float(i % 2), float(i % 5 > 2), (i * 7 % 11) / 11, i % 4) for i in range(60)],
        "user_id long, seller_id long, label double, prediction double, score double, weight long",
    )
    weighted = evaluation.report(rows, "m", "s", weight="weight").collect()
    repeated = evaluation.report(fan_out(rows, "weight"), "m", "s").collect()
    assert {r.metric: r.value for r in weighted} == pytest.approx({r.metric: r.value for r in repeated}, abs=1e-12)


def test_fit_bound_is_off_by_default_and_bounds_pairs(rows, monkeypatch):
    seen = []

    def search(vectors, *args):
        seen.append(vectors.count())
        raise InterruptedError

    monkeypatch.setattr(training, "search", search)
    for bound in (None, 200):
        with pytest.raises(InterruptedError):
            training.train(rows, "lr", max_fit_pairs=bound, keep=False)
    assert seen[0] == rows.count() and seen[1] < seen[0] / 2
