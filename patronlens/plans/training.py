"""Cross-validated training of the four classifiers, and scoring.

A grid of points on some folds is searched with as few fits as give every point its scores:

* points that differ only in what does not change a fit (the decision threshold) share it;
* points that differ only in the size of an ensemble share the largest: a smaller forest or a shorter
  boosting run is its first trees. The ensemble is cut into segments at the sizes asked for, every
  row goes through each tree once, and a point's score is the sum of its segments;
* all points' scores on all folds are ranked in one job, a group per (point, fold).

The vectors are assembled once and staged by fold in the shared folder: a fit reads the other folds'
files only, and a lost executor costs a re-read. Fitted searches are kept there as well, under a key
of the data and the question, so the same question is not fitted twice.
"""

from __future__ import annotations

import hashlib
import json
import math
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from itertools import pairwise, product

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.config import PAIR_KEY, FeatureConfig
from patronlens.operators.split import SPLIT_SEED, pair_hash, with_fold
from patronlens.plans.evaluation import grouped_areas
from patronlens.plans.tables import checkpoint_folder, freed_shuffles, staged

CLASSIFIERS: dict[str, type[Estimator]] = {
    "rf": RandomForestClassifier,
    "lr": LogisticRegression,
    "dt": DecisionTreeClassifier,
    "gbt": GBTClassifier,
}

# --- Fixed values: search grids and fold count --------------------------------------------
GRIDS: dict[str, dict[str, list]] = {
    "rf": {"numTrees": [300, 400, 500], "maxDepth": [5, 7, 9]},
    "lr": {"threshold": [0.3, 0.5, 0.7], "maxIter": [7, 10, 13]},
    "dt": {"maxBins": [40, 50, 60], "maxDepth": [5, 7, 9]},
    "gbt": {"maxDepth": [5, 7, 9], "maxIter": [5, 10]},
}
FOLDS = 5
# ------------------------------------------------------------------------------------------

SIZE = {"rf": "numTrees", "gbt": "maxIter"}  # how many trees: smaller ensembles are beginnings
AFTERWARDS = {"lr": {"threshold"}}  # used after the fit, and not by its scores
PARALLELISM = 8  # fits at a time, if there are as many cores
ROWS_PER_TASK = 20_000  # a fit's task gathers sums for every tree node, however few rows it has
KEPT = 1  # counts up when models kept by an earlier form must not be read any more


def input_columns(config: FeatureConfig = FeatureConfig(), everything: bool = False) -> list[str]:
    """Columns of the feature vector: all of them, or all but the ids and the label."""
    columns = config.full_columns()
    return columns if everything else [c for c in columns if c not in (*PAIR_KEY, "label")]


def preparation(columns: Sequence[str]) -> list:
    """Assemble the columns and scale every row to length 1."""
    return [
        VectorAssembler(inputCols=list(columns), outputCol="features_temp"),
        Normalizer(inputCol="features_temp", outputCol="features"),
    ]


def prepare(features: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add the normalised vector column ``features``."""
    return PipelineModel(preparation(columns)).transform(features)


def normalized_columns(features: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The normalised vector, back as one column per feature, and the columns to keep."""
    values = prepare(features, columns).select(*keep, vector_to_array("features").alias("v"))
    return values.select(*keep, *[F.col("v")[i].alias(c) for i, c in enumerate(columns)])


@dataclass(frozen=True)
class Trained:
    """A classifier chosen by cross-validation together with its preparation stages, and every
    grid point with its average area under ROC."""

    name: str
    model: PipelineModel
    points: list[dict]


def grid_points(name: str, grid: Mapping[str, Sequence] | None = None) -> list[dict]:
    """Every combination of a grid's values."""
    grid = GRIDS[name] if grid is None else grid
    return [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]


def classifier(name: str, params: Mapping, weight: str | None = None, seed: int = SPLIT_SEED) -> Estimator:
    settings: dict = {"labelCol": "label", "featuresCol": "features", **params}
    if weight is not None:
        settings["weightCol"] = weight
    if name != "lr":
        settings["seed"] = seed
    return CLASSIFIERS[name](**settings)


def distinct_fits(name: str, points: Sequence[Mapping]) -> list[tuple[dict, list[int]]]:
    """(parameters to fit, numbers of the points it serves), the largest ensemble for all sizes."""
    fits: dict[tuple, tuple[dict, list[int]]] = {}
    size, later = SIZE.get(name), AFTERWARDS.get(name, set())
    for i, point in enumerate(points):
        params = {k: v for k, v in point.items() if k not in later}
        key = tuple(sorted((k, v) for k, v in params.items() if k != size))
        found, served = fits.setdefault(key, (params, []))
        if size in params:
            found[size] = max(found[size], params[size])
        served.append(i)
    return list(fits.values())


def segments(name: str, model, sizes: Sequence[int]) -> list:
    """An ensemble (MLlib's own object) cut at ``sizes`` (ascending): models of its trees up to the
    first size, from there to the second, and so on. Raw predictions of an ensemble are sums over
    its trees, so those of the first n trees are the sum over the segments up to n."""
    context = SparkSession.active().sparkContext
    ml, lang = context._jvm.org.apache.spark.ml, context._jvm.java.lang
    kind = ml.classification.DecisionTreeClassificationModel if name == "rf" else ml.regression.DecisionTreeRegressionModel

    def part(kind, values, first: int, last: int):
        copy = context._gateway.new_array(kind, last - first)
        lang.System.arraycopy(values, first, copy, 0, last - first)
        return copy

    out = []
    for first, last in pairwise([0, *sizes]):
        uid, trees = f"trees-{first}-{last}", part(kind, model.trees(), first, last)
        if name == "rf":
            out.append(ml.classification.RandomForestClassificationModel(uid, trees, model.numFeatures(), 2))
        else:
            out.append(ml.classification.GBTClassificationModel(uid, trees, part(context._jvm.double, model.treeWeights(), first, last)))
    return out


def without_summary(name: str, model):
    """MLlib's own object without the summary of its training, which would travel to the tasks with
    it and holds on to the session and the training rows."""
    if name in ("lr", "rf"):
        model.setSummary(SparkSession.active().sparkContext._jvm.scala.Option.empty())
    return model


def with_raw(model, rows: DataFrame, column: str) -> DataFrame:
    """Rows with the raw prediction of one of MLlib's own objects. Python's wrappers of models are
    left out here: building one takes seconds for a forest."""
    model.setFeaturesCol("features")
    model.setRawPredictionCol(column)
    model.setProbabilityCol("")
    model.setPredictionCol("")
    return DataFrame(model.transform(rows._jdf), rows.sparkSession)


def point_scores(name: str, model, points: Sequence[Mapping], numbers: Sequence[int], rows: DataFrame) -> DataFrame:
    """Rows with a column ``score_<number>`` for every point that a fit serves."""
    size, keep = SIZE.get(name), list(rows.columns)
    if size in points[numbers[0]]:
        sizes = sorted({points[i][size] for i in numbers})
        for n, part in zip(sizes, segments(name, model, sizes), strict=True):
            rows = with_raw(part, rows, f"_raw_{n}")
        raw = [vector_to_array(f"_raw_{n}")[1] for n in sizes]
        of = {n: reduce(lambda a, b: a + b, raw[: i + 1]) for i, n in enumerate(sizes)}
        return rows.select(*keep, *(of[points[i][size]].alias(f"score_{i}") for i in numbers))
    rows = with_raw(model, rows, "_raw")
    return rows.select(*keep, *(vector_to_array("_raw")[1].alias(f"score_{i}") for i in numbers))


def fit_tasks(vectors: DataFrame) -> int:
    """Tasks worth having for a fit of this many rows; more partitions than that are read together."""
    return max(1, math.ceil(vectors.count() / ROWS_PER_TASK))


def fold_scores(
    vectors: DataFrame, name: str, points: Sequence[Mapping], folds: int, parallelism: int, weight: str | None, seed: int
) -> DataFrame:
    """(point, fold, label, weight, score): every row of ``vectors`` scored for every point by the
    fit that did not see its fold."""
    fits = distinct_fits(name, points)
    tasks = fit_tasks(vectors)

    def one(fold: int, params: dict, numbers: list[int]) -> DataFrame:
        model = without_summary(name, classifier(name, params, weight, seed)._fit_java(vectors.where(F.col("fold") != fold).coalesce(tasks)))
        held = vectors.where(F.col("fold") == fold)
        wide = point_scores(name, model, points, numbers, held.select("label", (F.col(weight) if weight else F.lit(1)).alias("_rows"), "features"))
        tall = F.explode(F.array(*(F.struct(F.lit(i).alias("point"), F.col(f"score_{i}").alias("score")) for i in numbers)))
        return wide.select("label", "_rows", tall.alias("s")).select(F.lit(fold).alias("fold"), "s.point", "label", "_rows", "s.score")

    asked = [(fold, dict(params), numbers) for fold in range(folds) for params, numbers in fits]
    run = inheritable_thread_target(SparkSession.active())(lambda job: one(*job))
    threads = min(parallelism, len(asked), SparkSession.active().sparkContext.defaultParallelism)
    with ThreadPoolExecutor(max(1, threads)) as pool:
        return reduce(DataFrame.unionByName, pool.map(run, asked))


def search(
    vectors: DataFrame,
    name: str,
    grid: Mapping[str, Sequence] | None = None,
    folds: int = FOLDS,
    parallelism: int = PARALLELISM,
    weight: str | None = None,
    seed: int = SPLIT_SEED,
) -> tuple[Transformer, list[dict]]:
    """The classifier fitted on all of ``vectors`` (label, features, fold, weight) at the grid point
    with the highest average area under ROC over the folds, and all points. Points that tie: the
    first of the grid. A fold without rows counts with area 0."""
    points = grid_points(name, grid)
    scores = fold_scores(vectors, name, points, folds, parallelism, weight, seed)
    areas = grouped_areas(scores, ["point", "fold"], "score", weight="_rows")
    found = {r["point"]: r["total"] for r in areas.groupBy("point").agg(F.sum("area_under_roc").alias("total")).collect()}
    means = [float(found.get(i) or 0.0) / folds for i in range(len(points))]
    # Sums of floats come in any order: what differs by less than their error is a tie.
    best = next(i for i, m in enumerate(means) if m >= max(means) - 1e-12)
    told = [{**p, "area_under_roc": m, "chosen": i == best} for i, (p, m) in enumerate(zip(points, means, strict=True))]
    chosen = classifier(name, points[best], weight, seed).fit(vectors.coalesce(fit_tasks(vectors)))
    without_summary(name, chosen._java_obj)
    return chosen, told


def data_key(df: DataFrame) -> str:
    """A digest of a table's rows, whatever their order and partitioning: one pass, three numbers."""
    one = F.xxhash64(*df.columns).cast("decimal(20,0)")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(one).alias("a"), F.sum(F.xxhash64(F.lit(1), *df.columns).cast("decimal(20,0)")).alias("b")).first()
    return f"{row.n}:{row.a}:{row.b}"


def _kept(spark: SparkSession, folder: str) -> str | None:
    """A finished search below a key's folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/*/points/_SUCCESS")
    done = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return None if done is None or len(done) == 0 else done[0].getPath().getParent().getParent().toString()


def bounded(features: DataFrame, max_fit_pairs: int, seed: int = SPLIT_SEED) -> DataFrame:
    """The rows of about ``max_fit_pairs`` pairs, chosen by a hash of the pair; staged, since every
    fit, and every model, asks for the same."""
    with freed_shuffles(features.sparkSession):
        pairs = features.select(*PAIR_KEY).distinct().count()
    share = max_fit_pairs / max(pairs, 1)
    return staged(features.filter(pair_hash(seed + 2) % 1_000_000 < share * 1_000_000), "fit_rows")


def train(
    features: DataFrame,
    name: str,
    grid: Mapping[str, Sequence] | None = None,
    folds: int = FOLDS,
    columns: Sequence[str] | None = None,
    parallelism: int = PARALLELISM,
    weight: str | None = None,
    seed: int = SPLIT_SEED,
    max_fit_pairs: int | None = None,
    keep: bool = True,
) -> Trained:
    """Fit one classifier, by default over its whole grid. All rows of a pair share a fold.

    ``max_fit_pairs`` bounds the labelled pairs a fit reads, chosen by a hash of the pair (about
    that many; default: all pairs). It bounds nothing else.

    With ``keep`` the result is saved in the shared folder under a digest of the rows, columns,
    grid, folds, weight, seed and bound, and read back when the same is asked for again. The points
    are written last, so an unfinished search is never read.
    """
    columns = list(columns) if columns is not None else input_columns()
    spark = features.sparkSession
    if max_fit_pairs is not None:
        features = bounded(features, max_fit_pairs, seed)
    used = [*dict.fromkeys([*PAIR_KEY, "label", *columns, *([weight] if weight else [])])]
    rows = features.select(*used)
    folder, path = checkpoint_folder(spark), None
    if keep and folder is not None:
        question = [KEPT, name, grid_points(name, grid), folds, columns, weight, seed, data_key(rows)]
        key = hashlib.sha256(json.dumps(question, default=str).encode()).hexdigest()
        path = f"{folder.rstrip('/')}/patronlens/models/{key}"
        found = _kept(spark, path)
        if found is not None:
            told = spark.read.schema("point string").json(f"{found}/points").collect()
            return Trained(name, PipelineModel.load(f"{found}/model"), [json.loads(r.point) for r in sorted(told, key=lambda r: json.loads(r.point)["number"])])

    stages = preparation(columns)
    kept = ["label", "features", *([weight] if weight else []), "fold"]
    vectors = staged(PipelineModel(stages).transform(with_fold(rows, folds, seed)).select(*kept), "vectors", by="fold")
    chosen, points = search(vectors, name, grid, folds, parallelism, weight, seed)
    points = [{**p, "number": i} for i, p in enumerate(points)]
    trained = Trained(name, PipelineModel([*stages, chosen]), points)
    if path is not None:
        path = f"{path}/{uuid.uuid4().hex}"
        trained.model.save(f"{path}/model")
        spark.createDataFrame([(json.dumps(p),) for p in points], "point string").coalesce(1).write.json(f"{path}/points")
    return trained


def search_points(trained: Trained) -> list[dict]:
    """The grid points with their average area under ROC; the chosen one is marked."""
    return [{k: v for k, v in p.items() if k != "number"} for p in trained.points]


def score(trained: Trained, features: DataFrame, keep: Sequence[str] = PAIR_KEY) -> DataFrame:
    """Predictions: the kept columns, ``prediction`` and ``probability`` of class 1."""
    return trained.model.transform(features).select(
        *keep, "prediction", vector_to_array("probability")[1].alias("probability")
    )


def score_each(models: Mapping[str, Trained], features: DataFrame, keep: Sequence[str] = PAIR_KEY) -> DataFrame:
    """``score`` of several models on the same columns, a row per model with its name as ``model``:
    the rows are read, assembled and normalised once, not once per model."""
    assemblers = [trained.model.stages[0] for trained in models.values()]
    if len({tuple(a.getInputCols()) for a in assemblers}) != 1:
        raise ValueError("the models must have been trained on the same columns")
    *stages, _ = next(iter(models.values())).model.stages
    rows = PipelineModel(stages).transform(features.select(*dict.fromkeys([*keep, *assemblers[0].getInputCols()])))
    rows = rows.select(*keep, "features")
    for i, trained in enumerate(models.values()):
        model = trained.model.stages[-1]
        names = {model.rawPredictionCol: f"_raw_{i}", model.probabilityCol: f"_probability_{i}", model.predictionCol: f"_prediction_{i}"}
        rows = model.copy(names).transform(rows)
    each = [
        F.struct(F.lit(name).alias("model"), F.col(f"_prediction_{i}").alias("prediction"), vector_to_array(f"_probability_{i}")[1].alias("probability"))
        for i, name in enumerate(models)
    ]
    return rows.select(*keep, F.explode(F.array(*each)).alias("_scored")).select("_scored.model", *keep, "_scored.prediction", "_scored.probability")
