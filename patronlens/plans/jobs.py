"""The two end-to-end jobs: build a feature table; train, evaluate and score."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from patronlens.config import PAIR_KEY, FeatureConfig
from patronlens.operators.fanout import fan_out
from patronlens.operators.split import keyed_split, row_split
from patronlens.plans import evaluation, training
from patronlens.plans.features import basic_features, full_features
from patronlens.plans.sizing import path_bytes, sized_for
from patronlens.plans.tables import staged, temporary_tables
from patronlens.sources import (
    count_bad_days,
    observed_days,
    read_labels,
    read_user_info,
    read_user_log,
    rejected_days,
    write_features,
    write_predictions,
    write_report,
)


def run_feature_job(
    spark: SparkSession,
    log_path: str,
    info_path: str,
    label_path: str,
    out_path: str,
    table: str = "full",
    in_format: str = "csv",
    out_format: str = "csv",
    config: FeatureConfig = FeatureConfig(),
    rejects_path: str | None = None,
    log_bytes: int | None = None,
) -> dict[str, int]:
    """Read the three inputs, build the 'full' or the 'basic' table and write it.

    Returns how many log rows were read and how many had a day that cannot be read. With
    ``rejects_path`` these are saved there, whole; ``config.on_bad_day="fail"`` stops at one that
    belongs to a labelled pair. Shuffles are sized for ``log_bytes``, by default the log's files.
    """
    build = {"full": full_features, "basic": basic_features}[table]
    raw, seen = read_user_log(spark, log_path, in_format), Observation("log")
    with sized_for(spark, log_bytes if log_bytes is not None else path_bytes(spark, log_path)), temporary_tables(spark):
        features = build(
            observed_days(raw, seen),
            read_labels(spark, label_path, in_format),
            read_user_info(spark, info_path, in_format),
            config,
        )
        write_features(features, out_path, out_format)
    return _rejects(raw, seen, rejects_path)


def _rejects(raw: DataFrame, seen: Observation, path: str | None) -> dict[str, int]:
    """The counts taken while the log was read; the rejected rows to ``path``, if there are any."""
    try:
        found = seen.get
    except Py4JJavaError:  # nothing asked for the log, as with an empty list of pairs
        found = count_bad_days(raw).first().asDict()
    counts = {name: int(n) for name, n in found.items()}
    if path is not None:
        rejected_days(raw).write.mode("overwrite").parquet(path)
    return counts


def log_of_pairs(log: DataFrame, lists: Sequence[DataFrame]) -> DataFrame:
    """The part of the log that any of the pair lists asks for, staged.

    Building features for several lists then shuffles the whole log once, not once per list.
    """
    asked = _union([pairs.select(*PAIR_KEY) for pairs in lists]).distinct()
    return staged(log.join(staged(asked, "asked_pairs"), PAIR_KEY, "left_semi"), "asked_log")


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def run_training_job(
    spark: SparkSession,
    log_path: str,
    info_path: str,
    train_path: str,
    test_path: str,
    out_path: str,
    models: Sequence[str] = ("rf", "lr", "dt", "gbt"),
    grids: Mapping[str, Mapping[str, Sequence]] = training.GRIDS,
    folds: int = training.FOLDS,
    in_format: str = "csv",
    config: FeatureConfig = FeatureConfig(semantics="corrected"),
    columns: Sequence[str] | None = None,
    parallelism: int = training.PARALLELISM,
    split: str = "pair",
    rejects_path: str | None = None,
    log_bytes: int | None = None,
) -> dict[str, int]:
    """Train each model on the labelled pairs, report on both sides of the split, score the rest.

    Writes ``report`` and ``search`` (JSON), ``curves`` and, per model, ``predictions``
    (Parquet) and ``models`` under ``out_path``. Feature rows are kept once with their weight and staged,
    because every fit and every report reads them again; the weight counts in fits, in the choice
    of the grid point, in every report and in the predictions, which are repeated by it.
    ``split="row"`` splits row by row instead of by pair. Counts of the log, ``rejects_path`` and
    ``log_bytes``: as in ``run_feature_job``.
    """
    if split not in ("pair", "row"):
        raise ValueError("split must be 'pair' or 'row'")
    raw, seen = read_user_log(spark, log_path, in_format), Observation("log")
    log = observed_days(raw, seen)
    info = read_user_info(spark, info_path, in_format)
    lists = {"train": read_labels(spark, train_path, in_format), "test": read_labels(spark, test_path, in_format)}
    columns = columns if columns is not None else training.input_columns(config)

    with sized_for(spark, log_bytes if log_bytes is not None else path_bytes(spark, log_path)), temporary_tables(spark):
        if config.restrict_to_labels:
            log = log_of_pairs(log, list(lists.values()))
        known, asked = (
            staged(keyed_split(full_features(log, labels, info, config, repeats="weight")), f"{name}_rows")
            for name, labels in lists.items()
        )
        if split == "row":
            split_rows = staged(row_split(known.drop("split"), weight="weight"), "row_sides")
            copies = {side: F.col(f"{side}_rows") for side in ("train", "test")}
            sides = {
                side: split_rows.where(n > 0).withColumn("weight", n).drop("train_rows", "test_rows") for side, n in copies.items()
            }
        else:
            sides = {side: known.filter(F.col("split") == side) for side in ("train", "test")}

        reports, curves, predictions, searches = [], [], [], []
        for name in models:
            model = training.train(
                sides["train"], name, grids[name], folds, columns, parallelism, weight="weight"
            )
            model.model.write().overwrite().save(f"{out_path}/models/{name}")
            searches += [(name, json.dumps(point), point["area_under_roc"], point["chosen"]) for point in training.search_points(model)]
            for side, rows in sides.items():
                scored = training.score(model, rows, [*PAIR_KEY, "label", "weight"])
                counts = evaluation.score_counts(scored, "probability", weight="weight")
                reports.append(evaluation.report(counts, name, side, score="probability", weight="rows"))
                curve = evaluation.threshold_curve(counts, "probability", weight="rows")
                curves.append(curve.select(F.lit(name).alias("model"), F.lit(side).alias("split"), "*"))
            scored = fan_out(training.score(model, asked, [*PAIR_KEY, "weight"]), "weight", by=PAIR_KEY)
            predictions.append(scored.select(F.lit(name).alias("model"), "*"))

        write_report(_union(reports), f"{out_path}/report")
        write_report(
            spark.createDataFrame(searches, "model string, point string, area_under_roc double, chosen boolean"),
            f"{out_path}/search",
        )
        _union(curves).write.mode("overwrite").parquet(f"{out_path}/curves")
        write_predictions(_union(predictions), f"{out_path}/predictions")
    return _rejects(raw, seen, rejects_path)
