"""Writers. Each writes a directory of part files, one per task; nothing is merged."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_features(features: DataFrame, path: str, fmt: str = "csv") -> None:
    """Save a feature table, replacing what is there. CSV is written without a header."""
    features.write.mode("overwrite").format(fmt).save(path)


def write_predictions(predictions: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Save scored pairs, partitioned by model when they carry a ``model`` column."""
    writer = predictions.write.mode("overwrite").format(fmt)
    if "model" in predictions.columns:
        writer = writer.partitionBy("model")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def write_report(report: DataFrame, path: str) -> None:
    """Save an evaluation report as JSON lines."""
    report.write.mode("overwrite").json(path)
