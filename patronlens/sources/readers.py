"""Typed readers for the three inputs and for saved feature tables.

Every reader states its schema: no inference pass over the data, and ``time_stamp`` keeps
its leading zero.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronlens.config import FeatureConfig
from patronlens.functions.dates import is_month_day

USER_LOG_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("cat_id", T.LongType()),
    T.StructField("seller_id", T.LongType()),
    T.StructField("brand_id", T.LongType()),
    T.StructField("time_stamp", T.StringType()),
    T.StructField("action_type", T.IntegerType()),
])

LABEL_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("seller_id", T.LongType()),
    T.StructField("label", T.IntegerType()),
])

USER_INFO_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("age_range", T.StringType()),
    T.StructField("gender", T.StringType()),
])


def _cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    if fmt == "csv":
        # A header CSV may hold its columns in any order, so names come from the header and
        # types from the schema: read as text (no inference), then cast by name.
        return _cast_to(spark.read.csv(path, header=True, inferSchema=False), schema)
    return _cast_to(spark.read.format(fmt).load(path), schema)


def read_user_log(
    spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType = USER_LOG_SCHEMA
) -> DataFrame:
    """The action log. Pass another ``schema`` when categories or brands are text."""
    return _read(spark, path, schema, fmt)


def read_labels(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The labelled (or to-be-scored) pairs; columns are taken by position, not by name."""
    raw = (
        spark.read.csv(path, header=True, inferSchema=False) if fmt == "csv"
        else spark.read.format(fmt).load(path)
    )
    return _cast_to(raw.toDF(*LABEL_SCHEMA.names), LABEL_SCHEMA)


def read_user_info(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The user profile."""
    return _read(spark, path, USER_INFO_SCHEMA, fmt)


def rejected_days(log: DataFrame) -> DataFrame:
    """The log rows whose day cannot be read, whole."""
    return log.where(~is_month_day(F.col("time_stamp")))


def observed_days(log: DataFrame, observation: Observation) -> DataFrame:
    """The log, counting its rows and those whose day cannot be read while it is read for
    something else (``rows`` and ``bad_days`` of the observation)."""
    return log.observe(
        observation, F.count(F.lit(1)).alias("rows"), F.count_if(~is_month_day(F.col("time_stamp"))).alias("bad_days")
    )


def count_bad_days(log: DataFrame) -> DataFrame:
    """How many log rows carry a day that cannot be read: one row, two counts."""
    return log.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~is_month_day(F.col("time_stamp"))).alias("bad_days"),
    )


def features_schema(config: FeatureConfig = FeatureConfig()) -> T.StructType:
    """The saved wide table: every column a double, in order."""
    return T.StructType([T.StructField(c, T.DoubleType()) for c in config.full_columns()])


def read_features(
    spark: SparkSession, path: str, fmt: str = "csv", config: FeatureConfig = FeatureConfig()
) -> DataFrame:
    """Reload a saved wide table; CSV has no header, so columns come by position."""
    return spark.read.schema(features_schema(config)).format(fmt).load(path)
