"""The three inputs derived from the driver's tables, in two shapes.

``star`` reads line items as actions of a customer on a supplier's part; ``events`` reads the
event stream, which gives fewer and denser pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Stated, so that loading a table starts no job to read its footer.
SCHEMAS = {
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "labels": "doc_id long, quality int, toxic int",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _month_day(day: F.Column) -> F.Column:
    """``MMdd`` text, by arithmetic: a pattern formatter costs more than the rest of the scan."""
    digits = (F.month(day) * 100 + F.dayofmonth(day) + 10000).cast("string")
    return F.substring(digits, 2, 4)


def _mod_label(user: str, seller: str) -> F.Column:
    return F.when((F.col(user) * 7 + F.col(seller) * 13) % 10 < 3, 1).otherwise(0)


def star_user_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem")
    orders = load(spark, sf_dir, "orders")
    parts = load(spark, sf_dir, "part")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("item_id"),
            F.col("p_type").alias("cat_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.when(F.col("l_partkey") % 17 != 0, F.col("p_brand")).alias("brand_id"),
            _month_day(F.col("l_shipdate")).alias("time_stamp"),
            ((F.col("l_linenumber") - 1) % 4).alias("action_type"),
        )
    )


def star_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        load(spark, sf_dir, "lineitem")
        .join(load(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .filter((F.col("o_custkey") + F.col("l_suppkey")) % 3 != 0)
        .select(
            F.col("o_custkey").alias("user_id"),
            F.col("l_suppkey").alias("seller_id"),
            _mod_label("o_custkey", "l_suppkey").alias("label"),
        )
        .distinct()
    )


def star_user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    return (
        load(spark, sf_dir, "customer")
        .filter(F.col("c_custkey") % 10 != 0)
        .select(
            F.col("c_custkey").alias("user_id"),
            F.when(F.col("c_nationkey") % 9 != 0, (F.col("c_nationkey") % 9).cast("string"))
            .alias("age_range"),
            F.when(segment == "BUILDING", "0").when(segment == "MACHINERY", "1")
            .when(segment == "HOUSEHOLD", "2").alias("gender"),
        )
    )


def _event_number() -> F.Column:
    return F.regexp_extract("props", "([0-9]+)", 1).cast("int")


def events_user_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    kind = F.col("event_type")
    day = F.date_add(F.lit("2014-01-01").cast("date"), (F.col("event_id") % 365).cast("int"))
    return (
        load(spark, sf_dir, "events")
        .filter(kind != "error")
        .withColumn("k", _event_number())
        .select(
            "user_id",
            k.alias("item_id"),
            (k % 7).alias("cat_id"),
            (k % 10).alias("seller_id"),
            F.when(k % 17 != 0, k % 13).alias("brand_id"),
            _month_day(day).alias("time_stamp"),
            F.when(kind == "click", 0).when(kind == "view", 1)
            .when(kind == "purchase", 2).when(kind == "signup", 3).alias("action_type"),
        )
    )


def events_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        load(spark, sf_dir, "events")
        .select("user_id", (_event_number() % 10).alias("seller_id"))
        .filter((F.col("user_id") + F.col("seller_id")) % 3 != 0)
        .select("user_id", "seller_id", _mod_label("user_id", "seller_id").alias("label"))
        .distinct()
    )


def events_user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id")
    return (
        load(spark, sf_dir, "events")
        .filter(user % 10 != 0)
        .select("user_id")
        .distinct()
        .select(
            "user_id",
            F.when(user % 9 != 0, (user % 9).cast("string")).alias("age_range"),
            F.when(user % 4 != 3, (user % 4).cast("string")).alias("gender"),
        )
    )


def inputs(spark: SparkSession, sf_dir: str, shape: str = "star") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(action log, labelled pairs, user profile) of one shape."""
    if shape == "star":
        return star_user_log(spark, sf_dir), star_labels(spark, sf_dir), star_user_info(spark, sf_dir)
    if shape == "events":
        return events_user_log(spark, sf_dir), events_labels(spark, sf_dir), events_user_info(spark, sf_dir)
    raise ValueError(f"unknown shape {shape!r}")
