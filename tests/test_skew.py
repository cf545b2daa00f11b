"""One pair, user or seller may own a third of the rows: plans split it, results stay whole."""

import pytest
from pyspark.sql import functions as F

from patronlens import FeatureConfig
from patronlens.operators import blocks, fan_out
from patronlens.operators.labelled import join_log_labels, label_pairs, with_day
from patronlens.operators.relational import attach_left
from patronlens.plans import full_features
from patronlens.plans.features import by_user
from patronlens.plans.tables import staged

# Thresholds scaled down to the size of the test data; the join strategy is the large-scale one.
SHRUNK = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def skewed_log(spark, rows=60_000):
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(rows).repartition(8).select(
        F.when(hot, 1).otherwise(i % 997).cast("long").alias("user_id"),
        F.when(hot, 1).otherwise(i % 53).cast("long").alias("seller_id"),
        (i % 7919).alias("item_id"),
        (i % 31).alias("cat_id"),
        F.when(i % 5 != 0, i % 17).alias("brand_id"),
        F.format_string("%02d%02d", (i % 12 + 1).cast("int"), (i % 28 + 1).cast("int")).alias("time_stamp"),
        (i % 4).cast("int").alias("action_type"),
    )


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def log(spark):
    return staged(skewed_log(spark), "skewed_log")


@pytest.fixture
def labels(log):
    pair = log.select("user_id", "seller_id").distinct()
    return pair.withColumn("label", (F.col("user_id") % 2).cast("int"))


def test_hot_pair_is_split_in_the_label_join(log, labels, conf):
    conf(SHRUNK)
    pairs = staged(label_pairs(labels), "pairs")
    joined = by_user(join_log_labels(with_day(log), pairs))
    plan = final_plan(joined).split("Initial Plan")[0]
    assert "SortMergeJoin" in plan and "skew=true" in plan
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "AQEShuffleRead skewed" in plan.split("SortMergeJoin")[0]
    assert joined.count() == log.count()


def test_hot_seller_and_user_are_split_when_attached(spark, conf):
    conf(SHRUNK)
    i = F.col("id")
    pairs = staged(
        spark.range(60_000).repartition(8).select(
            F.when(i % 3 == 0, 0).otherwise(i % 5003).cast("long").alias("user_id"),
            F.when(i % 3 == 1, 0).otherwise(i % 499).cast("long").alias("seller_id"),
            F.rand(1).alias("x"),
        ), "pairs",
    )
    users = staged(spark.range(5003).select(i.alias("user_id"), (i * 2).alias("u")), "users")
    sellers = staged(spark.range(499).select(i.alias("seller_id"), (i * 3).alias("s")), "sellers")
    wide = attach_left(pairs, users, sellers)
    plan = final_plan(wide)
    assert plan.split("Initial Plan")[0].count("skew=true") == 2
    assert wide.filter((F.col("u") != 2 * F.col("user_id")) | (F.col("s") != 3 * F.col("seller_id"))).count() == 0
    assert wide.count() == 60_000


def test_blocks_spread_hot_keys_before_they_count(log):
    """Facts are shuffled on key *and* value; only partial sums travel by key alone."""
    dated = with_day(log)
    for block, key in ((blocks.user_block, "user_id"), (blocks.seller_block, "seller_id"), (blocks.pair_block, "seller_id")):
        plan = block(dated)._jdf.queryExecution().executedPlan().toString()
        exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert len(exchanges) == 2
        assert "item_id" in exchanges[1] and "spark_grouping_id" in exchanges[1]
        assert plan.count("HashAggregate") == 4 and "SortAggregate" not in plan


def test_hot_rows_change_no_result(spark, log, labels, conf):
    config = FeatureConfig(semantics="corrected")
    info = log.select("user_id").distinct().select("user_id", F.lit("1").alias("age_range"), F.lit("0").alias("gender"))
    plain = staged(full_features(log, labels, info, config), "plain")
    conf(SHRUNK)
    split = full_features(log, labels, info, config)
    assert plain.exceptAll(split).count() == split.exceptAll(plain).count() == 0
    hot = plain.filter("user_id = 1 and seller_id = 1").first()
    rows = log.filter("user_id = 1 and seller_id = 1")
    assert hot.u_m_c_cnt == rows.filter("action_type = 0").count()
    assert hot.u_m_p_i_cnt == rows.filter("action_type = 2").select("item_id").distinct().count()


def test_a_much_repeated_label_does_not_multiply_the_log(spark, log, labels, conf):
    """20,000 copies of the hot pair's label: weights, not 20,000 x 20,000 joined rows."""
    hot = spark.range(20_000).select(F.lit(1).cast("long").alias("user_id"), F.lit(1).cast("long").alias("seller_id"), F.lit(1).alias("label"))
    repeated = labels.unionByName(hot)
    pairs = staged(label_pairs(repeated), "pairs")
    assert pairs.count() == labels.count()
    joined = join_log_labels(with_day(log), pairs)
    assert joined.count() == log.count()
    clicks = blocks.user_action_totals(joined).filter("user_id = 1").first().ttl_c
    own = log.filter("user_id = 1 and action_type = 0").groupBy("seller_id").count().collect()
    assert clicks == sum(r["count"] * (20_001 if r.seller_id == 1 else 1) for r in own)


@pytest.mark.parametrize("copies", [0, 1, 4096, 4097, 100_000])
def test_fan_out_counts(spark, copies):
    df = spark.createDataFrame([(1, copies), (2, None), (3, 2)], "k long, n long")
    got = {r.k: r["count"] for r in fan_out(df, "n").groupBy("k").count().collect()}
    assert got == {k: v for k, v in {1: copies, 3: 2}.items() if v}


def test_blocks_read_only_their_columns(log, labels):
    labelled = staged(join_log_labels(with_day(log), label_pairs(labels)), "labelled_log")
    unread = {
        blocks.pair_block: {"cat_id", "brand_id"},
        blocks.seller_block: {"day"},
        blocks.month_block: {"item_id", "cat_id", "brand_id", "seller_id"},
    }
    for block, columns in unread.items():
        plan = block(labelled)._jdf.queryExecution().executedPlan().toString()
        scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
        read = {name.split("#")[0] for name in scan[scan.index("[") + 1 : scan.index("]")].split(",")}
        assert read == set(labelled.columns) - columns, block.__name__


def test_repeats_of_a_hot_user_are_spread(spark, conf):
    """A user with 1,500 purchased sellers repeats each of 1,500 rows 1,500 times."""
    conf({"spark.sql.shuffle.partitions": "16"})
    hot = spark.range(1500).selectExpr("1L AS user_id", "id AS seller_id", "1500L AS n")
    many = spark.range(20_000).selectExpr("id + 2 AS user_id", "id AS seller_id", "1L AS n")
    rows = fan_out(hot.union(many).coalesce(1), "n", by=["user_id", "seller_id"])
    per_task = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(per_task) == 1500 * 1500 + 20_000
    assert max(per_task) < 2 * sum(per_task) / 16
