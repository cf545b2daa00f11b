import os

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from patronlens import FeatureConfig
from patronlens.operators import register_views
from patronlens.plans import full_features, tables
from patronlens.plans.sizing import session_settings
from patronlens.sources import (
    read_features,
    read_labels,
    read_user_info,
    read_user_log,
    write_features,
    write_predictions,
)
from patronlens.sources.adapters import events_user_log, inputs


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_log_columns_go_by_name_and_days_keep_their_zero(spark, tmp_path):
    path = write(
        tmp_path, "log.csv",
        "user_id,item_id,cat_id,seller_id,brand_id,time_stamp,action_type\n1,2,3,4,,0511,0\n5,6,7,8,9,1111,2\n",
    )
    rows = sorted(read_user_log(spark, path).collect())
    assert tuple(rows[0]) == (1, 2, 3, 4, None, "0511", 0)
    assert rows[1].time_stamp == "1111"
    shuffled = write(tmp_path, "log2.csv", "action_type,time_stamp,user_id,item_id,cat_id,seller_id,brand_id\n0,0511,1,2,3,4,\n")
    assert tuple(read_user_log(spark, shuffled).first()) == tuple(rows[0])


def test_label_columns_go_by_position(spark, tmp_path):
    path = write(tmp_path, "labels.csv", "user,merchant,prob\n1,2,1\n3,4,\n")
    df = read_labels(spark, path)
    assert df.dtypes == [("user_id", "bigint"), ("seller_id", "bigint"), ("label", "int")]
    assert sorted(map(tuple, df.collect())) == [(1, 2, 1), (3, 4, None)]


def test_profile(spark, tmp_path):
    path = write(tmp_path, "info.csv", "user_id,age_range,gender\n1,3,0\n2,,\n")
    assert sorted(map(tuple, read_user_info(spark, path).collect())) == [(1, "3", "0"), (2, None, None)]


def test_parquet_inputs(spark, tmp_path):
    log, labels, info = inputs(spark, SMALL, "events")
    for frame, name in ((log, "log"), (labels, "labels"), (info, "info")):
        frame.write.parquet(str(tmp_path / name))
    back = (
        read_user_log(spark, str(tmp_path / "log"), "parquet"),
        read_labels(spark, str(tmp_path / "labels"), "parquet"),
        read_user_info(spark, str(tmp_path / "info"), "parquet"),
    )
    want, got = full_features(log, labels, info), full_features(*back)
    assert want.exceptAll(got).count() == got.exceptAll(want).count() == 0


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_feature_tables_survive_the_round_trip(spark, tmp_path, fmt):
    features = full_features(*inputs(spark, SMALL, "events"))
    path = str(tmp_path / "features")
    for _ in range(2):  # the second write replaces the first
        write_features(features, path, fmt)
    back = read_features(spark, path, fmt)
    assert back.columns == FeatureConfig().full_columns()
    assert features.exceptAll(back).count() == back.exceptAll(features).count() == 0


def test_predictions_are_kept_per_model(spark, tmp_path):
    df = spark.createDataFrame([("lr", 1, 2, 1.0, 0.75), ("rf", 1, 2, 0.0, 0.25)], "model string, user_id long, seller_id long, prediction double, probability double")
    path = str(tmp_path / "predictions")
    write_predictions(df, path)
    assert spark.read.parquet(f"{path}/model=rf").first().probability == 0.25
    assert sorted(map(tuple, spark.read.parquet(path).select(df.columns).collect())) == sorted(map(tuple, df.collect()))


def test_views_and_sql_text_give_the_same_rows(spark):
    log = events_user_log(spark, SMALL)
    register_views({"user_actions": log})
    try:
        sql = spark.sql("SELECT user_id, count(*) AS n FROM user_actions WHERE action_type = 0 GROUP BY user_id")
        api = log.filter("action_type = 0").groupBy("user_id").agg(F.count("*").alias("n"))
        assert sql.exceptAll(api).count() == api.exceptAll(sql).count() == 0
    finally:
        assert spark.catalog.dropTempView("user_actions")


def test_staged_tables_use_the_named_folder(spark):
    folder = spark.conf.get(tables.CHECKPOINT_DIR)
    assert tables.checkpoint_folder(spark) == folder
    df = spark.range(5).withColumn("d", F.lit("2014-05-11").cast("date"))
    kept = tables.staged(df, "numbers")
    assert kept.dtypes == df.dtypes and kept.count() == 5
    assert f"{folder}/patronlens/numbers-" in kept.inputFiles()[0]


def test_no_shared_folder_on_a_cluster_means_no_table(spark, monkeypatch):
    monkeypatch.setattr(tables, "checkpoint_folder", lambda spark: None)
    with pytest.raises(ValueError, match="numbers is staged"):
        tables.staged(spark.range(5), "numbers")


def test_temporary_tables_are_dropped(spark):
    with tables.temporary_tables(spark):
        first, second = tables.staged_together({"a": spark.range(3), "b": spark.range(4)})
        kept = first.inputFiles() + second.inputFiles()
        assert (first.count(), second.count()) == (3, 4)
        assert all("/patronlens/run-" in path and os.path.exists(path.removeprefix("file://")) for path in kept)
    assert not any(os.path.exists(path.removeprefix("file://")) for path in kept)
    outside = tables.staged(spark.range(2), "c")
    assert "/run-" not in outside.inputFiles()[0] and outside.count() == 2


def test_settings_grow_with_the_log():
    small, large = session_settings(10**6), session_settings(100 * 10**12)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert int(large["spark.sql.shuffle.partitions"]) > 100_000
