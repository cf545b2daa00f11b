"""What a table's making leaves on disk, and how often its rows are moved."""

import re

import pytest
from pyspark.sql import functions as F

from checks import queries
from patronlens import FeatureConfig
from patronlens.config import PAIR_KEY
from patronlens.operators import blocks, fan_out
from patronlens.operators.labelled import with_day
from patronlens.operators.split import pair_hash
from patronlens.plans import features, full_features, training
from patronlens.plans.tables import CLEANUP, freed_shuffles, settled, staged


def rows_of(df):
    return sorted(map(str, df.collect()))


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


@pytest.fixture
def three(make):
    """Some users and sellers with many rows, pairs listed twice or with both labels, nulls."""
    log = [(i % 7 if i % 3 else 1, i % 5, i % 11, i % 4 or None, i % 6 or None, f"{i % 12 + 1:02d}{i % 28 + 1:02d}" if i % 13 else None, i % 4) for i in range(600)]
    labels = [(u, s, (u + s) % 2) for u in range(8) for s in range(5) if (u + s) % 3] * 2 + [(1, 2, 0), (1, 3, 1)]
    return make(log, labels, [(u, str(u % 9), None) for u in range(5)])


def test_staging_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    dealt = staged(spark.range(1000).repartition(4, "id"), "dealt")
    assert not shuffle_files(spark) - before
    assert dealt.count() == 1000 and spark.conf.get(CLEANUP, None) is None


def test_freeing_blocks_may_overlap(spark, conf):
    conf({CLEANUP: "false"})
    with freed_shuffles(spark):
        with freed_shuffles(spark):
            assert spark.conf.get(CLEANUP) == "true"
        assert spark.conf.get(CLEANUP) == "true"
    assert spark.conf.get(CLEANUP) == "false"


def test_only_tables_that_shuffles_made_are_settled(spark, conf):
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    read = staged(spark.range(10).withColumn("x", F.lit(1)), "read")
    plain = read.select("id", (F.col("x") + 1).alias("y"))
    assert settled(plain, "plain") is plain
    joined = settled(read.join(read.select("id"), "id"), "joined")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 10


@pytest.mark.parametrize("block", [blocks.user_block, blocks.seller_block, blocks.pair_block, blocks.basic_pair_block])
def test_whole_keys_move_once(three, block):
    log = with_day(three[0])
    whole = block(log, whole=True)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("Exchange hashpartitioning", plan)) == 1 and "Expand" not in plan
    assert rows_of(whole) == rows_of(block(log))


@pytest.mark.parametrize("semantics", ["reference", "corrected"])
def test_hot_keys_change_no_result(three, monkeypatch, semantics):
    config = FeatureConfig(semantics=semantics)
    plain = rows_of(full_features(*three, config))
    monkeypatch.setattr(features, "HOT_ROWS", 100)
    monkeypatch.setattr(features, "HOT_SHARE", 6)
    seen = with_day(three[0])
    assert features.hot_keys(seen, "user_id") == [1]
    hot = features.by_key(blocks.user_block, seen, "user_id", [1], config)
    assert "Expand" in hot._jdf.queryExecution().executedPlan().toString()
    assert rows_of(hot) == rows_of(blocks.user_block(seen, config))
    assert rows_of(full_features(*three, config)) == plain


@pytest.mark.parametrize("few", [0, 1, 3, 10**9])
def test_few_repeats_stay_where_they_are(spark, monkeypatch, few):
    monkeypatch.setattr(features, "FEW", few)
    table = staged(spark.createDataFrame([(1, 0), (2, None), (3, 1), (4, 3), (5, 600)], "k long, n long"), "counts")
    twice = features.repeated(table, "n", ["k"], lambda df: df.withColumn("d", 2 * F.col("k")))
    assert rows_of(twice) == rows_of(fan_out(table.withColumn("d", 2 * F.col("k")), "n", by=["k"]))


def test_the_wide_table_is_not_shuffled_for_its_repeats(three, conf):
    """Rows repeated a few times only lie staged with their weight; what else would be shuffled has more."""
    table = full_features(*three)
    plan = table._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if re.search(r"\bExchange\b", line)]
    assert len(exchanges) == 1 and "_chunk" in exchanges[0]
    assert f"> {features.FEW}" in plan and "Join" not in plan
    weights = full_features(*three, repeats="weight")
    assert rows_of(table) == rows_of(fan_out(weights, "weight"))


def test_normalized_rows_are_not_shuffled(spark):
    """Their values are as many bytes as they look like: they are made after any shuffle."""
    table = queries.normalized_features(spark, "/root/testdata/sf0.001")
    plan = table._jdf.queryExecution().executedPlan().toString()
    before = plan[: plan.index("Exchange")]
    assert len(re.findall(r"\bExchange\b", plan)) == 1 and "UDF(" in before and "UDF(" not in plan[plan.index("Exchange") :].split("FileScan")[0]


def test_model_rows_leave_no_shuffle_files(spark):
    """What cross-validation starts from: label pairs, log, users, sellers and pairs are all joined by then."""
    before = shuffle_files(spark)
    rows = queries._model_rows(spark, "/root/testdata/sf0.001")
    assert not shuffle_files(spark) - before
    pairs = rows.select(*PAIR_KEY).distinct().count()
    before = shuffle_files(spark)
    few = training.bounded(rows, 200)
    assert not shuffle_files(spark) - before
    chosen = rows.filter(pair_hash(training.SPLIT_SEED + 2) % 1_000_000 < 200 / pairs * 1_000_000)
    assert few.count() > 100 and rows_of(few) == rows_of(chosen)


def test_several_models_score_in_one_pass(spark, monkeypatch):
    """Each row is read and assembled once; scores are those of the models by themselves."""
    for name, grid in {"lr": {"maxIter": [3]}, "dt": {"maxDepth": [3]}, "rf": {"numTrees": [4], "maxDepth": [3]}, "gbt": {"maxIter": [2], "maxDepth": [2]}}.items():
        monkeypatch.setitem(training.GRIDS, name, grid)
    rows = queries._model_rows(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(queries, "_model_rows", lambda spark, sf_dir: rows)
    every = queries.score_pairs(spark, "/root/testdata/sf0.001")
    plan = every._jdf.queryExecution().executedPlan().toString()
    light = plan[: plan.index("Exchange")]
    assert len(re.findall("FileScan", plan)) == 2 and len(re.findall(r"\bExchange\b", plan)) == 1 and "UDF(" in light
    fit = rows.filter("split = 'train'")
    for name in training.CLASSIFIERS:
        model = training.train(fit, name, weight="weight", max_fit_pairs=queries.FIT_PAIRS)
        alone = fan_out(training.score(model, rows, [*PAIR_KEY, "weight"]), "weight")
        columns = [*(F.col(k).cast("long").alias(k) for k in PAIR_KEY), "prediction", "probability"]
        assert rows_of(every.filter(F.col("model") == name).drop("model")) == rows_of(alone.select(*columns))
    other = training.train(fit, "dt", columns=["ttl_c"], weight="weight", keep=False)
    with pytest.raises(ValueError, match="same columns"):
        training.score_each({"dt": other, "lr": training.train(fit, "lr", weight="weight", max_fit_pairs=queries.FIT_PAIRS)}, rows)
