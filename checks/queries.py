"""Every operator as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.config import PAIR_KEY, FeatureConfig
from patronlens.functions import fill_profile
from patronlens.operators import blocks
from patronlens.operators.labelled import join_log_labels, label_pairs, with_day
from patronlens.operators.relational import attach_left, full_outer_chain, share_of_total
from patronlens.operators.split import keyed_split, row_split
from patronlens.plans import evaluation, training
from patronlens.plans.features import basic_features, full_features, labelled_log, repeated
from patronlens.plans.tables import staged, staged_together, table_path
from patronlens.sources import read_features, rejected_days, write_features
from patronlens.sources.adapters import inputs, load

CONFIG = FeatureConfig()
CORRECTED = FeatureConfig(semantics="corrected")
Query = Callable[[SparkSession, str], DataFrame]


def _log(spark: SparkSession, sf_dir: str, shape: str = "star") -> DataFrame:
    log, labels, _ = inputs(spark, sf_dir, shape)
    return labelled_log(log, labels, CONFIG)


def _day_text(df: DataFrame) -> DataFrame:
    return df.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def scan_user_log(spark, sf_dir):
    return inputs(spark, sf_dir)[0]


def scan_labels(spark, sf_dir):
    return inputs(spark, sf_dir)[1]


def scan_user_info(spark, sf_dir):
    return inputs(spark, sf_dir)[2]


def date_normalize(spark, sf_dir):
    log = scan_user_log(spark, sf_dir).select("user_id", "seller_id", "item_id", "time_stamp")
    return _day_text(with_day(log.withColumn("text", F.col("time_stamp")), CONFIG))


def filter_action(spark, sf_dir):
    return scan_user_log(spark, sf_dir).filter(F.col("action_type") == CONFIG.purchase)


def filter_month(spark, sf_dir):
    dated = with_day(scan_user_log(spark, sf_dir), CONFIG)
    return _day_text(dated.filter(F.month("day") == 5))


def filter_before_cutoff(spark, sf_dir):
    cutoff = F.lit(CONFIG.cutoff)
    dated = with_day(scan_user_log(spark, sf_dir), CONFIG)
    kept = dated.filter((F.col("action_type") == CONFIG.purchase) & (F.col("day") < cutoff))
    return _day_text(kept).withColumn("cutoff", F.date_format(cutoff, "yyyy-MM-dd"))


def fill_user_info(spark, sf_dir):
    return fill_profile(scan_user_info(spark, sf_dir))


def join_log_labels_query(spark, sf_dir):
    log, labels, _ = inputs(spark, sf_dir)
    joined = join_log_labels(with_day(log, CONFIG), label_pairs(labels))
    return _day_text(joined)


def purchase_history(spark, sf_dir):
    return _day_text(blocks.purchase_history(_log(spark, sf_dir)))


def on_log(build: Callable[[DataFrame], DataFrame], shape: str = "star") -> Query:
    """A query that is one block over the labelled log."""
    return lambda spark, sf_dir: build(_log(spark, sf_dir, shape))


def user_features(spark, sf_dir, shape="star"):
    return blocks.user_block(_log(spark, sf_dir, shape), CONFIG)


def join_full_outer(spark, sf_dir):
    log = staged(_log(spark, sf_dir), "labelled_log")
    counts = [
        log.filter(F.col("action_type") == code).groupBy("user_id").agg(F.sum("label_rows").alias(name))
        for name, code in {"ttl_c": CONFIG.click, "ttl_p": CONFIG.purchase, "ttl_f": CONFIG.favourite}.items()
    ]
    return full_outer_chain(counts, ["user_id"])


def join_left_attach(spark, sf_dir):
    log, labels, info = inputs(spark, sf_dir)
    labelled = staged(labelled_log(log, labels, CONFIG), "labelled_log")
    actions = F.sum("label_rows")
    users, sellers = staged_together({
        "users": labelled.groupBy("user_id").agg(actions.alias("user_actions")),
        "sellers": labelled.groupBy("seller_id").agg(actions.alias("seller_actions")),
    })
    pairs = labelled.groupBy(*PAIR_KEY).agg(actions.alias("pair_actions"))
    return attach_left(pairs, users, sellers, fill_profile(info))


def join_implicit_inner(spark, sf_dir):
    log = staged(_log(spark, sf_dir), "labelled_log")
    weight = F.sum("label_rows")
    totals = log.groupBy(*PAIR_KEY).agg(weight.alias("total_action_count"))
    clicks = log.filter(F.col("action_type") == CONFIG.click).groupBy(*PAIR_KEY).agg(weight.alias("u_m_c_cnt"))
    return share_of_total(totals, clicks, "u_m_c_cnt", "total_action_count", "c_ratio")


def features_full(spark, sf_dir, shape="star", config=CONFIG):
    return full_features(*inputs(spark, sf_dir, shape), config)


def features_weighted(spark, sf_dir):
    return full_features(*inputs(spark, sf_dir), CONFIG, repeats="weight")


def features_basic(spark, sf_dir, shape="star"):
    return basic_features(*inputs(spark, sf_dir, shape), CONFIG)


def features_typed(spark, sf_dir):
    """The wide table through its CSV form and back."""
    path = table_path(spark, "features_csv")
    if path is None:
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    write_features(features_full(spark, sf_dir, "events"), path, "csv")
    return read_features(spark, path, "csv", CONFIG)


def normalized_features(spark, sf_dir):
    columns = training.input_columns(CONFIG, everything=True)
    weighted = staged(features_weighted(spark, sf_dir), "weighted_rows")
    return repeated(weighted, "weight", PAIR_KEY, lambda df: training.normalized_columns(df, columns, keep=["weight"]))


def split_train_test(spark, sf_dir):
    return keyed_split(scan_labels(spark, sf_dir))


def split_rows(spark, sf_dir):
    """Many equal rows: what sellers' logs say when reduced to the action."""
    return row_split(scan_user_log(spark, sf_dir).select("seller_id", "action_type"))


def rejected_log_days(spark, sf_dir):
    """A log in which every seventh item has lost a digit of its day and every eleventh the day."""
    item, day = F.col("item_id"), F.col("time_stamp")
    spoilt = F.when(item % 11 == 0, F.lit(None)).when(item % 7 == 0, F.substring(day, 1, 3)).otherwise(day)
    return rejected_days(scan_user_log(spark, sf_dir).withColumn("time_stamp", spoilt))


def _scored_documents(spark, sf_dir):
    labels, documents = load(spark, sf_dir, "labels"), load(spark, sf_dir, "documents")
    return labels.join(documents.select("doc_id", "n_chars"), "doc_id").select(
        F.col("quality").cast("double").alias("label"),
        F.col("toxic").cast("double").alias("prediction"),
        F.round(F.col("n_chars") / 1000.0, 0).alias("score"),
    )


def _rounded(df: DataFrame) -> DataFrame:
    doubles = {name for name, kind in df.dtypes if kind == "double"}
    return df.select(*[F.round(c, 9).alias(c) if c in doubles else F.col(c) for c in df.columns])


def metric_multiclass(spark, sf_dir):
    return _rounded(evaluation.class_metrics(_scored_documents(spark, sf_dir)))


def metric_auc_hard(spark, sf_dir):
    return _rounded(evaluation.hard_auc(_scored_documents(spark, sf_dir)))


def threshold_curve(spark, sf_dir, score="score", label="label"):
    return _rounded(evaluation.threshold_curve(_scored_documents(spark, sf_dir), score, label))


def area_under_curves(spark, sf_dir, score="score", label="label"):
    return _rounded(evaluation.curve_areas(_scored_documents(spark, sf_dir), score, label))


def eval_report(spark, sf_dir):
    return _rounded(evaluation.report(_scored_documents(spark, sf_dir), "documents", "all"))


# Labelled pairs a fit reads (training.train's bound): full grids and folds on one machine. Scores
# and reports cover every pair.
FIT_PAIRS = 1000


def _model_rows(spark, sf_dir):
    """All pairs, one row each with its weight, split by pair; staged, since fits reread them."""
    table = full_features(*inputs(spark, sf_dir), CORRECTED, repeats="weight")
    return staged(keyed_split(table), "model_rows")


def cross_validated(spark, sf_dir, name):
    """Train on the training side, then report both sides with the model's own scores."""
    rows = _model_rows(spark, sf_dir)
    sides = {side: rows.filter(F.col("split") == side) for side in ("train", "test")}
    trained = training.train(sides["train"], name, weight="weight", max_fit_pairs=FIT_PAIRS)
    reports = [
        evaluation.report(
            training.score(trained, side_rows, [*PAIR_KEY, "label", "weight"]), name, side, score="probability", weight="weight"
        )
        for side, side_rows in sides.items()
    ]
    return reports[0].unionByName(reports[1])


def score_pairs(spark, sf_dir):
    """Every listed pair, as often as it is listed, scored by each cross-validated model."""
    rows = _model_rows(spark, sf_dir)
    train = rows.filter(F.col("split") == "train")
    models = {name: training.train(train, name, weight="weight", max_fit_pairs=FIT_PAIRS) for name in training.CLASSIFIERS}
    every = repeated(rows, "weight", PAIR_KEY, lambda part: training.score_each(models, part, [*PAIR_KEY, "weight"]))
    return every.select("model", *[F.col(k).cast("long").alias(k) for k in PAIR_KEY], "prediction", "probability")


def _weighted_lines(spark, sf_dir):
    """Lines as predictions: returned or not against a discount above the middle, by quantity."""
    return load(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        (F.col("l_discount") > 0.05).cast("double").alias("prediction"),
        F.round("l_tax", 2).alias("score"),
        F.col("l_quantity").cast("long").alias("weight"),
    )


def metric_multiclass_weighted(spark, sf_dir):
    return _rounded(evaluation.class_metrics(_weighted_lines(spark, sf_dir), weight="weight"))


def area_under_curves_weighted(spark, sf_dir):
    return _rounded(evaluation.curve_areas(_weighted_lines(spark, sf_dir), "score", weight="weight"))


def _dense_orders(spark, sf_dir):
    """Almost as many scores as orders; every seventh order has none."""
    orders = load(spark, sf_dir, "orders")
    return orders.select(
        (F.col("o_orderstatus") == "F").cast("double").alias("label"),
        F.col("o_totalprice").cast("double").alias("dense"),
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice").cast("double")).alias("score"),
    )


def threshold_curve_dense(spark, sf_dir, score="dense"):
    return _rounded(evaluation.threshold_curve(_dense_orders(spark, sf_dir), score))


def area_under_curves_dense(spark, sf_dir):
    return _rounded(evaluation.curve_areas(_dense_orders(spark, sf_dir), "dense"))


def queries() -> dict[str, Query]:
    distinct = {"items": ("item_id", "dis"), "sellers": ("seller_id", "mer"), "cats": ("cat_id", "cat"), "brands": ("brand_id", "brand")}
    bought = f"action_type = {CONFIG.purchase}"
    registered: dict[str, Query] = {
        "scan_user_log": scan_user_log,
        "scan_labels": scan_labels,
        "scan_user_info": scan_user_info,
        "date_normalize": date_normalize,
        "filter_action": filter_action,
        "filter_month": filter_month,
        "filter_before_cutoff": filter_before_cutoff,
        "fill_user_info": fill_user_info,
        "join_log_labels": join_log_labels_query,
        "purchase_history": purchase_history,
        "user_action_totals": on_log(blocks.user_action_totals),
        **{
            f"user_distinct_{name}": on_log(partial(blocks.user_distinct, dim=dim, prefix=prefix))
            for name, (dim, prefix) in distinct.items()
        },
        "user_active_days": on_log(blocks.user_active_days),
        "span_actions": on_log(lambda log: blocks.span(log, ["user_id"], "avg_span_actions")),
        "span_purchase": on_log(lambda log: blocks.span(log.filter(bought), ["user_id"], "avg_span_purchase")),
        "span_pair": on_log(lambda log: blocks.span(log, PAIR_KEY, "avg_span_act_um")),
        "last_purchase_span": on_log(blocks.last_purchase_span),
        "fanout_ratio": on_log(blocks.fanout_ratio),
        "join_full_outer": join_full_outer,
        "join_left_attach": join_left_attach,
        "join_implicit_inner": join_implicit_inner,
        "features_weighted": features_weighted,
        "features_typed": features_typed,
        "normalized_features": normalized_features,
        "split_train_test": split_train_test,
        "split_rows": split_rows,
        "rejected_days": rejected_log_days,
        "features_corrected": partial(features_full, config=CORRECTED),
        "metric_multiclass": metric_multiclass,
        "metric_auc_hard": metric_auc_hard,
        "threshold_curve": threshold_curve,
        "threshold_curve_swapped": partial(threshold_curve, score="label", label="prediction"),
        "area_under_curves": area_under_curves,
        "area_under_curves_swapped": partial(area_under_curves, score="label", label="prediction"),
        "metric_multiclass_weighted": metric_multiclass_weighted,
        "area_under_curves_weighted": area_under_curves_weighted,
        "threshold_curve_dense": threshold_curve_dense,
        "threshold_curve_nulls": partial(threshold_curve_dense, score="score"),
        "area_under_curves_dense": area_under_curves_dense,
        "eval_report": eval_report,
        **{f"cv_{name}": partial(cross_validated, name=name) for name in training.CLASSIFIERS},
        "score_pairs": score_pairs,
    }
    for suffix, shape in (("", "star"), ("_events", "events")):
        registered |= {
            f"user_features{suffix}": partial(user_features, shape=shape),
            f"month_features{suffix}": on_log(blocks.month_block, shape),
            f"seller_features{suffix}": on_log(blocks.seller_block, shape),
            f"pair_features{suffix}": on_log(blocks.pair_block, shape),
            f"features_full{suffix}": partial(features_full, shape=shape),
            f"features_basic{suffix}": partial(features_basic, shape=shape),
        }
    return registered
