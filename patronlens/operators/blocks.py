"""Feature blocks per pair, user and seller.

Each block is two grouped steps over the labelled log:

1. *Facts*: one row per (key, value) for each counted dimension, via GROUPING SETS, with the
   weighted number of clicks, purchases, favourites and actions. The sets share one pass.
2. *Roll-up*: one row per key. A distinct count is the number of facts that pass a test, and
   totals, spans and months come from the day facts.

Both steps aggregate before they shuffle. Step 1 is spread over (key, value), so a key that
owns a large part of the log is spread too; in step 2 each task sends at most one row per key.

That is a row per fact in the first shuffle and, with many partitions, nearly one in the second.
With ``whole=True``, for keys of which none is too large for a task, the log's rows are shuffled by
key instead, once, and both steps follow where they arrive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from patronlens.config import PAIR_KEY, FeatureConfig
from patronlens.functions.numbers import average_span, ratio
from patronlens.operators.fanout import fan_out

ACTIONS = ("c", "p", "f")


def weighted(log: DataFrame) -> DataFrame:
    """Give a log that was not joined with labels the weight 1 per row."""
    return log if "label_rows" in log.columns else log.withColumn("label_rows", F.lit(1))


def keyed_facts(log: DataFrame, key: list[str], dims: list[str], whole: bool = False) -> tuple[GroupedData, dict[str, Column]]:
    """The log grouped by (key, value) for every dimension, and what tells the dimensions apart."""
    if not whole:
        sets = log.groupingSets([[*key, dim] for dim in dims], *key, *dims)
        return sets, {dim: F.grouping(dim) == 0 for dim in dims}
    used = [*dict.fromkeys([*key, *dims])]
    kinds = {f.name: f.dataType for f in log.schema.fields}
    # Not GROUPING SETS: Spark forgets there that the rows of a key are together.
    values = [
        F.struct(F.lit(i).alias("_of"), *[(F.col(d) if d == dim else F.lit(None).cast(kinds[d])).alias(d) for d in dims])
        for i, dim in enumerate(dims)
    ]
    together = log.select(*used, "action_type", "label_rows").repartition(*key)
    each = together.select(*key, "action_type", "label_rows", F.explode(F.array(*values)).alias("_value"))
    each = each.select(*key, "action_type", "label_rows", "_value.*")
    return each.groupBy(*key, "_of", *dims), {dim: F.first("_of") == i for i, dim in enumerate(dims)}


def facts(log: DataFrame, key: list[str], dims: list[str], config: FeatureConfig, whole: bool = False) -> DataFrame:
    """Step 1: (key, value) facts for every dimension, told apart by ``of_<dimension>``."""
    weight = F.col("label_rows").cast("long")
    action = F.col("action_type")

    def weight_of(code: int) -> Column:
        return F.sum(F.when(action == code, weight).otherwise(F.lit(0)))

    grouped, of = keyed_facts(weighted(log), key, dims, whole)
    return grouped.agg(
        *[is_of.alias(f"of_{dim}") for dim, is_of in of.items()],
        weight_of(config.click).alias("c"),
        weight_of(config.purchase).alias("p"),
        weight_of(config.favourite).alias("f"),
        F.sum(weight).alias("n"),
    )


def values_with(dim: str, action: str = "n") -> Column:
    """Number of distinct non-null values of ``dim`` with at least one such action."""
    return F.expr(f"count_if(of_{dim} AND {dim} IS NOT NULL AND {action} > 0)")


def total(dim: str, action: str, test: str = "true") -> Column:
    """Weighted number of actions, read from the facts of one dimension."""
    return F.expr(f"coalesce(sum({action}) FILTER (WHERE of_{dim} AND {test}), 0)")


def pair_rollup(log: DataFrame, config: FeatureConfig, whole: bool = False) -> DataFrame:
    return (
        facts(log, PAIR_KEY, ["day", "item_id"], config, whole)
        .groupBy(*PAIR_KEY)
        .agg(
            *[total("day", a).alias(a) for a in (*ACTIONS, "n")],
            values_with("item_id", "p").alias("u_m_p_i_cnt"),
            values_with("day").alias("um_act_d"),
            F.max("day").alias("last_day"),
            F.min("day").alias("first_day"),
        )
    )


def _pair_columns(rollup: DataFrame, total_actions: Column) -> dict[str, Column]:
    c, p, f, n = (F.col(x) for x in (*ACTIONS, "n"))
    return {
        "u_m_c_cnt": c,
        "u_m_p_cnt": p,
        "u_m_p_i_cnt": F.col("u_m_p_i_cnt"),
        "u_m_r_cnt": F.greatest(p - 1, F.lit(0)),
        "u_m_f_cnt": f,
        "um_act_d": F.col("um_act_d"),
        "avg_span_act_um": average_span(F.col("last_day"), F.col("first_day"), n),
        "total_action_count": total_actions,
        "c_ratio": ratio(c, n),
        "p_ratio": ratio(p, n),
        "f_ratio": ratio(f, n),
    }


def pair_block(log: DataFrame, config: FeatureConfig = FeatureConfig(), whole: bool = False) -> DataFrame:
    """Features of a (user, seller) pair. The action total is 0 for pairs without a click."""
    rollup = pair_rollup(log, config, whole)
    total_actions = (
        F.col("n") if config.corrected else F.when(F.col("c") > 0, F.col("n")).otherwise(F.lit(0))
    )
    columns = _pair_columns(rollup, total_actions)
    return rollup.select(*PAIR_KEY, *[v.alias(k) for k, v in columns.items()])


def basic_pair_block(log: DataFrame, config: FeatureConfig = FeatureConfig(), whole: bool = False) -> DataFrame:
    """The same block for the basic table, where the total asks for a favourite instead."""
    rollup = pair_rollup(log, config, whole)
    total_actions = (
        F.col("n") if config.corrected else F.when(F.col("f") > 0, F.col("n")).otherwise(F.lit(0))
    )
    columns = _pair_columns(rollup, total_actions)
    return rollup.select(*PAIR_KEY, *[v.alias(k) for k, v in columns.items()])


def _month_counts(config: FeatureConfig) -> list[Column]:
    """Counts per month over day facts that carry their ``month``."""
    counts = [
        total("day", a, f"month = {m}").alias(f"{name}_{a}_cnt")
        for m, name in config.month_names() for a in ACTIONS
    ]
    return counts + [total("day", "n", f"month = {m}").alias(f"{name}_tt") for m, name in config.month_names()]


def _gated_months(config: FeatureConfig) -> list[Column]:
    """Month columns are kept only for users who clicked in the first month."""
    if config.corrected:
        return [F.col(c) for c in config.month_columns()]
    first = f"{config.month_names()[0][1]}_c_cnt"
    return [F.expr(f"if({first} > 0, {c}, 0) AS {c}") for c in config.month_columns()]


def month_block(log: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Monthly action counts per user."""
    by_day = facts(log, ["user_id"], ["day"], config).withColumn("month", F.month("day"))
    return by_day.groupBy("user_id").agg(*_month_counts(config)).select("user_id", *_gated_months(config))


def user_rollup(log: DataFrame, config: FeatureConfig, whole: bool = False) -> DataFrame:
    dims = {"dis": "item_id", "mer": "seller_id", "cat": "cat_id", "brand": "brand_id"}
    bought = F.when(F.col("p") > 0, F.col("day"))
    return (
        facts(log, ["user_id"], [*dims.values(), "day"], config, whole)
        .withColumn("month", F.month("day"))
        .groupBy("user_id")
        .agg(
            *[total("day", a).alias(f"ttl_{a}") for a in ACTIONS],
            total("day", "n").alias("n"),
            *[values_with(dim, a).alias(f"{name}_{a}") for name, dim in dims.items() for a in ACTIONS],
            values_with("day").alias("ttl_act_d"),
            *[values_with("day", a).alias(f"u_{a}_d_cnt") for a in ACTIONS],
            values_with("seller_id").alias("u_ttl_m_cnt"),
            F.max("day").alias("last_day"),
            F.min("day").alias("first_day"),
            F.max(bought).alias("last_bought"),
            F.min(bought).alias("first_bought"),
            F.max(F.when(F.col("day") < F.lit(config.cutoff), bought)).alias("bought_before_cutoff"),
            *_month_counts(config),
        )
    )


def user_block(log: DataFrame, config: FeatureConfig = FeatureConfig(), whole: bool = False) -> DataFrame:
    """Features of a user, and ``copies``: how often each of the user's rows is repeated.

    The purchased-seller share is spread over the purchased sellers, so a user with k of them
    gets k rows of 1 / (all sellers) each; corrected, it is one row with the whole share.
    """
    rollup = user_rollup(log, config, whole)
    purchased, sellers = F.col("mer_p"), F.col("u_ttl_m_cnt")
    if config.corrected:
        share, copies = ratio(purchased, sellers), F.lit(1).cast("long")
    else:
        share = F.when(purchased > 0, ratio(F.lit(1), sellers)).otherwise(F.lit(0.0))
        copies = F.greatest(purchased, F.lit(1)).cast("long")
    days_since = F.date_diff(F.lit(config.cutoff), F.col("bought_before_cutoff")).cast("long")
    computed = {
        "u_p_m_ratio": share,
        "avg_span_actions": average_span(F.col("last_day"), F.col("first_day"), F.col("n")),
        "avg_span_purchase": average_span(F.col("last_bought"), F.col("first_bought"), F.col("ttl_p")),
        "last_span": F.coalesce(days_since, F.lit(0)),
    }
    kept = [
        "ttl_c", "ttl_p", "ttl_f", "dis_c", "dis_p", "dis_f", "mer_c", "mer_p", "mer_f",
        "cat_c", "cat_p", "cat_f", "brand_c", "brand_p", "brand_f",
        "ttl_act_d", "u_c_d_cnt", "u_p_d_cnt", "u_f_d_cnt",
    ]
    return rollup.select(
        "user_id",
        *kept,
        *[v.alias(k) for k, v in computed.items()],
        *_gated_months(config),
        copies.alias("copies"),
    )


def seller_block(log: DataFrame, config: FeatureConfig = FeatureConfig(), whole: bool = False) -> DataFrame:
    """Features of a seller."""
    dims = {"item": "item_id", "cat": "cat_id", "brand": "brand_id"}
    return (
        facts(log, ["seller_id"], [*dims.values(), "user_id"], config, whole)
        .groupBy("seller_id")
        .agg(
            *[values_with(dim).alias(f"ttl_{name}") for name, dim in dims.items()],
            *[total("user_id", a).alias(f"{a}_cnt") for a in ACTIONS],
            *[values_with("user_id", a).alias(f"{a}_u_cnt") for a in ACTIONS],
        )
    )


def user_action_totals(log: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Clicks, purchases and favourites per user."""
    action, weight = F.col("action_type"), F.col("label_rows")
    codes = {"c": config.click, "p": config.purchase, "f": config.favourite}
    return weighted(log).groupBy("user_id").agg(
        *[F.coalesce(F.sum(F.when(action == code, weight)), F.lit(0)).alias(f"ttl_{a}") for a, code in codes.items()]
    )


def user_distinct(
    log: DataFrame, dim: str, prefix: str, config: FeatureConfig = FeatureConfig()
) -> DataFrame:
    """Distinct values of one dimension per user and action."""
    return facts(log, ["user_id"], [dim], config).groupBy("user_id").agg(
        *[values_with(dim, a).alias(f"{prefix}_{a}") for a in ACTIONS]
    )


def user_active_days(log: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Distinct days per user: with any action, and per action."""
    return facts(log, ["user_id"], ["day"], config).groupBy("user_id").agg(
        values_with("day").alias("ttl_act_d"),
        *[values_with("day", a).alias(f"u_{a}_d_cnt") for a in ACTIONS],
    )


def span(log: DataFrame, key: list[str], name: str) -> DataFrame:
    """Average span between the rows of a key: days from first to last over their number."""
    return weighted(log).groupBy(*key).agg(
        average_span(F.max("day"), F.min("day"), F.sum("label_rows")).alias(name)
    )


def last_purchase_span(log: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Days from a user's last purchase before the cutoff to the cutoff."""
    cutoff = F.lit(config.cutoff)
    bought = log.filter((F.col("action_type") == config.purchase) & (F.col("day") < cutoff))
    return bought.groupBy("user_id").agg(
        F.date_diff(F.max(cutoff), F.max("day")).cast("long").alias("last_span")
    )


def fanout_ratio(log: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """A user's purchased-seller share, once per purchased seller, or 0 without any."""
    per_user = facts(log, ["user_id"], ["seller_id"], config).groupBy("user_id").agg(
        values_with("seller_id", "p").alias("purchased"), values_with("seller_id").alias("sellers")
    )
    share = F.when(F.col("purchased") > 0, ratio(F.lit(1), F.col("sellers"))).otherwise(F.lit(0.0))
    copies = F.greatest(F.col("purchased"), F.lit(1))
    return fan_out(per_user.select("user_id", share.alias("u_p_m_ratio"), copies.alias("copies")), "copies", by=["user_id"])


def purchase_history(log: DataFrame, config: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Purchases in order of user and day.

    The rest of the row breaks ties, so that the sort can cut a busy user or day into several
    ranges.
    """
    columns = ["user_id", "day", "seller_id", "item_id", "cat_id", "brand_id"]
    return log.filter(F.col("action_type") == config.purchase).select(*columns).orderBy(*columns)
