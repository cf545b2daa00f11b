"""The wide table built the long way: one aggregate and one join per feature.

check of the grouped blocks. Not part of the library.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronlens.config import PAIR_KEY, FeatureConfig
from patronlens.functions import fill_profile
from patronlens.operators.labelled import with_day
from patronlens.plans.features import typed

CONFIG = FeatureConfig()
ACTIONS = {"c": 0, "p": 2, "f": 3}


def _join(frames, keys, how):
    return reduce(lambda a, b: a.join(b, keys, how), frames)


def _span(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    parts = [rows.groupBy(*keys).agg(f.alias(n)) for f, n in ((F.max("day"), "hi"), (F.min("day"), "lo"), (F.count("*"), "n"))]
    return _join(parts, keys, "inner").select(*keys, (F.date_diff("hi", "lo") / F.col("n")).alias(name))


def wide_table(log: DataFrame, labels: DataFrame, info: DataFrame) -> DataFrame:
    rows = with_day(log, CONFIG).join(labels, PAIR_KEY)
    of = {a: rows.filter(F.col("action_type") == code) for a, code in ACTIONS.items()}

    def one(source: DataFrame, keys: list[str], value, name: str) -> DataFrame:
        return source.groupBy(*keys).agg(value.alias(name))

    def per_action(keys, value, pattern):
        return [one(of[a], keys, value, pattern.format(a)) for a in ACTIONS]

    count, distinct, user, seller = F.count("*"), F.count_distinct, ["user_id"], ["seller_id"]
    bought = one(of["p"], PAIR_KEY, distinct("seller_id"), "bought")
    share = one(rows, user, distinct("seller_id"), "sellers").join(bought, "user_id", "full").select(
        "user_id", (F.col("bought") / F.col("sellers")).alias("u_p_m_ratio")
    )
    last = of["p"].filter(F.col("day") < F.lit(CONFIG.cutoff)).groupBy("user_id").agg(
        F.date_diff(F.lit(CONFIG.cutoff), F.max("day")).alias("last_span")
    )
    users = _join(
        per_action(user, count, "ttl_{}")
        + [f for n, d in (("dis", "item_id"), ("mer", "seller_id"), ("cat", "cat_id"), ("brand", "brand_id"))
           for f in per_action(user, distinct(d), n + "_{}")]
        + [one(rows, user, distinct("day"), "ttl_act_d"), *per_action(user, distinct("day"), "u_{}_d_cnt"), share,
           _span(rows, user, "avg_span_actions"), _span(of["p"], user, "avg_span_purchase"), last],
        user, "full",
    )
    months = []
    for number, name in CONFIG.month_names():
        months += [one(of[a].filter(F.month("day") == number), user, count, f"{name}_{a}_cnt") for a in ACTIONS]
    months += [one(rows.filter(F.month("day") == n), user, count, f"{name}_tt") for n, name in CONFIG.month_names()]
    users = users.join(_join(months, user, "left"), user, "full")

    sellers = _join(
        [one(rows, seller, distinct(d), n) for n, d in (("ttl_item", "item_id"), ("ttl_cat", "cat_id"), ("ttl_brand", "brand_id"))]
        + per_action(seller, count, "{}_cnt") + per_action(seller, distinct("user_id"), "{}_u_cnt"),
        seller, "full",
    )

    totals = one(rows, PAIR_KEY, count, "total_action_count")
    counts = {a: one(of[a], PAIR_KEY, count, f"u_m_{a}_cnt") for a in ACTIONS}
    shares = [
        totals.join(counts[a], PAIR_KEY).select(
            *PAIR_KEY, *(["total_action_count"] if a == "c" else []),
            (F.col(f"u_m_{a}_cnt") / F.col("total_action_count")).alias(f"{a}_ratio"),
        )
        for a in ACTIONS
    ]
    again = counts["p"].select(*PAIR_KEY, (F.col("u_m_p_cnt") - 1).alias("u_m_r_cnt"))
    pairs = _join(
        [counts["c"], counts["p"], one(of["p"], PAIR_KEY, distinct("item_id"), "u_m_p_i_cnt"), again, counts["f"],
         one(rows, PAIR_KEY, distinct("day"), "um_act_d"), _span(rows, PAIR_KEY, "avg_span_act_um"), *shares],
        PAIR_KEY, "full",
    )
    wide = (
        pairs.join(users, user, "left").join(sellers, seller, "left")
        .join(fill_profile(info), user, "left").join(labels, PAIR_KEY)
    )
    return typed(wide.na.fill(0).na.fill("0"), CONFIG)
