"""DuckDB SQL for the registered queries.

Written apart from the Spark code: plain ``count(distinct ...)`` per feature, and joins (not
conditions) wherever a join shapes the result: the gates, the repeats, the label attach.
"""

from __future__ import annotations

STAR = """
user_log AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id, p_type AS cat_id, l_suppkey AS seller_id,
         CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE p_brand END AS brand_id,
         strftime(l_shipdate, '%m%d') AS time_stamp, (l_linenumber - 1) % 4 AS action_type
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
),
pair_list AS (
  SELECT DISTINCT o_custkey AS user_id, l_suppkey AS seller_id,
         CASE WHEN (o_custkey * 7 + l_suppkey * 13) % 10 < 3 THEN 1 ELSE 0 END AS label
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE (o_custkey + l_suppkey) % 3 <> 0
),
user_info AS (
  SELECT c_custkey AS user_id,
         CASE WHEN c_nationkey % 9 = 0 THEN NULL ELSE CAST(c_nationkey % 9 AS VARCHAR) END AS age_range,
         CASE c_mktsegment WHEN 'BUILDING' THEN '0' WHEN 'MACHINERY' THEN '1'
                           WHEN 'HOUSEHOLD' THEN '2' ELSE NULL END AS gender
  FROM customer WHERE c_custkey % 10 <> 0
)
"""

EVENTS = """
numbered AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events
),
user_log AS (
  SELECT user_id, k AS item_id, k % 7 AS cat_id, k % 10 AS seller_id,
         CASE WHEN k % 17 = 0 THEN NULL ELSE k % 13 END AS brand_id,
         strftime(DATE '2014-01-01' + CAST(event_id % 365 AS INT), '%m%d') AS time_stamp,
         CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1
                         WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 END AS action_type
  FROM numbered WHERE event_type <> 'error'
),
pair_list AS (
  SELECT DISTINCT user_id, k % 10 AS seller_id,
         CASE WHEN (user_id * 7 + (k % 10) * 13) % 10 < 3 THEN 1 ELSE 0 END AS label
  FROM numbered WHERE (user_id + k % 10) % 3 <> 0
),
user_info AS (
  SELECT user_id,
         CASE WHEN user_id % 9 = 0 THEN NULL ELSE CAST(user_id % 9 AS VARCHAR) END AS age_range,
         CASE WHEN user_id % 4 = 3 THEN NULL ELSE CAST(user_id % 4 AS VARCHAR) END AS gender
  FROM (SELECT DISTINCT user_id FROM events) WHERE user_id % 10 <> 0
)
"""

DAY = (
    "CAST(DATE '2014-01-01' + to_months(CAST(substr(time_stamp, 1, 2) AS INT) - 1)"
    " + to_days(CAST(substr(time_stamp, 3, 2) AS INT) - 1) AS DATE)"
)

LABELLED = f"""
dated AS (SELECT * EXCLUDE (time_stamp), {DAY} AS day FROM user_log),
l AS MATERIALIZED (SELECT dated.* FROM dated JOIN pair_list USING (user_id, seller_id))
"""

CODES = {"c": 0, "p": 2, "f": 3}
MONTHS = {5: "may", 6: "jun", 7: "jul", 8: "aug", 9: "sep", 10: "oct", 11: "nov"}
DIMS = {"dis": "item_id", "mer": "seller_id", "cat": "cat_id", "brand": "brand_id"}


def _counts(prefix: str, suffix: str = "") -> str:
    return ", ".join(
        f"count(*) FILTER (WHERE action_type = {code}) AS {prefix}{a}{suffix}" for a, code in CODES.items()
    )


def _distinct(value: str, prefix: str, suffix: str = "") -> str:
    return ", ".join(
        f"count(DISTINCT {value}) FILTER (WHERE action_type = {code}) AS {prefix}{a}{suffix}"
        for a, code in CODES.items()
    )


USER_BASE = f"""
user_counts AS (
  SELECT user_id, {_counts("ttl_")},
         {", ".join(_distinct(column, prefix + "_") for prefix, column in DIMS.items())},
         count(DISTINCT day) AS ttl_act_d, {_distinct("day", "u_", "_d_cnt")},
         date_diff('day', min(day), max(day)) / count(*) AS avg_span_actions
  FROM l GROUP BY user_id
),
bought_span AS (
  SELECT user_id, date_diff('day', min(day), max(day)) / count(*) AS avg_span_purchase
  FROM l WHERE action_type = 2 GROUP BY user_id
),
last_bought AS (
  SELECT user_id, date_diff('day', max(day), DATE '2014-11-11') AS last_span
  FROM l WHERE action_type = 2 AND day < DATE '2014-11-11' GROUP BY user_id
)
"""

MONTH_NAMES = [f"{m}_{a}_cnt" for m in MONTHS.values() for a in CODES] + [f"{m}_tt" for m in MONTHS.values()]

MONTH_BASE = f"""
month_counts AS (
  SELECT user_id,
    {", ".join(
        f"count(*) FILTER (WHERE month(day) = {number} AND action_type = {code}) AS {name}_{a}_cnt"
        for number, name in MONTHS.items() for a, code in CODES.items())},
    {", ".join(f"count(*) FILTER (WHERE month(day) = {number}) AS {name}_tt" for number, name in MONTHS.items())}
  FROM l GROUP BY user_id
),
may_clickers AS (SELECT DISTINCT user_id FROM l WHERE month(day) = 5 AND action_type = 0),
gated_months AS (SELECT month_counts.* FROM month_counts JOIN may_clickers USING (user_id))
"""

REPEATS = """
seller_totals AS (SELECT user_id, count(DISTINCT seller_id) AS sellers FROM l GROUP BY user_id),
bought_from AS (SELECT DISTINCT user_id, seller_id FROM l WHERE action_type = 2),
repeats AS (
  SELECT seller_totals.user_id, CASE WHEN bought_from.seller_id IS NULL THEN NULL ELSE 1 END / sellers AS u_p_m_ratio
  FROM seller_totals LEFT JOIN bought_from ON seller_totals.user_id = bought_from.user_id
)
"""

SELLER_BASE = f"""
seller_counts AS (
  SELECT seller_id, count(DISTINCT item_id) AS ttl_item, count(DISTINCT cat_id) AS ttl_cat,
         count(DISTINCT brand_id) AS ttl_brand, {_counts("", "_cnt")}, {_distinct("user_id", "", "_u_cnt")}
  FROM l GROUP BY seller_id
)
"""

PAIR_BASE = f"""
pair_counts AS (
  SELECT user_id, seller_id, {_counts("u_m_", "_cnt")}, count(*) AS actions,
         count(DISTINCT day) AS um_act_d,
         date_diff('day', min(day), max(day)) / count(*) AS avg_span_act_um
  FROM l GROUP BY user_id, seller_id
),
pair_bought AS (
  SELECT user_id, seller_id, count(DISTINCT item_id) AS u_m_p_i_cnt, count(*) - 1 AS u_m_r_cnt
  FROM l WHERE action_type = 2 GROUP BY user_id, seller_id
),
{"".join(
    f'''pairs_{a} AS (
  SELECT user_id, seller_id, count(*) AS part FROM l WHERE action_type = {code} GROUP BY user_id, seller_id
),
''' for a, code in CODES.items())}
totals AS (SELECT user_id, seller_id, count(*) AS actions FROM l GROUP BY user_id, seller_id),
{", ".join(
    f'''{a}_share AS (
  SELECT t.user_id, t.seller_id, t.actions AS total_of_{a}, n.part / t.actions AS {a}_ratio
  FROM totals t, pairs_{a} n WHERE t.user_id = n.user_id AND t.seller_id = n.seller_id
)''' for a in CODES)}
"""

PAIR_KEY = ["user_id", "seller_id"]
PAIR_NAMES = [
    "u_m_c_cnt", "u_m_p_cnt", "u_m_p_i_cnt", "u_m_r_cnt", "u_m_f_cnt", "um_act_d",
    "avg_span_act_um", "total_action_count", "c_ratio", "p_ratio", "f_ratio",
]
USER_NAMES = (
    [f"{prefix}_{a}" for prefix in ("ttl", *DIMS) for a in CODES]
    + ["ttl_act_d"] + [f"u_{a}_d_cnt" for a in CODES]
)
SPAN_NAMES = ["avg_span_actions", "avg_span_purchase", "last_span"]
SELLER_NAMES = (
    ["ttl_item", "ttl_cat", "ttl_brand"] + [f"{a}_cnt" for a in CODES] + [f"{a}_u_cnt" for a in CODES]
)
FULL_NAMES = (
    PAIR_KEY + PAIR_NAMES + USER_NAMES + ["u_p_m_ratio"] + SPAN_NAMES + MONTH_NAMES + SELLER_NAMES
    + ["age_range", "gender", "label"]
)
DOUBLES = {
    "avg_span_act_um", "c_ratio", "p_ratio", "f_ratio", "u_p_m_ratio", "avg_span_actions", "avg_span_purchase",
}


def _zero(names: list[str]) -> str:
    """Null becomes 0, with the column's own type."""
    return ", ".join(
        f"CAST(coalesce({n}, 0) AS {'DOUBLE' if n in DOUBLES else 'BIGINT'}) AS {n}" for n in names
    )


def _pairs(total_of: str) -> str:
    return f"""
pair_features AS (
  SELECT user_id, seller_id, {_zero([n for n in PAIR_NAMES if n != "total_action_count"])},
         CAST(coalesce({total_of}, 0) AS BIGINT) AS total_action_count
  FROM pair_counts LEFT JOIN pair_bought USING (user_id, seller_id)
  {" ".join(f"LEFT JOIN {a}_share USING (user_id, seller_id)" for a in CODES)}
)"""


PROFILE = """
profile AS (
  SELECT user_id, coalesce(age_range, '0') AS age_range, coalesce(gender, '2') AS gender FROM user_info
)
"""

WIDE_FROM = """
  FROM pair_features
  LEFT JOIN user_counts USING (user_id)
  LEFT JOIN bought_span USING (user_id)
  LEFT JOIN last_bought USING (user_id)
  LEFT JOIN {months} USING (user_id)
  LEFT JOIN {repeats} USING (user_id)
  LEFT JOIN seller_counts USING (seller_id)
  LEFT JOIN profile USING (user_id)
  JOIN pair_list USING (user_id, seller_id)
"""

ONE_REPEAT = """
purchased_share AS (
  SELECT user_id, count(DISTINCT seller_id) FILTER (WHERE action_type = 2) / count(DISTINCT seller_id) AS u_p_m_ratio
  FROM l GROUP BY user_id
)
"""

REPEAT_COUNTS = """
repeat_counts AS (SELECT user_id, max(u_p_m_ratio) AS u_p_m_ratio, count(*) AS weight FROM repeats GROUP BY user_id)
"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(p.strip() for p in parts) + "\n" + select.strip()


def _on_log(select: str, *parts: str, base: str = STAR) -> str:
    return _with(base, LABELLED, *parts, select=select)


def _doubles(missing_gender: str = "0") -> str:
    fills = {"age_range": "'0'", "gender": f"'{missing_gender}'"}
    return ", ".join(f"CAST(coalesce({n}, {fills.get(n, '0')}) AS DOUBLE) AS {n}" for n in FULL_NAMES)


WIDE_PARTS = [USER_BASE, MONTH_BASE, REPEATS, SELLER_BASE, PAIR_BASE, PROFILE]


def full(base: str = STAR) -> str:
    return _on_log(
        f"SELECT {_doubles()} {WIDE_FROM.format(months='gated_months', repeats='repeats')}",
        *WIDE_PARTS, _pairs("total_of_c"), base=base,
    )


def weighted() -> str:
    return _on_log(
        f"SELECT {_doubles()}, weight {WIDE_FROM.format(months='gated_months', repeats='repeat_counts')}",
        *WIDE_PARTS, REPEAT_COUNTS, _pairs("total_of_c"),
    )


def corrected() -> str:
    return _on_log(
        f"SELECT {_doubles('2')} {WIDE_FROM.format(months='month_counts', repeats='purchased_share')}",
        *WIDE_PARTS, ONE_REPEAT, _pairs("actions"),
    )


def basic(base: str = STAR) -> str:
    pair = [
        "u_m_c_cnt", "u_m_p_cnt", "u_m_f_cnt", "um_act_d", "avg_span_act_um",
        "c_ratio", "p_ratio", "total_action_count", "f_ratio",
    ]
    user = [f"{p}_{a}" for p in ("ttl", "dis", "mer", "cat") for a in CODES] + ["ttl_act_d"] + SPAN_NAMES
    seller = [f"{a}_cnt" for a in CODES] + [f"{a}_u_cnt" for a in CODES]
    return _on_log(
        f"""SELECT user_id, seller_id, label, {_zero(pair + user + MONTH_NAMES + seller)}, age_range, gender
  FROM pair_list JOIN pair_features USING (user_id, seller_id)
  LEFT JOIN user_counts USING (user_id) LEFT JOIN bought_span USING (user_id)
  LEFT JOIN last_bought USING (user_id) LEFT JOIN gated_months USING (user_id)
  LEFT JOIN seller_counts USING (seller_id) LEFT JOIN profile USING (user_id)""",
        USER_BASE, MONTH_BASE, SELLER_BASE, PAIR_BASE, PROFILE, _pairs("total_of_f"), base=base,
    )


def normalized() -> str:
    length = "sqrt(" + " + ".join(f"{n} * {n}" for n in FULL_NAMES) + ")"
    values = ", ".join(f"{n} / len AS {n}" for n in FULL_NAMES)
    return f"WITH wide AS ({full()}), sized AS (SELECT *, {length} AS len FROM wide) SELECT {values} FROM sized"


def user(base: str) -> str:
    return _on_log(
        f"""SELECT user_id, {_zero(USER_NAMES + ["u_p_m_ratio"] + SPAN_NAMES + MONTH_NAMES)}, weight AS copies
  FROM user_counts LEFT JOIN bought_span USING (user_id) LEFT JOIN last_bought USING (user_id)
  LEFT JOIN gated_months USING (user_id) LEFT JOIN repeat_counts USING (user_id)""",
        USER_BASE, MONTH_BASE, REPEATS, REPEAT_COUNTS, base=base,
    )


def month(base: str) -> str:
    return _on_log(
        f"SELECT user_id, {_zero(MONTH_NAMES)} FROM (SELECT DISTINCT user_id FROM l) LEFT JOIN gated_months USING (user_id)",
        MONTH_BASE, base=base,
    )


def seller(base: str) -> str:
    return _on_log("SELECT * FROM seller_counts", SELLER_BASE, base=base)


def pair(base: str) -> str:
    return _on_log("SELECT * FROM pair_features", PAIR_BASE, _pairs("total_of_c"), base=base)


SCORED = """
scored AS (
  SELECT CAST(l.quality AS DOUBLE) AS label, CAST(l.toxic AS DOUBLE) AS prediction,
         round(d.n_chars / 1000.0, 0) AS score
  FROM labels l JOIN documents d USING (doc_id)
)
"""

CLASSES = """
classes AS (
  SELECT label AS cls, count(*) AS support, count(*) FILTER (WHERE label = prediction) AS hits,
         (SELECT count(*) FROM scored o WHERE o.prediction = scored.label) AS predicted
  FROM scored GROUP BY label
),
rates AS (
  SELECT support, hits, CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS prec, hits / support AS rec
  FROM classes
)
"""

CLASS_METRICS = """
class_metrics AS (
  SELECT sum(hits) / sum(support) AS accuracy, sum(prec * support) / sum(support) AS weighted_precision,
         sum(rec * support) / sum(support) AS weighted_recall,
         sum(CASE WHEN prec + rec = 0 THEN 0 ELSE 2 * prec * rec / (prec + rec) END * support) / sum(support) AS f1
  FROM rates
)
"""


def _curve(score: str, label: str, prefix: str = "") -> str:
    p = prefix
    return f"""
{p}points AS (
  SELECT {score} AS threshold, count(*) FILTER (WHERE {label} > 0.5) AS pos,
         count(*) FILTER (WHERE {label} <= 0.5) AS neg
  FROM scored GROUP BY {score}
),
{p}running AS (
  SELECT threshold, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n
  FROM {p}points WINDOW w AS (ORDER BY threshold DESC)
),
{p}curve AS (
  SELECT threshold, tp / (tp + fp) AS prec, CASE WHEN p = 0 THEN 0 ELSE tp / p END AS rec,
         CASE WHEN n = 0 THEN 0 ELSE fp / n END AS fpr
  FROM {p}running
),
{p}steps AS (
  SELECT *, lag(rec, 1, 0) OVER w AS rec0, lag(fpr, 1, 0) OVER w AS fpr0, lag(prec, 1, prec) OVER w AS prec0
  FROM {p}curve WINDOW w AS (ORDER BY threshold DESC)
),
{p}areas AS (
  SELECT sum((fpr - fpr0) * (rec + rec0) / 2) AS area_under_roc, sum((rec - rec0) * (prec + prec0) / 2) AS area_under_pr
  FROM {p}steps
)
"""


def _f(beta_squared: str) -> str:
    return f"CASE WHEN prec + rec = 0 THEN 0 ELSE (1 + {beta_squared}) * prec * rec / ({beta_squared} * prec + rec) END"


# A weight is so many equal rows.
WEIGHTED = """
scored AS (
  SELECT (l_returnflag = 'R')::DOUBLE AS label, (l_discount > 0.05)::DOUBLE AS prediction, round(l_tax, 2) AS score
  FROM (SELECT *, unnest(range(CAST(l_quantity AS BIGINT))) FROM lineitem)
)
"""

DENSE = """
scored AS (
  SELECT (o_orderstatus = 'F')::DOUBLE AS label, o_totalprice AS score FROM orders {where}
)
"""


def curve(score: str = "score", label: str = "label", scored: str = SCORED) -> str:
    return _with(
        scored, _curve(score, label),
        select=f"""SELECT threshold, round(prec, 9) AS precision, round(rec, 9) AS recall,
                   round({_f("1.0::DOUBLE")}, 9) AS f1, round({_f("0.25::DOUBLE")}, 9) AS f05 FROM curve""",
    )


def areas(score: str = "score", label: str = "label", scored: str = SCORED) -> str:
    return _with(
        scored, _curve(score, label),
        select="SELECT round(area_under_roc, 9) AS area_under_roc, round(area_under_pr, 9) AS area_under_pr FROM areas",
    )


METRIC_NAMES = ["accuracy", "weighted_precision", "weighted_recall", "f1"]


def class_metrics(scored: str = SCORED) -> str:
    return _with(
        scored, CLASSES, CLASS_METRICS,
        select="SELECT " + ", ".join(f"round({n}, 9) AS {n}" for n in METRIC_NAMES) + " FROM class_metrics",
    )


def report() -> str:
    rows = [("class_metrics", n, n) for n in METRIC_NAMES]
    rows += [("hard_areas", "area_under_roc", "auc")]
    rows += [("areas", n, n) for n in ("area_under_roc", "area_under_pr")]
    select = " UNION ALL ".join(
        f"SELECT 'documents' AS model, 'all' AS split, '{name}' AS metric, CAST(round({column}, 9) AS DOUBLE) AS value FROM {table}"
        for table, column, name in rows
    )
    return _with(
        SCORED, CLASSES, CLASS_METRICS, _curve("score", "label"), _curve("prediction", "label", "hard_"), select=select
    )


DAY_TEXT = "strftime(day, '%Y-%m-%d') AS day"


def oracle_sql() -> dict[str, str]:
    log_columns = "user_id, item_id, cat_id, seller_id, brand_id, action_type"
    sql = {
        "scan_user_log": _with(STAR, select="SELECT * FROM user_log"),
        "scan_labels": _with(STAR, select="SELECT * FROM pair_list"),
        "scan_user_info": _with(STAR, select="SELECT * FROM user_info"),
        "date_normalize": _with(
            STAR,
            select=f"SELECT user_id, seller_id, item_id, time_stamp AS text, strftime({DAY}, '%Y-%m-%d') AS day FROM user_log",
        ),
        "filter_action": _with(STAR, select="SELECT * FROM user_log WHERE action_type = 2"),
        "filter_month": _on_log(f"SELECT {log_columns}, {DAY_TEXT} FROM dated WHERE month(dated.day) = 5"),
        "filter_before_cutoff": _on_log(
            f"SELECT {log_columns}, {DAY_TEXT}, '2014-11-11' AS cutoff FROM dated"
            " WHERE action_type = 2 AND dated.day < DATE '2014-11-11'"
        ),
        "fill_user_info": _with(STAR, PROFILE, select="SELECT * FROM profile"),
        "join_log_labels": _on_log(f"SELECT {log_columns}, {DAY_TEXT}, CAST(1 AS BIGINT) AS label_rows FROM l"),
        "purchase_history": _on_log(
            f"SELECT user_id, seller_id, item_id, cat_id, brand_id, {DAY_TEXT} FROM l WHERE action_type = 2 ORDER BY user_id, l.day"
        ),
        "user_action_totals": _on_log(f"SELECT user_id, {_counts('ttl_')} FROM l GROUP BY user_id"),
        **{
            f"user_distinct_{name}": _on_log(f"SELECT user_id, {_distinct(DIMS[prefix], prefix + '_')} FROM l GROUP BY user_id")
            for name, prefix in {"items": "dis", "sellers": "mer", "cats": "cat", "brands": "brand"}.items()
        },
        "user_active_days": _on_log(
            f"SELECT user_id, count(DISTINCT day) AS ttl_act_d, {_distinct('day', 'u_', '_d_cnt')} FROM l GROUP BY user_id"
        ),
        "span_actions": _on_log("SELECT user_id, avg_span_actions FROM user_counts", USER_BASE),
        "span_purchase": _on_log("SELECT user_id, avg_span_purchase FROM bought_span", USER_BASE),
        "span_pair": _on_log("SELECT user_id, seller_id, avg_span_act_um FROM pair_counts", PAIR_BASE),
        "last_purchase_span": _on_log("SELECT user_id, last_span FROM last_bought", USER_BASE),
        "fanout_ratio": _on_log("SELECT user_id, coalesce(u_p_m_ratio, 0) AS u_p_m_ratio FROM repeats", REPEATS),
        "join_full_outer": _on_log(
            "SELECT user_id, ttl_c, ttl_p, ttl_f FROM "
            + " FULL JOIN ".join(
                f"(SELECT user_id, count(*) AS ttl_{a} FROM l WHERE action_type = {code} GROUP BY user_id) q_{a}"
                + ("" if a == "c" else " USING (user_id)")
                for a, code in CODES.items()
            )
        ),
        "join_left_attach": _on_log(
            """SELECT user_id, seller_id, pair_actions, user_actions, seller_actions, age_range, gender
               FROM (SELECT user_id, seller_id, count(*) AS pair_actions FROM l GROUP BY user_id, seller_id)
               LEFT JOIN (SELECT user_id, count(*) AS user_actions FROM l GROUP BY user_id) USING (user_id)
               LEFT JOIN (SELECT seller_id, count(*) AS seller_actions FROM l GROUP BY seller_id) USING (seller_id)
               LEFT JOIN profile USING (user_id)""",
            PROFILE,
        ),
        "join_implicit_inner": _on_log(
            """SELECT t.user_id, t.seller_id, t.actions AS total_action_count, n.part AS u_m_c_cnt,
                      n.part / t.actions AS c_ratio
               FROM totals t, pairs_c n WHERE t.user_id = n.user_id AND t.seller_id = n.seller_id""",
            PAIR_BASE,
        ),
        "features_weighted": weighted(),
        "features_typed": full(EVENTS),
        "normalized_features": normalized(),
        "split_train_test": _with(
            STAR,
            select="""SELECT user_id, seller_id, label,
                CASE WHEN CAST('0x' || substr(md5(concat_ws('|', user_id, seller_id, 504)), 1, 8) AS UBIGINT) % 100 < 80
                     THEN 'train' ELSE 'test' END AS split FROM pair_list""",
        ),
        "split_rows": _with(
            STAR,
            select="""SELECT seller_id, action_type, count_if(h < 80)::BIGINT AS train_rows, count_if(h >= 80)::BIGINT AS test_rows FROM (
                SELECT *, CAST('0x' || substr(md5(concat_ws('|', seller_id, action_type, i, 504)), 1, 8) AS UBIGINT) % 100 AS h FROM (
                    SELECT seller_id, action_type, row_number() OVER (PARTITION BY seller_id, action_type) - 1 AS i FROM user_log))
                GROUP BY seller_id, action_type""",
        ),
        "rejected_days": _with(
            STAR,
            select="""SELECT * FROM (SELECT * REPLACE (
                CASE WHEN item_id % 11 = 0 THEN NULL WHEN item_id % 7 = 0 THEN substr(time_stamp, 1, 3) ELSE time_stamp END AS time_stamp)
                FROM user_log) WHERE item_id % 11 = 0 OR item_id % 7 = 0""",
        ),
        "features_corrected": corrected(),
        "metric_multiclass": class_metrics(),
        "metric_multiclass_weighted": class_metrics(WEIGHTED),
        "area_under_curves_weighted": areas(scored=WEIGHTED),
        "threshold_curve_dense": curve(scored=DENSE.format(where="")),
        "threshold_curve_nulls": curve(scored=DENSE.format(where="WHERE o_orderkey % 7 <> 0")),
        "area_under_curves_dense": areas(scored=DENSE.format(where="")),
        "metric_auc_hard": _with(
            SCORED, _curve("prediction", "label"), select="SELECT round(area_under_roc, 9) AS auc FROM areas"
        ),
        "threshold_curve": curve(),
        "threshold_curve_swapped": curve("label", "prediction"),
        "area_under_curves": areas(),
        "area_under_curves_swapped": areas("label", "prediction"),
        "eval_report": report(),
    }
    for suffix, base in (("", STAR), ("_events", EVENTS)):
        sql |= {
            f"user_features{suffix}": user(base),
            f"month_features{suffix}": month(base),
            f"seller_features{suffix}": seller(base),
            f"pair_features{suffix}": pair(base),
            f"features_full{suffix}": full(base),
            f"features_basic{suffix}": basic(base),
        }
    return sql
