"""Hand-made logs, one per rule of the feature tables."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from patronlens import FeatureConfig
from patronlens.operators import blocks
from patronlens.plans import basic_features, full_features, labelled_log
from patronlens.sources.adapters import inputs

CORRECTED = FeatureConfig(semantics="corrected")

# user, seller, item, cat, brand, day, action
LOG = [
    (1, 10, 100, 7, 5, "0511", 0),
    (1, 10, 100, 7, None, "0511", 2),
    (1, 10, 101, 7, None, "0521", 2),
    (1, 11, 102, 8, 6, "0601", 2),
    (1, 11, 102, 8, 6, "1112", 2),
    (1, 12, 103, 8, 6, "0701", 1),
    (2, 10, 100, 7, 5, "0601", 3),
    (2, 10, 100, 7, 5, "0603", 1),
    (3, 13, 100, 7, 5, "0601", 0),
]
LABELS = [(1, 10, 1), (1, 11, 0), (1, 12, 0), (2, 10, None), (9, 10, 1)]
INFO = [(1, None, None)]


def by_pair(df):
    rows = {}
    for r in df.collect():
        rows.setdefault((int(r.user_id), int(r.seller_id)), []).append(r)
    return rows


@pytest.fixture
def full(make):
    return by_pair(full_features(*make(LOG, LABELS, INFO)))


def test_rows_repeat_once_per_purchased_seller(full):
    assert {k: len(v) for k, v in full.items()} == {(1, 10): 2, (1, 11): 2, (1, 12): 2, (2, 10): 1}
    assert {r.u_p_m_ratio for r in full[1, 10]} == {1 / 3}
    assert full[2, 10][0].u_p_m_ratio == 0.0


def test_unlabelled_pairs_do_not_count(full):
    assert full[1, 10][0].c_u_cnt == 1.0  # user 3's click on another seller is not labelled
    assert (3, 13) not in full and (9, 10) not in full


def test_months_need_a_first_month_click(full):
    first, gated = full[1, 11][0], full[2, 10][0]
    assert (first.may_c_cnt, first.may_p_cnt, first.may_tt, first.jun_p_cnt, first.nov_tt) == (1, 2, 3, 1, 1)
    assert (gated.jun_f_cnt, gated.jun_tt) == (0, 0)


def test_action_total_needs_a_click(full):
    assert full[1, 10][0].total_action_count == 3
    assert full[1, 11][0].total_action_count == 0
    assert full[1, 11][0].p_ratio == 1.0


def test_pair_columns(full):
    r = full[1, 10][0]
    assert (r.u_m_c_cnt, r.u_m_p_cnt, r.u_m_p_i_cnt, r.u_m_r_cnt, r.u_m_f_cnt, r.um_act_d) == (1, 2, 2, 1, 0, 2)
    assert r.avg_span_act_um == 10 / 3
    assert full[1, 12][0].u_m_r_cnt == 0


def test_null_brands_are_not_counted(full):
    r = full[1, 10][0]
    assert (r.brand_c, r.brand_p, r.ttl_brand) == (1, 1, 1)


def test_spans(full):
    r = full[1, 10][0]
    assert r.avg_span_actions == 185 / 6
    assert r.avg_span_purchase == 185 / 4
    assert r.last_span == 163  # from 1 June: the November purchase is past the cutoff
    assert full[2, 10][0].last_span == 0


def test_profile_and_label_fills(full):
    assert (full[1, 10][0].age_range, full[1, 10][0].gender) == (0.0, 2.0)  # known, unknown values
    assert (full[2, 10][0].age_range, full[2, 10][0].gender) == (0.0, 0.0)  # not in the profile
    assert full[2, 10][0].label == 0.0  # an empty test label


def test_corrected_semantics(make):
    rows = by_pair(full_features(*make(LOG, LABELS, INFO), CORRECTED))
    assert {len(v) for v in rows.values()} == {1}
    r, other = rows[1, 11][0], rows[2, 10][0]
    assert r.u_p_m_ratio == 2 / 3
    assert r.total_action_count == 2
    assert (other.jun_f_cnt, other.jun_tt) == (1, 2)
    assert other.gender == 2.0


def test_corrected_blocks_may_see_the_whole_log(make):
    config = FeatureConfig(semantics="corrected", restrict_to_labels=False)
    log = [*LOG, (2, 14, 105, 9, 9, "0801", 0)]
    rows = by_pair(full_features(*make(log, LABELS, INFO), config))
    assert rows[2, 10][0].ttl_c == 1
    assert rows[2, 10][0].u_m_c_cnt == 0
    with pytest.raises(ValueError):
        FeatureConfig(restrict_to_labels=False)


def test_repeated_labels_count_twice_and_come_out_twice(make):
    labels = [*LABELS, (2, 10, None), (2, 10, 1)]
    rows = by_pair(full_features(*make(LOG, labels, INFO)))[2, 10]
    assert sorted(r.label for r in rows) == [0.0, 0.0, 1.0]
    assert {r.u_m_f_cnt for r in rows} == {3.0}
    assert {r.um_act_d for r in rows} == {2.0}


def test_weights_stand_for_repeats(make):
    data = make(LOG, [*LABELS, (2, 10, None)], INFO)
    weighted = full_features(*data, repeats="weight")
    repeated = full_features(*data)
    counted = repeated.groupBy(*repeated.columns).agg(F.count("*").alias("weight"))
    assert weighted.exceptAll(counted).count() == counted.exceptAll(weighted).count() == 0
    with pytest.raises(ValueError):
        full_features(*data, repeats="none")


def test_basic_table(make):
    df = basic_features(*make(LOG, LABELS, INFO))
    rows = by_pair(df)
    assert len(df.columns) == 64
    assert {len(v) for v in rows.values()} == {1}
    assert rows[1, 10][0].total_action_count == 0  # no favourite
    assert rows[2, 10][0].total_action_count == 2
    assert rows[2, 10][0].label is None
    assert (rows[1, 10][0].age_range, rows[1, 10][0].gender) == ("0", "2")
    assert (rows[2, 10][0].age_range, rows[2, 10][0].gender) == (None, None)


def test_bad_days_keep_their_actions(make):
    log = [*LOG, (2, 10, 100, 7, 5, "xx", 0)]
    r = by_pair(full_features(*make(log, LABELS, INFO)))[2, 10][0]
    assert (r.u_m_c_cnt, r.ttl_c, r.um_act_d) == (1, 1, 2)


def test_other_calendar(make):
    config = FeatureConfig(months=(6, 7))
    df = full_features(*make(LOG, LABELS, INFO), config)
    assert [c for c in df.columns if c.endswith("_tt")] == ["jun_tt", "jul_tt"]
    assert df.count() > 0


def test_empty_log(make):
    df = full_features(*make([], LABELS, INFO))
    assert df.count() == 0 and len(df.columns) == 76


@pytest.mark.parametrize("shape", ["star", "events"])
def test_invariants(spark, shape):
    log, labels, _ = inputs(spark, SMALL, shape)
    labelled = labelled_log(log, labels)
    pairs = blocks.pair_block(labelled).toPandas()
    users = blocks.user_block(labelled).toPandas()
    assert (pairs.c_ratio + pairs.p_ratio + pairs.f_ratio <= 1 + 1e-12).all()
    for action in "cpf":
        assert (users[f"mer_{action}"] <= users[f"ttl_{action}"]).all()
        assert pairs[f"u_m_{action}_cnt"].sum() == users[f"ttl_{action}"].sum()
    copies = users.set_index("user_id").copies
    expected = pairs.user_id.map(copies).sum()
    assert full_features(*inputs(spark, SMALL, shape)).count() == expected


def test_order_and_partitions_do_not_matter(spark, conf):
    log, labels, info = inputs(spark, SMALL, "events")
    plain = full_features(log, labels, info)
    conf({"spark.sql.shuffle.partitions": "3"})
    other = full_features(log.repartition(5, "item_id"), labels.repartition(2), info.coalesce(1))
    assert plain.exceptAll(other).count() == other.exceptAll(plain).count() == 0
