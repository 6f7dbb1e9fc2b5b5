"""Cross-operator invariants on the driver tables (survey section 5 (d))."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF001

Q = E.queries()


def q(spark, name):
    return Q[name](spark, SF001)


def test_topk_is_subset_of_counts(spark):
    top = q(spark, "k1_topn_items_sliding").select("window_end", "item_id", "cnt")
    counts = q(spark, "a5_window_count_sliding").select("window_end", "item_id", "cnt")
    assert top.exceptAll(counts).count() == 0
    # every window with counts has min(5, #items) ranked rows
    per = counts.groupBy("window_end").agg(F.least(F.count("*"), F.lit(5)).alias("k"))
    got = top.groupBy("window_end").agg(F.count("*").alias("k"))
    assert per.exceptAll(got).count() == 0


def test_cap_passes_plus_drops_is_input(spark):
    from eventide.plans import domain as dm

    total = dm.ad_click(spark, SF001).count()
    passed = q(spark, "b1_capped_clicks").count()
    from eventide.operators import capping

    every = capping.first_clicks(dm.raw_clicks(spark, SF001), ["user_id", "ad_id"], "ts", "seq", 1 << 30)
    dropped = every.filter(F.col("click_no") > 2).count()
    assert passed + dropped == total
    assert q(spark, "b2_black_list").count() <= dropped


def test_reconcile_outcomes_partition_rows(spark):
    from eventide.plans import domain as dm

    pays, receipts = dm.pays_and_receipts(spark, SF001)
    out = q(spark, "j1_tx_reconcile")
    left_seen = out.filter(F.col("pay_seq").isNotNull()).select("pay_seq").distinct().count()
    right_seen = out.filter(F.col("receipt_seq").isNotNull()).select("receipt_seq").distinct().count()
    assert left_seen == pays.count() and right_seen == receipts.count()
    singles = out.filter(F.col("outcome") == "single-order").select("pay_seq")
    matched = out.filter(F.col("outcome") == "match").select("pay_seq")
    assert singles.intersect(matched).count() == 0


def test_order_outcomes_partition_keys(spark):
    from eventide.plans import domain as dm

    keys = dm.order_events(spark, SF001).select("user_id", "week_start").distinct().count()
    out = q(spark, "j2_order_outcome")
    assert out.count() == keys == out.select("user_id", "week_start").distinct().count()


def test_salted_count_equals_plain_count(spark):
    salted = q(spark, "a11_pv_salted")
    plain = q(spark, "w3_tumbling_global")  # all events; restrict to page views below
    from eventide.operators.windows import window_aggregate
    from eventide.plans import domain as dm

    pv = window_aggregate(dm.pageviews(spark, SF001), [], "ts", "1 hour").withColumnRenamed("cnt", "pv")
    assert salted.exceptAll(pv).count() == 0 and pv.exceptAll(salted).count() == 0
    assert plain.agg(F.sum("cnt")).first()[0] == dm.events(spark, SF001).count()


def test_bloom_never_exceeds_exact(spark):
    exact = q(spark, "a9_uv_exact").withColumnRenamed("uv", "exact")
    bloom = q(spark, "a10_uv_bloom").withColumnRenamed("uv", "bloom")
    j = exact.join(bloom, ["window_start", "window_end"])
    assert j.count() == exact.count()
    assert j.filter(F.col("bloom") > F.col("exact")).count() == 0
    last = q(spark, "a10b_uv_bloom_changelog").groupBy("window_start").agg(F.max("uv").alias("bloom"))
    assert last.join(bloom.select("window_start", "bloom"), ["window_start", "bloom"]).count() == bloom.count()


def test_sessions_cover_every_event(spark):
    from eventide.plans import domain as dm

    assert q(spark, "w8_session_window").agg(F.sum("cnt")).first()[0] == dm.events(spark, SF001).count()
