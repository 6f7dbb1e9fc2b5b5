"""Streaming forms registered as ``<batch name>_stream``.

Each replays the whole driver table (derived by Spark) through a file stream
in arrival order, runs the streaming operator to completion into a Parquet
sink in the shared checkpoint folder, and reads the sink back.  They share the
batch query's oracle SQL: stream and batch must give the same rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators import capping, reconcile, transform
from eventide.plans import catalog as C
from eventide.plans import domain as dm
from eventide.session import scratch_path, sql_view
from eventide.sources.text import document_lines, stream_lines
from eventide.streaming import forms, stateful, tables
from eventide.streaming.replay import read_replay, run_to_parquet, write_replay

FAR = "2100-01-01 00:00:00"
# number of micro-batches a replay is cut into; results must not depend on it
# (except for the late-data forms, whose oracles model the batch watermark)
REPLAY_CHUNKS = 4


def _sentinel(df, **overrides):
    """One technical row far in the future under a reserved key: it moves the
    watermark past every real window so append-mode results flush."""
    cols = [overrides[c].alias(c) if c in overrides else F.col(c) for c in df.columns]
    return df.limit(1).select(*cols)


def _far():
    return F.lit(FAR).cast("timestamp_ntz")


def _replayed(spark, df, order_col, **sentinel):
    replay = write_replay(df, order_col, chunks=REPLAY_CHUNKS,
                          sentinel=_sentinel(df, **sentinel) if sentinel else None)
    return read_replay(spark, replay, df.schema)


def _register(name, fn):
    C.QUERIES[name + "_stream"] = fn
    if name in C.ORACLES:
        C.ORACLES[name + "_stream"] = C.ORACLES[name]


def s1_text_lines_stream(spark, sf):
    """Line stream over text files arriving in a folder."""
    replay = write_replay(C.encoded_lines(spark, sf), "doc_id", fmt="text", write_cols=["value"])
    return run_to_parquet(C.decoded_lines(stream_lines(spark, replay.folder, max_files_per_trigger=replay.files)))


def a5_window_count_sliding_stream(spark, sf):
    pv = dm.pageviews(spark, sf)
    s = _replayed(spark, pv, "seq", item_id=F.lit(-1).cast("bigint"), ts=_far())
    counts = forms.window_count_stream(forms.event_time(s, "ts", 0), ["item_id"], "1 hour", "5 minutes")
    return run_to_parquet(counts).filter(F.col("item_id") != -1)


def k1_topn_items_sliding_stream(spark, sf):
    pv = dm.pageviews(spark, sf)
    s = _replayed(spark, pv, "seq", item_id=F.lit(-1).cast("bigint"), ts=_far())
    top = forms.topn_stream(forms.event_time(s, "ts", 0), "item_id", "1 hour", "5 minutes", 5)
    return run_to_parquet(top).filter(F.col("window_end") < _far())


def a9_uv_exact_stream(spark, sf):
    pv = dm.pageviews(spark, sf)
    s = _replayed(spark, pv, "seq", ts=_far())
    uv = forms.distinct_count_stream(forms.event_time(s, "ts", 0), "user_id", "1 hour")
    return run_to_parquet(uv).filter(F.col("window_end") < _far())


def j1_tx_reconcile_stream(spark, sf):
    pays, receipts = dm.pays_and_receipts(spark, sf)
    p = _replayed(spark, pays, "pay_seq", tx_id=F.lit(-1).cast("bigint"), pay_ts=_far())
    r = _replayed(spark, receipts, "receipt_seq", tx_id=F.lit(-1).cast("bigint"), receipt_ts=_far())
    out = stateful.reconcile_stream(
        forms.event_time(p, "pay_ts", 0), forms.event_time(r, "receipt_ts", 0), "tx_id", within_seconds=6 * 3600,
        lts="pay_ts", rts="receipt_ts", lseq="pay_seq", rseq="receipt_seq",
        tags=(reconcile.MATCH, reconcile.SINGLE_ORDER, reconcile.SINGLE_RECEIPT))
    return run_to_parquet(out).filter(F.col("tx_id") != -1)


def q6_temp_jump_stream(spark, sf):
    s = _replayed(spark, dm.sensor(spark, sf), "seq")
    return run_to_parquet(stateful.jumps_stream(s, 10.0))


def q5_order_pay_timeout_stream(spark, sf):
    o = dm.order_events(spark, sf).withColumn("is_start", F.col("event_type") == "create")
    s = _replayed(spark, o, "seq", user_id=F.lit(-1).cast("bigint"), ts=_far())
    out = stateful.followed_by_stream(forms.event_time(s, "ts", 0), 86400)
    return run_to_parquet(out).filter(F.col("user_id") != -1)


def q1_login_fail_check_stream(spark, sf):
    lg = dm.login(spark, sf).withColumn("fail", F.col("event_type") == "fail")
    s = _replayed(spark, lg, "seq", user_id=F.lit(-1).cast("bigint"), ts=_far())
    out = stateful.repeated_failures_stream(forms.event_time(s, "ts", 0), 2, 6 * 3600)
    return run_to_parquet(out).filter(F.col("user_id") != -1)


def _first_clicks(spark, sf, limit):
    """Ad clicks replayed through the per-day cap; the nation of a click is looked up after it."""
    s = _replayed(spark, dm.raw_clicks(spark, sf), "seq")
    passed = tables.first_clicks_stream(s, scratch_path(spark, "b1"), scratch_path(spark, "b1-ckpt"), ["user_id", "ad_id"], "ts", "seq", limit)
    return dm.with_province(spark, sf, passed)


def b1_capped_clicks_stream(spark, sf):
    return _first_clicks(spark, sf, 2).select("user_id", "ad_id", "province", "day", "seq", "ts", "click_no")


def f5_expr_select_filter_stream(spark, sf):
    """A SQL view over a stream, emitted as an append stream."""
    s = _replayed(spark, dm.sensor(spark, sf), "seq")
    with sql_view(s, "sensor_stream") as view:
        selected = spark.sql(f"SELECT id, ts_sec AS timestamp FROM {view} WHERE id = 'sensor_1'")
    return run_to_parquet(selected)


for _name, _fn in [("s1_text_lines", s1_text_lines_stream), ("a5_window_count_sliding", a5_window_count_sliding_stream),
                   ("k1_topn_items_sliding", k1_topn_items_sliding_stream), ("a9_uv_exact", a9_uv_exact_stream),
                   ("j1_tx_reconcile", j1_tx_reconcile_stream), ("q6_temp_jump", q6_temp_jump_stream),
                   ("q5_order_pay_timeout", q5_order_pay_timeout_stream),
                   ("q1_login_fail_check", q1_login_fail_check_stream),
                   ("b1_capped_clicks", b1_capped_clicks_stream), ("f5_expr_select_filter", f5_expr_select_filter_stream)]:
    _register(_name, _fn)


# ------------------------------------------------------------------ more forms
from pyspark.sql import types as T  # noqa: E402

from eventide.functions.hashing import bloom_offset  # noqa: E402
from eventide.operators import aggregate as agg  # noqa: E402
from eventide.sinks import files as sink_files  # noqa: E402
from eventide.streaming import generic  # noqa: E402


def _us(c):
    return F.unix_micros(F.col(c).cast("timestamp"))


def _ts(c):
    return F.timestamp_micros(F.col(c)).cast("timestamp_ntz")


def a3_rolling_min_by_stream(spark, sf):
    s = _replayed(spark, dm.sensor(spark, sf).select("id", "seq", "temperature", _us("ts").alias("ts_us")), "seq")
    schema = T.StructType([T.StructField("seq", T.LongType()), T.StructField("id", T.StringType()),
                           T.StructField("m_temperature", T.DoubleType()), T.StructField("m_ts_us", T.LongType()),
                           T.StructField("m_seq", T.LongType())])
    out = generic.running_stream(s, ["id"], ["ts_us", "seq"], [("m", "min_by", "temperature", ["ts_us", "seq"])], schema)
    return run_to_parquet(out).select("seq", "id", F.col("m_temperature").alias("min_temperature"),
                                      _ts("m_ts_us").alias("min_ts"), F.col("m_seq").alias("min_seq"))


def a4_rolling_reduce_stream(spark, sf):
    s = _replayed(spark, dm.sensor(spark, sf).select("id", "seq", "ts_sec", "temperature", _us("ts").alias("ts_us")), "seq")
    schema = T.StructType([T.StructField("seq", T.LongType()), T.StructField("id", T.StringType()),
                           T.StructField("ts_sec", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("red_value", T.DoubleType())])
    out = generic.running_stream(s, ["id"], ["ts_us", "seq"], [("n", "count", "seq"), ("red_value", "min", "temperature")],
                                 schema)
    res = run_to_parquet(out)
    return res.select("seq", "id", (F.col("ts_sec") + F.when(F.col("n") > 1, 1).otherwise(0)).alias("red_ts"), "red_value")


def q2_login_fail_pair_stream(spark, sf):
    lg = dm.login(spark, sf).select("user_id", "seq", (F.col("event_type") == "fail").alias("fail"), "ts",
                                    _us("ts").alias("ts_us"))
    s = _replayed(spark, lg, "seq")
    out = generic.lag_stream(s, ["user_id"], ["seq"], {"pf": ("fail", 1), "pts_us": ("ts_us", 1)},
                             {"pf": T.BooleanType(), "pts_us": T.LongType()})
    res = run_to_parquet(out)
    return (res.filter(F.col("fail") & F.coalesce(F.col("pf"), F.lit(False))
                       & (F.col("ts_us") <= F.col("pts_us") + 6 * 3600 * 1_000_000))
            .select("user_id", _ts("pts_us").alias("first_fail_ts"), F.col("ts").alias("fail_ts")))


def q3_login_fail_cep_stream(spark, sf):
    lg = dm.login(spark, sf).select("user_id", "seq", (F.col("event_type") == "fail").alias("fail"), "ts",
                                    _us("ts").alias("ts_us"))
    s = _replayed(spark, lg, "seq")
    lags = {"f1": ("fail", 1), "f2": ("fail", 2), "t1": ("ts_us", 1), "t2": ("ts_us", 2)}
    out = generic.lag_stream(s, ["user_id"], ["ts_us", "seq"], lags,
                             {"f1": T.BooleanType(), "f2": T.BooleanType(), "t1": T.LongType(), "t2": T.LongType()})
    res = run_to_parquet(out)
    ok = (F.col("fail") & F.coalesce(F.col("f1"), F.lit(False)) & F.coalesce(F.col("f2"), F.lit(False))
          & (F.col("ts_us") < F.col("t2") + 86400 * 1_000_000))
    return res.filter(ok).select("user_id", _ts("t2").alias("first_ts"), _ts("t1").alias("second_ts"),
                                 F.col("ts").alias("third_ts"))


def w8_session_window_stream(spark, sf):
    e = dm.events(spark, sf).select("user_id", "ts", "event_id")
    s = _replayed(spark, e, "event_id", user_id=F.lit(-1).cast("bigint"), ts=_far())
    g = forms.event_time(s, "ts", 0).groupBy("user_id", F.session_window("ets", "1 hour").alias("w"))
    out = g.agg(F.count(F.lit(1)).alias("cnt")).select(
        "user_id", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), "cnt")
    return run_to_parquet(out).filter(F.col("user_id") != -1)


def a11_pv_salted_stream(spark, sf):
    s = _replayed(spark, dm.pageviews(spark, sf), "seq", ts=_far())
    x = forms.event_time(s, "ts", 0).withColumn("_salt", F.pmod(F.xxhash64("seq"), F.lit(16)))
    phase1 = (x.groupBy(F.window("ets", "1 hour").alias("w"), "_salt").agg(F.count(F.lit(1)).alias("count"))
              .select(F.window_time("w").alias("wt"), F.col("w.start").alias("ws"), F.col("w.end").alias("we"), "count"))
    out = phase1.groupBy("wt", "ws", "we").agg(F.sum("count").alias("pv")).select(
        F.col("ws").cast("timestamp_ntz").alias("window_start"), F.col("we").cast("timestamp_ntz").alias("window_end"), "pv")
    return run_to_parquet(out).filter(F.col("window_end") < _far())


def a10_uv_bloom_stream(spark, sf):
    pv = dm.pageviews(spark, sf).withColumn("offset", bloom_offset("user_id"))
    s = _replayed(spark, pv, "seq", ts=_far())
    uv = forms.distinct_count_stream(forms.event_time(s, "ts", 0), "offset", "1 hour")
    return run_to_parquet(uv).filter(F.col("window_end") < _far())


def w1_tumbling_keyed_stream(spark, sf):
    s = _replayed(spark, dm.sensor(spark, sf), "seq", id=F.lit("~sentinel"), ts=_far())
    g = forms.event_time(s, "ts", 0).groupBy("id", F.window("ets", "1 hour").alias("w"))
    out = g.agg(F.count(F.lit(1)).alias("cnt"), F.min("temperature").alias("min_temp")).select(
        "id", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), "cnt", "min_temp")
    return run_to_parquet(out).filter(F.col("id") != "~sentinel")


def j2_order_outcome_stream(spark, sf):
    o = dm.order_events(spark, sf).withColumn("is_create", F.col("event_type") == "create")
    s = _replayed(spark, o, "seq", user_id=F.lit(-1).cast("bigint"), ts=_far(), week_start=_far())
    out = stateful.order_outcomes_stream(forms.event_time(s, "ts", 0), 86400)
    return run_to_parquet(out).filter(F.col("user_id") != -1)


def s8_rolling_file_sink_stream(spark, sf):
    s = _replayed(spark, dm.sensor(spark, sf).select("id", "ts_sec", "temperature", "ts", "seq"), "seq")
    path, ckpt = scratch_path(spark, "s8-stream"), scratch_path(spark, "s8-stream-ckpt")
    q = sink_files.stream_rolling_files(s.select("id", "ts_sec", "temperature", "ts"), path, ckpt, "ts")
    q.awaitTermination()
    back = spark.read.schema("id string, ts_sec bigint, temperature double, ts timestamp_ntz, bucket string").csv(path)
    return back.select("id", "ts_sec", "temperature", "bucket")


def s10_latest_by_key_stream(spark, sf):
    """S10 on a stream: every micro-batch merged into a keyed table."""
    s = _replayed(spark, dm.sensor(spark, sf), "seq")
    table = tables.upsert_stream(s, scratch_path(spark, "s10-table"), scratch_path(spark, "s10-ckpt"), ["id"],
                                 ["temperature", "ts_sec"], ["ts", "seq"])
    return table.read().select("id", "temperature", "ts_sec")


def a2_word_count_update_stream(spark, sf):
    """A2 on a stream of lines, cut into words by the stream: running word totals in update mode, each micro-batch's
    changed totals upserted into a keyed table; the table ends as the word
    count without empty tokens."""
    s = _replayed(spark, document_lines(dm.load_table(spark, sf, "documents")).select("doc_id", "line"), "doc_id")
    counts = agg.tokens(s, drop_empty=True).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    table = tables.upsert_stream(counts, scratch_path(spark, "a2-table"), scratch_path(spark, "a2-ckpt"), ["word"], ["cnt"],
                                 output_mode="update")
    return table.read().select("word", "cnt")


for _name, _fn in [("a3_rolling_min_by", a3_rolling_min_by_stream), ("a4_rolling_reduce", a4_rolling_reduce_stream),
                   ("q2_login_fail_pair", q2_login_fail_pair_stream), ("q3_login_fail_cep", q3_login_fail_cep_stream),
                   ("w8_session_window", w8_session_window_stream), ("a11_pv_salted", a11_pv_salted_stream),
                   ("a10_uv_bloom", a10_uv_bloom_stream), ("w1_tumbling_keyed", w1_tumbling_keyed_stream),
                   ("j2_order_outcome", j2_order_outcome_stream), ("s8_rolling_file_sink", s8_rolling_file_sink_stream),
                   ("s10_latest_by_key", s10_latest_by_key_stream)]:
    _register(_name, _fn)

C.QUERIES["a2_word_count_update_stream"] = a2_word_count_update_stream
C.ORACLES["a2_word_count_update_stream"] = f"SELECT word, count(*) AS cnt FROM ({C.TOKENS_SQL}) WHERE length(word) > 0 GROUP BY word"


# ------------------------------------------------------ count windows, R5, Q4, B2
def w5_count_window_sliding_stream(spark, sf):
    s = _replayed(spark, dm.sensor(spark, sf).select("id", "seq", "temperature", _us("ts").alias("ts_us")), "seq")
    out = generic.count_window_stream(s, "id", ["ts_us", "seq"], "temperature", 100, 10)
    return run_to_parquet(out).select("id", "end_pos", "cnt", F.col("max_value").alias("max_temp"),
                                      F.col("min_value").alias("min_temp"))


def w6_count_window_tumbling_stream(spark, sf):
    s = _replayed(spark, dm.sensor(spark, sf).select("id", "seq", "temperature", _us("ts").alias("ts_us")), "seq")
    out = generic.count_window_stream(s, "id", ["ts_us", "seq"], "temperature", 100)
    return run_to_parquet(out).select("id", "end_pos", "cnt", F.col("max_value").alias("max_temp"))


def q4_order_pay_followed_by_stream(spark, sf):
    res = q5_order_pay_timeout_stream(spark, sf)
    return res.filter(F.col("outcome") == "paid").drop("timeout_at")


def b2_black_list_stream(spark, sf):
    return (_first_clicks(spark, sf, 3).filter(F.col("click_no") == 3)
            .select("user_id", "ad_id", "day", F.lit(f"{capping.BLACK_LIST_PREFIX}2{capping.BLACK_LIST_SUFFIX}").alias("warning")))


def r5_retract_topn_stream(spark, sf):
    """The top-N table as a retract stream; returned is the net of its change log, the final table (the log
    itself is held against every batch's table in the tests)."""
    pv = dm.pageviews(spark, sf)
    s = _replayed(spark, pv, "seq", item_id=F.lit(-1).cast("bigint"), ts=_far())
    counts = forms.window_count_stream(forms.event_time(s, "ts", 0), ["item_id"], "1 hour", "5 minutes") \
        .select("window_end", "item_id", "cnt").filter(F.col("item_id") != -1)
    changelog = tables.retract_topn_stream(counts, scratch_path(spark, "r5"), scratch_path(spark, "r5-ckpt"), "window_end", "item_id", 5)
    net = changelog.groupBy("window_end", "item_id", "cnt", "rank").agg(
        F.sum(F.when(F.col("flag"), 1).otherwise(-1)).alias("_net"))
    return net.filter(F.col("_net") == 1).drop("_net")


for _name, _fn in [("w5_count_window_sliding", w5_count_window_sliding_stream),
                   ("w6_count_window_tumbling", w6_count_window_tumbling_stream),
                   ("q4_order_pay_followed_by", q4_order_pay_followed_by_stream),
                   ("b2_black_list", b2_black_list_stream)]:
    _register(_name, _fn)

C.QUERIES["r5_retract_topn_stream"] = r5_retract_topn_stream
C.ORACLES["r5_retract_topn_stream"] = C.TOPN_SQL


# ------------------------------------------------ Q7 and generic window streams
def q7_temp_rising_stream(spark, sf):
    s = _replayed(spark, dm.sensor(spark, sf).select("id", "ts", "seq", F.col("temperature").alias("value")), "seq",
                  id=F.lit("~sentinel"), ts=_far())
    out = stateful.rising_alerts_stream(forms.event_time(s, "ts", 0), 3600)
    return run_to_parquet(out).filter(F.col("id") != "~sentinel")


def _sensor_stream(spark, sf):
    s = _replayed(spark, dm.sensor(spark, sf), "seq", id=F.lit("~sentinel"), ts=_far())
    return forms.event_time(s, "ts", 0)


def w2_sliding_keyed_stream(spark, sf):
    out = forms.window_agg_stream(_sensor_stream(spark, sf), ["id"], "1 hour", "5 minutes",
                                  aggs=[F.count(F.lit(1)).alias("cnt"), F.max("temperature").alias("max_temp")])
    return run_to_parquet(out).filter(F.col("id") != "~sentinel")


def a7_window_max_reduce_stream(spark, sf):
    out = forms.window_agg_stream(_sensor_stream(spark, sf), ["id"], "1 hour", aggs=[
        F.max("temperature").alias("max_value"), F.count(F.lit(1)).alias("n"),
        F.max_by(F.col("ts_sec"), F.col("seq")).alias("_last")])
    res = run_to_parquet(out).filter(F.col("id") != "~sentinel")
    return res.select("id", "window_start", "window_end", "max_value", "n",
                      (F.col("_last") + F.when(F.col("n") > 1, 1).otherwise(0)).alias("red_ts"))


def w9_tumbling_offset_stream(spark, sf):
    e = dm.events(spark, sf).select("event_id", "ts")
    s = _replayed(spark, e, "event_id", ts=_far())
    out = forms.window_agg_stream(forms.event_time(s, "ts", 0), [], "1 hour", "1 hour", "10 minutes",
                                  aggs=[F.count(F.lit(1)).alias("cnt")])
    return run_to_parquet(out).filter(F.col("window_end") < _far())


def a8_full_window_count_stream(spark, sf):
    m = transform.not_equal_filter(dm.marketing(spark, sf), "behavior", "signup")
    s = _replayed(spark, m, "seq", channel=F.lit("~sentinel"), ts=_far())
    out = forms.window_agg_stream(forms.event_time(s, "ts", 0), ["channel", "behavior"], "1 hour", "5 minutes",
                                  aggs=[F.count(F.lit(1)).alias("cnt")])
    return run_to_parquet(out).filter(F.col("channel") != "~sentinel")


for _name, _fn in [("q7_temp_rising", q7_temp_rising_stream), ("w2_sliding_keyed", w2_sliding_keyed_stream),
                   ("a7_window_max_reduce", a7_window_max_reduce_stream), ("w9_tumbling_offset", w9_tumbling_offset_stream),
                   ("a8_full_window_count", a8_full_window_count_stream)]:
    _register(_name, _fn)


# ------------------------------------------- late data with micro-batch watermarks
from eventide.operators import late as late_ops  # noqa: E402


def chunk_watermark_sql(src: str, delay_s: int, chunks: int = 4, lag_batches: int = 1) -> str:
    """The watermark each replayed row meets in a stream: max event time of
    the micro-batches (= replay chunks of the arrival order) at least
    ``lag_batches`` before it, minus the delay.  A driver-held watermark
    (foreachBatch) lags one batch; Spark's stateful operators filter late rows
    with the previous batch's eviction watermark, i.e. two batches back."""
    return f"""WITH s AS ({src}), b AS (SELECT min(arrival) AS lo, max(arrival) AS hi FROM s),
  c AS (SELECT s.*, (arrival - lo) // ((hi - lo) // {chunks} + 1) AS chunk FROM s, b),
  cm AS (SELECT chunk, max(ts) AS mx FROM c GROUP BY chunk)
SELECT c.*, (SELECT max(mx) FROM cm WHERE cm.chunk <= c.chunk - {lag_batches}) - INTERVAL {delay_s} SECOND AS wm FROM c"""


EVENTS_ARRIVAL_SQL = f"SELECT event_id, ts, {dm.ARRIVAL_SQL} AS arrival FROM events"


def l4_late_routing_stream(spark, sf):
    """L4 on a stream: every micro-batch is routed against the watermark that the
    batches before it left, then the watermark advances."""
    e = dm.events(spark, sf).select("event_id", "ts", dm._arrival())
    s = _replayed(spark, e, "arrival")
    routed = tables.route_late_stream(s, scratch_path(spark, "l4"), scratch_path(spark, "l4-ckpt"), "ts", "1 hour", delay_seconds=3600)
    return routed.select("event_id", "ts", "wm", "channel")


def k3_topn_pages_late_stream(spark, sf):
    """K3 on a stream: update-mode window counts with watermark delay =
    disorder (3 s) + allowed lateness (60 s), so late rows still correct their
    windows until the watermark passes end + lateness; corrected counts are
    upserted per micro-batch, the final table is ranked."""
    from eventide.operators import topk

    get = transform.equal_filter(dm.weblog(spark, sf, get_only=True), "method", "GET").select("url", "ts", "seq", "arrival")
    s = _replayed(spark, get, "arrival", url=F.lit("~sentinel"), ts=_far())
    counts = forms.window_count_stream(forms.event_time(s, "ts", 63), ["url"], "1 hour", "5 minutes") \
        .select("url", "window_end", "cnt")
    table = tables.upsert_stream(counts, scratch_path(spark, "k3-table"), scratch_path(spark, "k3-ckpt"), ["url", "window_end"], ["cnt"],
                                 output_mode="update")
    final = table.read().filter(F.col("url") != "~sentinel")
    ranked = topk.top_n(final, ["window_end"], [F.col("cnt").desc(), F.col("url")], 5)
    return ranked.select("window_end", "url", "cnt", "rank")


C.QUERIES["l4_late_routing_stream"] = l4_late_routing_stream
C.ORACLES["l4_late_routing_stream"] = f"""SELECT event_id, ts, wm, CASE WHEN wm IS NOT NULL AND wm >= window_end
  THEN 'late' ELSE 'on_time' END AS channel FROM ({C.win_sql(chunk_watermark_sql(EVENTS_ARRIVAL_SQL, 3600), 3600)})"""

C.QUERIES["k3_topn_pages_late_stream"] = k3_topn_pages_late_stream
C.ORACLES["k3_topn_pages_late_stream"] = dm.with_ctes(f"""SELECT window_end, url, cnt, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS rank FROM (
    SELECT url, window_end, count(*) AS cnt FROM ({C.win_sql(chunk_watermark_sql(
        "SELECT url, ts, seq, arrival FROM web WHERE method = 'GET'", 63, lag_batches=2), 3600, 300)})
    WHERE wm IS NULL OR wm < window_end GROUP BY ALL)) WHERE rank <= 5""", "web")


# ----------------------------------------------------- SQL on a stream, A6, W3, Q3b
def a12_sql_window_count_stream(spark, sf):
    """A12 / R3 on a stream: the same SQL text over a streaming temp view."""
    s = _replayed(spark, dm.pageviews(spark, sf), "seq", item_id=F.lit(-1).cast("bigint"), ts=_far())
    with sql_view(forms.event_time(s, "ts", 0), "user_behavior_stream") as view:
        out = spark.sql(f"""SELECT item_id, CAST(window.end AS TIMESTAMP_NTZ) AS window_end, count(*) AS cnt
            FROM {view} WHERE behavior = 'pv' GROUP BY item_id, window(ets, '1 hour', '5 minutes')""")
    return run_to_parquet(out).filter(F.col("item_id") != -1)


def a6_window_avg_stream(spark, sf):
    out = forms.window_agg_stream(_sensor_stream(spark, sf), ["id"], "1 hour", aggs=[
        F.count("temperature").alias("n"), F.sum("temperature").alias("_s")])
    res = run_to_parquet(out).filter(F.col("id") != "~sentinel")
    return res.select("id", "window_start", "window_end", "n", F.round(F.col("_s") / F.col("n"), 4).alias("avg_value"))


def w3_tumbling_global_stream(spark, sf):
    e = dm.events(spark, sf).select("event_id", "ts")
    s = _replayed(spark, e, "event_id", ts=_far())
    out = forms.window_agg_stream(forms.event_time(s, "ts", 0), [], "1 hour", aggs=[F.count(F.lit(1)).alias("cnt")])
    return run_to_parquet(out).filter(F.col("window_end") < _far())


def q3b_login_fail_named_steps_stream(spark, sf):
    res = q3_login_fail_cep_stream(spark, sf)
    return res.select("user_id", F.col("first_ts").alias("begin_ts"), F.col("second_ts").alias("next_ts"),
                      F.col("third_ts").alias("next2_ts"))


for _name, _fn in [("a12_sql_window_count", a12_sql_window_count_stream), ("a6_window_avg", a6_window_avg_stream),
                   ("w3_tumbling_global", w3_tumbling_global_stream),
                   ("q3b_login_fail_named_steps", q3b_login_fail_named_steps_stream)]:
    _register(_name, _fn)


# ------------------------------------- arrival disorder (L2), B3, W4, L3
# the replays' arrival order strays up to DISORDER_SPAN ids from event order; the delay covers that at every scale factor
DISORDER_DELAY = 4 * 86400


def _disordered(spark, sf, entity, **sentinel):
    """An entity replayed in ``arrival`` order, its watermark that far behind."""
    e = dm.events(spark, sf).select(F.col("event_id").alias("_eid"), dm._arrival())
    df = entity.join(e, F.col("seq") == F.col("_eid")).drop("_eid")
    s = _replayed(spark, df, "arrival", ts=_far(), **sentinel)
    s = forms.event_time(s, "ts", DISORDER_DELAY)
    return s.select(*[c for c in entity.columns if c != "ts"], _us("ts").alias("ts_us"), "ets")


def a3_rolling_min_by_disorder_stream(spark, sf):
    """A3 on rows that arrive out of order: held until the watermark has passed them, then taken in event time."""
    s = _disordered(spark, sf, dm.sensor(spark, sf).select("id", "seq", "temperature", "ts"), id=F.lit("~sentinel"))
    schema = T.StructType([T.StructField("seq", T.LongType()), T.StructField("id", T.StringType()),
                           T.StructField("m_temperature", T.DoubleType()), T.StructField("m_ts_us", T.LongType()),
                           T.StructField("m_seq", T.LongType())])
    out = generic.running_stream(s, ["id"], ["ts_us", "seq"], [("m", "min_by", "temperature", ["ts_us", "seq"])], schema,
                                 in_order="ts_us")
    return run_to_parquet(out).filter(F.col("id") != "~sentinel").select(
        "seq", "id", F.col("m_temperature").alias("min_temperature"), _ts("m_ts_us").alias("min_ts"), F.col("m_seq").alias("min_seq"))


def q3_login_fail_cep_disorder_stream(spark, sf):
    """Q3 on rows that arrive out of order."""
    lg = dm.login(spark, sf).select("user_id", "seq", (F.col("event_type") == "fail").alias("fail"), "ts")
    s = _disordered(spark, sf, lg, user_id=F.lit(-1).cast("bigint"))
    lags = {"f1": ("fail", 1), "f2": ("fail", 2), "t1": ("ts_us", 1), "t2": ("ts_us", 2)}
    out = generic.lag_stream(s, ["user_id"], ["ts_us", "seq"], lags,
                             {"f1": T.BooleanType(), "f2": T.BooleanType(), "t1": T.LongType(), "t2": T.LongType()}, in_order="ts_us")
    res = run_to_parquet(out).filter(F.col("user_id") != -1)
    ok = (F.col("fail") & F.coalesce(F.col("f1"), F.lit(False)) & F.coalesce(F.col("f2"), F.lit(False))
          & (F.col("ts_us") < F.col("t2") + 86400 * 1_000_000))
    return res.filter(ok).select("user_id", _ts("t2").alias("first_ts"), _ts("t1").alias("second_ts"), _ts("ts_us").alias("third_ts"))


def w5_count_window_sliding_disorder_stream(spark, sf):
    """W5 on rows that arrive out of order: windows count rows in event time."""
    s = _disordered(spark, sf, dm.sensor(spark, sf).select("id", "seq", "temperature", "ts"), id=F.lit("~sentinel"))
    out = generic.count_window_stream(s, "id", ["ts_us", "seq"], "temperature", 100, 10, in_order="ts_us")
    return run_to_parquet(out).filter(F.col("id") != "~sentinel").select(
        "id", "end_pos", "cnt", F.col("max_value").alias("max_temp"), F.col("min_value").alias("min_temp"))


def b3_province_counts_stream(spark, sf):
    """B3 as the whole streaming job: clicks are capped per day by one query, whose output is the source of a second
    that counts them by province and sliding window."""
    passed = _first_clicks(spark, sf, 2).select("province", "ts", "seq")
    s2 = _replayed(spark, passed, "seq", ts=_far(), province=F.lit("~sentinel"))
    counts = forms.window_count_stream(forms.event_time(s2, "ts", 0), ["province"], "1 hour", "5 minutes")
    return run_to_parquet(counts).filter(F.col("province") != "~sentinel")


def w4_sliding_global_stream(spark, sf):
    s = _replayed(spark, dm.events(spark, sf).select("event_id", "ts"), "event_id", ts=_far())
    counts = forms.window_count_stream(forms.event_time(s, "ts", 0), [], "10 minutes", "2 minutes")
    return run_to_parquet(counts).filter(F.col("window_end") < _far())


def l3_allowed_lateness_counts_stream(spark, sf):
    """L3 on a stream: window counts in update mode, a window corrected by late rows until the watermark passes its end
    plus the lateness; the corrections are upserted."""
    e = dm.events(spark, sf).select("event_id", "ts", dm._arrival())
    s = _replayed(spark, e, "arrival")
    counts = forms.window_count_stream(forms.event_time(s, "ts", 3600 + 600), [], "1 hour")
    table = tables.upsert_stream(counts, scratch_path(spark, "l3-table"), scratch_path(spark, "l3-ckpt"), ["window_start", "window_end"],
                                 ["cnt"], output_mode="update")
    return table.read().select("window_start", "window_end", "cnt")


C.QUERIES["l3_allowed_lateness_counts_stream"] = l3_allowed_lateness_counts_stream
C.ORACLES["l3_allowed_lateness_counts_stream"] = f"""SELECT window_start, window_end, count(*) AS cnt FROM ({C.win_sql(
    chunk_watermark_sql(EVENTS_ARRIVAL_SQL, 4200, lag_batches=2), 3600)}) WHERE wm IS NULL OR wm < window_end GROUP BY ALL"""

for _base, _name, _fn in [("a3_rolling_min_by", "a3_rolling_min_by_disorder_stream", a3_rolling_min_by_disorder_stream),
                          ("q3_login_fail_cep", "q3_login_fail_cep_disorder_stream", q3_login_fail_cep_disorder_stream),
                          ("w5_count_window_sliding", "w5_count_window_sliding_disorder_stream", w5_count_window_sliding_disorder_stream),
                          ("b3_province_counts", "b3_province_counts_stream", b3_province_counts_stream),
                          ("w4_sliding_global", "w4_sliding_global_stream", w4_sliding_global_stream)]:
    C.QUERIES[_name] = _fn
    C.ORACLES[_name] = C.ORACLES[_base]


# ------------------------------------- map state and timers (L5, L7, L8), sketches
def k3_topn_pages_timers_stream(spark, sf):
    """K3 by map state per window: reports when a window's end is passed, corrections until its lateness is over, then cleared."""
    get = transform.equal_filter(dm.weblog(spark, sf, get_only=True), "method", "GET").select("url", "ts", "seq", "arrival")
    s = _replayed(spark, get, "arrival", url=F.lit("~sentinel"), ts=_far())
    reports = run_to_parquet(stateful.page_ranking_stream(s, "1 hour", "5 minutes", 5, delay_seconds=3, lateness_seconds=60))
    return stateful.last_ranking(reports.filter(F.col("url") != "~sentinel"), 5).select("window_end", "url", "cnt", "rank")


def a10b_uv_bloom_changelog_stream(spark, sf):
    """A10 fired on every element of a stream."""
    s = _replayed(spark, dm.pageviews(spark, sf), "seq", user_id=F.lit(-1).cast("bigint"), ts=_far())
    out = run_to_parquet(stateful.bloom_changelog_stream(forms.event_time(s, "ts", 0), "ts", "1 hour", "user_id", "seq"))
    return out.filter(F.col("window_start") < _far())


def a9h_uv_sketch_sliding_stream(spark, sf):
    """Sketches per sliding window on a stream, held against exact counts of the whole table."""
    pv = dm.pageviews(spark, sf)
    s = _replayed(spark, pv, "seq", ts=_far())
    out = run_to_parquet(forms.window_agg_stream(forms.event_time(s, "ts", 0), [], "1 hour", "5 minutes",
                                                 aggs=[F.hll_sketch_estimate(F.hll_sketch_agg("user_id", F.lit(12))).alias("uv_estimate")]))
    pairs = C.window_aggregate(pv, ["user_id"], "ts", "1 hour", "5 minutes")
    exact = pairs.groupBy("window_start", "window_end").agg(F.count(F.lit(1)).alias("uv"))
    return (exact.join(out, ["window_start", "window_end"], "left")
            .select("window_start", "window_end", "uv", F.coalesce(C.near("uv_estimate", "uv"), F.lit(False)).alias("near")))


C.QUERIES["k3_topn_pages_timers_stream"] = k3_topn_pages_timers_stream
C.ORACLES["k3_topn_pages_timers_stream"] = C.ORACLES["k3_topn_pages_late_stream"]
for _name, _fn in [("a10b_uv_bloom_changelog", a10b_uv_bloom_changelog_stream), ("a9h_uv_sketch_sliding", a9h_uv_sketch_sliding_stream)]:
    _register(_name, _fn)
