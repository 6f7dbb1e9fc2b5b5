"""Edge cases of the operators on small hand-written fixtures (new rows of the
reference's record shapes, never its files)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventide.functions.hashing import bloom_offset
from eventide.functions.text import jvm_split
from eventide.operators import aggregate as agg
from eventide.operators import capping, late, ordered, reconcile, sequence, topk, transform
from eventide.operators.windows import UserAggregate, count_window, session_aggregate, window_aggregate

T0 = dt.datetime(2024, 3, 1, 0, 0, 0)


def ts(sec):
    return T0 + dt.timedelta(seconds=sec)


@pytest.fixture(params=["cut", "whole"])
def slicing(request, monkeypatch):
    """Keys cut into slices of one or two rows, on several levels, and keys left whole."""
    if request.param == "cut":
        monkeypatch.setattr(ordered, "TARGET", 1)
        monkeypatch.setattr(ordered, "BUCKETS", 3)
    return request.param


def test_jvm_split_semantics(spark):
    df = spark.createDataFrame([("a b  ",), ("",), ("   ",), (" a",), ("a  b",)], "line string")
    got = [r[0] for r in df.select(jvm_split("line")).collect()]
    assert got == [["a", "b"], [""], [], ["", "a"], ["a", "", "b"]]


def test_word_count_keeps_empty_tokens(spark):
    df = spark.createDataFrame([("a b a",), ("",), ("  ",), (" b",)], "line string")
    got = {r.word: r.cnt for r in agg.word_count(df).collect()}
    assert got == {"a": 2, "b": 2, "": 2}
    got2 = {r.word: r.cnt for r in agg.word_count(df, drop_empty=True).collect()}
    assert got2 == {"a": 2, "b": 2}


def test_bloom_hash_fixed_value(spark):
    v = spark.range(1).select(bloom_offset(F.lit("543462")).alias("h")).first().h
    assert v == 398203944


def test_threshold_routing_boundaries(spark):
    df = spark.createDataFrame([("s1", 30.0), ("s2", 30.5), ("s3", 29.9)], "id string, temperature double")
    tags = {r.id: r.tag for r in transform.tag_threshold(df, "temperature", 30.0).collect()}
    assert tags == {"s1": "low", "s2": "high", "s3": "low"}  # R1: strictly above
    side = {r.id: r.channel for r in transform.route_side_output(df, "id", "temperature", 30.0).collect()}
    assert side == {"s1": "side", "s2": "side", "s3": "main"}  # R2: at or above


def test_prefix_filter_matches_longer_ids(spark):
    df = spark.createDataFrame([("sensor_1",), ("sensor_10",), ("sensor_2",)], "id string")
    assert sorted(r.id for r in transform.prefix_filter(df, "id", "sensor_1").collect()) == ["sensor_1", "sensor_10"]


def test_union_is_bag_union(spark):
    df = spark.createDataFrame([(1, 40.0), (2, 10.0)], "seq long, temperature double")
    t = transform.tag_threshold(df, "temperature")
    u = transform.union_all(transform.select_tags(t, ["high"]), transform.select_tags(t, ["low"]),
                            transform.select_tags(t, ["high", "low"]))
    assert sorted(r.seq for r in u.collect()) == [1, 1, 2, 2]


def test_top_n_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(1, "w", 5), (2, "w", 5), (3, "w", 7), (4, "w", 5)], "item long, g string, cnt long")
    got = topk.top_n(df, ["g"], [F.col("cnt").desc(), F.col("item")], 3).orderBy("rank").collect()
    assert [(r.item, r.rank) for r in got] == [(3, 1), (1, 2), (2, 3)]


def test_session_gap_exactly_equal_merges(spark, slicing):
    rows = [("u", ts(0), 1), ("u", ts(60), 2), ("u", ts(121), 3), ("v", ts(5), 4)]
    df = spark.createDataFrame(rows, "user string, ts timestamp_ntz, seq long")
    got = sorted((r.user, r.window_start, r.cnt) for r in
                 session_aggregate(df, ["user"], "ts", 60, ["ts", "seq"]).collect())
    assert got == [("u", ts(0), 2), ("u", ts(121), 1), ("v", ts(5), 1)]


def test_count_windows_tail_and_slide(spark, slicing):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(1, 26)], "k string, seq long, v double")
    sl = F.floor(F.col("seq") / 4).cast("bigint")
    tumb = count_window(df, ["k"], ["seq"], 10, aggs=[("mx", "max", F.col("v"))], slice_col=sl)
    assert sorted((r.end_pos, r.mx) for r in tumb.collect()) == [(10, 10.0), (20, 20.0)]  # tail 21..25 never fires
    slid = count_window(df, ["k"], ["seq"], 10, 5, aggs=[("cnt", "count", F.lit(1)), ("mn", "min", F.col("v"))],
                        slice_col=sl)
    assert sorted((r.end_pos, r.cnt, r.mn) for r in slid.collect()) == [
        (5, 5, 1.0), (10, 10, 1.0), (15, 10, 6.0), (20, 10, 11.0), (25, 10, 16.0)]


def test_sliding_panes_equal_direct(spark):
    rows = [("x", ts(s), 1) for s in (0, 59, 61, 299, 300, 3599, 3600, 7000)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, one int")
    a = window_aggregate(df, ["k"], "ts", "1 hour", "5 minutes", panes=True)
    b = window_aggregate(df, ["k"], "ts", "1 hour", "5 minutes", panes=False)
    assert sorted(a.collect()) == sorted(b.collect())
    c = window_aggregate(df, ["k"], "ts", "10 minutes", "4 minutes", panes=True)
    d = window_aggregate(df, ["k"], "ts", "10 minutes", "4 minutes", panes=False)
    assert sorted(c.collect()) == sorted(d.collect())


LOGIN = "user long, event_type string, ts timestamp_ntz, seq long"


def _many(spark, n=160, seed=4):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", None]), ts(rng.randrange(-4000, 9000)) if i % 17 else None, rng.choice([None, 1.0, 2.5, -3.0, 9.0]), i) for i in range(n)]
    return spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double, seq long").coalesce(2)


@pytest.mark.parametrize("size,slide,offset,keys", [(600, 120, 0, ["k"]), (600, 240, 60, ["k"]), (3600, 5, 0, []), (35, 5, 3, ["k"]), (100, 7, 0, [])])
def test_windows_from_blocks_equal_direct(spark, size, slide, offset, keys):
    df = _many(spark)
    mean = UserAggregate({"s": F.sum("v"), "n": F.count("v")}, {"s": F.sum("s"), "n": F.sum("n")}, F.col("s") / F.col("n"))
    aggs = [("c", "count", F.lit(1)), ("cv", "count", F.col("v")), ("sm", "sum", F.col("v")), ("lo", "min", F.col("seq")), ("hi", "max", F.col("v")), ("m", mean)]
    make = lambda **how: window_aggregate(df, keys, "ts", size, slide, offset, aggs, **how)
    got, want = make(fan_out=1), make(panes=False)
    assert got.columns == want.columns and [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_a_pane_is_two_rows_before_the_last_shuffle(spark):
    df = _many(spark)
    out = window_aggregate(df, ["k"], "ts", "1 hour", "5 seconds")
    plan = out._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange hashpartitioning(k"):] if plan.count("Exchange hashpartitioning") < 2 else plan.split("Exchange hashpartitioning")[1]
    assert plan.count("Exchange hashpartitioning") == 2 and "sequence(" not in below and "Generate explode([0,1])" in below
    assert window_aggregate(df.limit(0), ["k"], "ts", "1 hour", "5 seconds").count() == 0


@pytest.mark.parametrize("slide", ["10 minutes", "1 minute"])
def test_sketches_of_panes_merge_to_windows(spark, slide):
    df = spark.range(12_000).select((F.col("id") * 7919 % 4001).alias("user"), F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("ts"))
    near = {r.window_start: r.uv_estimate for r in agg.sketch_distinct_per_window(df, "ts", "30 minutes", slide, "user").collect()}
    pairs = window_aggregate(df, ["user"], "ts", "30 minutes", slide)
    exact = {r.window_start: r.n for r in pairs.groupBy("window_start").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert near.keys() == exact.keys() and all(abs(near[w] - n) <= n / 12 + 1 for w, n in exact.items())


def test_repeated_failures_against_a_plain_loop(spark, slicing):
    rng = random.Random(9)
    rows = [(rng.choice([1, 2]), rng.choice(["fail", "fail", "success"]), ts(rng.randrange(0, 40)), i) for i in range(60)] + [(1, "fail", None, 99)]
    want = []
    for user in (1, 2):
        mine = sorted((r[2], r[3], r[1] == "fail") for r in rows if r[0] == user and r[2] is not None)
        for i, (t, _, fail) in enumerate(mine):
            due = t + dt.timedelta(seconds=5)
            if not fail or any(not f and x <= due for x, _, f in mine[i + 1:]):
                continue
            start = max((j + 1 for j in range(i) if not mine[j][2]), default=0)
            run = [x for x, _, f in mine[start:] if f and x <= due]
            if len(run) >= 2:
                want.append((user, mine[start][0], t, len(run)))
    df = spark.createDataFrame(rows, LOGIN).filter("seq <> 99")
    got = sequence.repeated_failures(df, "user", "ts", "seq", F.col("event_type") == "fail", n=2, check_after=5)
    assert sorted(map(tuple, got.collect())) == sorted(want) and want


def test_reconcile_against_a_plain_slot(spark, slicing):
    rng = random.Random(3)
    rows = sorted((rng.choice("ab"), rng.randrange(0, 300), rng.randrange(2), i) for i in range(60))
    want = []
    for key in "ab":
        wait = None
        for t, side, no in sorted((t, s, i) for k, t, s, i in rows if k == key):
            if wait and wait[1] != side and t - wait[0] <= 10:
                want.append((key, *(x if x else None for x in ((wait[2], no) if side else (no, wait[2]))), "match"))
                wait = None
            else:
                if wait:
                    want.append((key, None if wait[1] else wait[2], wait[2] if wait[1] else None, "single-receipt" if wait[1] else "single-order"))
                wait = (t, side, no)
        if wait:
            want.append((key, None if wait[1] else wait[2], wait[2] if wait[1] else None, "single-receipt" if wait[1] else "single-order"))
    rows = [(k, t, s, i) for k, t, s, i in rows]
    frame = lambda side, a, b: spark.createDataFrame([(k, i, ts(t), f"{k}{i}") for k, t, s, i in rows if s == side], f"tx string, {a} long, {b} timestamp_ntz, note_{a} string")
    got = reconcile.interval_reconcile(frame(0, "pseq", "pts"), frame(1, "rseq", "rts"), "tx", bound_seconds=10, left_cols=["pseq", "pts", "note_pseq"],
                                       right_cols=["rseq", "rts"], lts="pts", rts="rts", lseq="pseq", rseq="rseq").collect()
    shown = sorted(((r.tx, r.pseq, r.rseq, r.outcome) for r in got), key=str)
    want = [(k, a if a is not None else None, b if b is not None else None, o) for k, a, b, o in want]
    fix = lambda rs: sorted(((k, a or None, b or None, o) for k, a, b, o in rs), key=str)
    assert fix(shown) == fix(want)
    assert all((r.note_pseq is None) == (r.pseq is None) and (r.pseq is None or r.note_pseq == f"{r.tx}{r.pseq}") for r in got)


def test_repeated_failures_rule(spark, slicing):
    rows = [
        # user 1: burst of failures, checked 2 s after each
        (1, "fail", ts(0), 1), (1, "fail", ts(1), 2), (1, "fail", ts(3), 3), (1, "fail", ts(4), 4),
        # user 2: failure, success within 2 s cancels, then one failure
        (2, "fail", ts(0), 5), (2, "success", ts(1), 6), (2, "fail", ts(2), 7),
        # user 3: failure list spanning a success more than 2 s later
        (3, "fail", ts(0), 8), (3, "fail", ts(1), 9), (3, "success", ts(10), 10), (3, "fail", ts(11), 11),
    ]
    df = spark.createDataFrame(rows, LOGIN)
    got = sorted(tuple(r) for r in sequence.repeated_failures(
        df, "user", "ts", "seq", F.col("event_type") == "fail", n=2, check_after=2).collect())
    assert got == [(1, ts(0), ts(0), 2), (1, ts(0), ts(1), 3), (1, ts(0), ts(3), 4), (1, ts(0), ts(4), 4),
                   (3, ts(0), ts(0), 2), (3, ts(0), ts(1), 2)]


def test_consecutive_pair_arrival_order(spark, slicing):
    rows = [(1, "fail", ts(10), 1), (1, "fail", ts(9), 2), (1, "fail", ts(20), 3), (1, "success", ts(21), 4),
            (1, "fail", ts(22), 5)]
    df = spark.createDataFrame(rows, LOGIN)
    got = [tuple(r) for r in sequence.consecutive_pair(df, "user", "ts", "seq", F.col("event_type") == "fail",
                                                       within=2).collect()]
    assert got == [(1, ts(10), ts(9))]  # negative gap passes; 9 -> 20 too far; success resets


def test_strict_sequence_overlapping_and_within(spark, slicing):
    rows = [(1, "fail", ts(s), s) for s in (0, 1, 2, 3, 9)] + [(1, "success", ts(4), 100)]
    df = spark.createDataFrame(rows, LOGIN)
    f = F.col("event_type") == "fail"
    got = sorted(tuple(r) for r in sequence.strict_sequence(
        df, "user", "ts", "seq", [("a", f), ("b", f), ("c", f)], within=3).collect())
    assert got == [(1, ts(0), ts(1), ts(2)), (1, ts(1), ts(2), ts(3))]


ORD = "oid long, event_type string, ts timestamp_ntz, seq long"


def test_order_outcomes_boundaries(spark, slicing):
    rows = [(1, "create", ts(0), 1), (1, "pay", ts(0), 2),            # same second -> paid
            (2, "pay", ts(0), 3), (2, "create", ts(5), 4),            # pay before create -> paid
            (3, "create", ts(0), 5), (3, "pay", ts(900), 6),          # exactly 15 min -> timeout
            (4, "create", ts(0), 7), (5, "pay", ts(0), 8)]
    df = spark.createDataFrame(rows, ORD)
    got = {r.oid: r.outcome for r in reconcile.order_outcomes(
        df, ["oid"], "ts", "seq", F.col("event_type") == "create", F.col("event_type") == "pay",
        limit_seconds=900).collect()}
    assert got == {1: "paid", 2: "paid", 3: "paid-but-timeout", 4: "time-out", 5: "data-not-found"}
    fb = {(r.oid, r.outcome) for r in sequence.followed_by(
        df, ["oid"], "ts", "seq", F.col("event_type") == "create", F.col("event_type") == "pay",
        within=900, timeouts=True).collect()}
    assert fb == {(1, "paid"), (2, "timeout"), (3, "timeout"), (4, "timeout")}


def test_interval_reconcile_outcomes(spark, slicing):
    pays = spark.createDataFrame([("t1", 1, ts(0)), ("t2", 2, ts(0)), ("t3", 3, ts(100))],
                                 "tx string, pseq long, pts timestamp_ntz")
    rcpts = spark.createDataFrame([("t1", 10, ts(5)), ("t2", 11, ts(6)), ("t4", 12, ts(0))],
                                  "tx string, rseq long, rts timestamp_ntz")
    got = sorted((r.tx, r.outcome) for r in reconcile.interval_reconcile(
        pays, rcpts, "tx", bound_seconds=5, left_cols=["pseq", "pts"], right_cols=["rseq", "rts"],
        lts="pts", rts="rts", lseq="pseq", rseq="rseq").collect())
    assert got == [("t1", "match"), ("t2", "single-order"), ("t2", "single-receipt"), ("t3", "single-order"),
                   ("t4", "single-receipt")]


def test_cap_around_local_midnight(spark):
    # 15:59:59 UTC is 23:59:59 at UTC+8; 16:00:00 UTC starts the next local day
    base = dt.datetime(2024, 3, 1, 15, 59, 58)
    rows = [(1, 7, base + dt.timedelta(seconds=i), i, "p") for i in range(4)]
    df = spark.createDataFrame(rows, "user_id long, ad_id long, ts timestamp_ntz, seq long, province string")
    by = (["user_id", "ad_id"], "ts", "seq")
    pos = capping.first_clicks(df, *by, 9)
    got = sorted((r.seq, str(r.day), r.click_no) for r in pos.collect())
    assert got == [(0, "2024-03-01", 1), (1, "2024-03-01", 2), (2, "2024-03-02", 1), (3, "2024-03-02", 2)]
    assert capping.cap_clicks(df, *by, 1).count() == 2
    assert capping.black_list(df, *by, 1).count() == 2


def test_late_routing_and_lateness(spark, slicing):
    # arrival order = seq; delay 0; 10 s tumbling windows
    rows = [(1, ts(1)), (2, ts(12)), (3, ts(9)), (4, ts(31)), (5, ts(15)), (6, ts(5))]
    df = spark.createDataFrame(rows, "seq long, ts timestamp_ntz")
    routed = {r.seq: r.channel for r in late.route_late(df, "ts", ["seq"], 0, 10).collect()}
    assert routed == {1: "on_time", 2: "on_time", 3: "late", 4: "on_time", 5: "late", 6: "late"}
    kept = late.accepted_window_rows(df, "ts", ["seq"], 0, 10, lateness=15)
    # wm before seq 5 is 31 >= 20 + 15? no -> window [10,20) still accepts it; seq 6: 31 >= 10 + 15 -> dropped
    assert sorted(r.seq for r in kept.collect()) == [1, 2, 3, 4, 5]


def test_jump_exactly_threshold(spark, slicing):
    df = spark.createDataFrame([("s", 1, 10.0), ("s", 2, 20.0), ("s", 3, 29.5), ("s", 4, 10.0)],
                               "id string, seq long, temperature double")
    got = [(r.prev_value, r.temperature) for r in sequence.jumps(
        df, "id", ["seq"], "temperature", 10.0, F.col("seq")).orderBy("seq").collect()]
    assert got == [(10.0, 20.0), (29.5, 10.0)]


def test_rising_alert(spark, slicing):
    rows = [("s", ts(0), 1, 10.0), ("s", ts(10), 2, 11.0), ("s", ts(20), 3, 12.0), ("s", ts(100), 4, 5.0),
            ("s", ts(110), 5, 6.0), ("s", ts(115), 6, 1.0)]
    df = spark.createDataFrame(rows, "id string, ts timestamp_ntz, seq long, temperature double")
    got = [tuple(r) for r in sequence.rising_alerts(df, "id", "ts", "seq", "temperature", 60).collect()]
    assert got == [("s", ts(10), ts(70))]


def test_running_word_count_changelog(spark, slicing):
    lines = spark.createDataFrame([(0, 0, "a b a"), (1, 0, "b a"), (2, 0, "a")], "doc_id long, line_no int, line string")
    toks = agg.tokens(lines, keep=["doc_id", "line_no"], drop_empty=True)
    out = agg.running_word_count(toks, ["doc_id", "line_no", "pos"], F.col("doc_id"))
    got = [(r.word, r.cnt) for r in out.orderBy("doc_id", "pos").collect()]
    assert got == [("a", 1), ("b", 1), ("a", 2), ("b", 2), ("a", 3), ("a", 4)]


def test_hyperloglog_distinct_is_near_the_exact_one(spark):
    from eventide.operators import aggregate

    df = spark.range(20_000).select((F.col("id") % 7000).alias("user"), F.timestamp_seconds(F.col("id") % 7200).cast("timestamp_ntz").alias("ts"))
    exact = {r.window_start: r.uv for r in aggregate.distinct_per_window(df, "ts", "1 hour", "user").collect()}
    near = {r.window_start: r.uv for r in aggregate.distinct_per_window(df, "ts", "1 hour", "user", relative_error=0.02).collect()}
    assert exact.keys() == near.keys() and all(abs(near[w] - n) < 0.08 * n for w, n in exact.items())


def test_user_aggregate_equals_plain_windows(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("k"), F.timestamp_seconds(F.col("id") * 37 % 5000).cast("timestamp_ntz").alias("ts"),
                                 F.when(F.col("id") % 11 > 0, F.col("id")).alias("v"))
    mean = UserAggregate({"s": F.sum("v"), "n": F.count("v")}, {"s": F.sum("s"), "n": F.sum("n")}, F.col("s") / F.col("n"))
    by = lambda panes: sorted(map(tuple, window_aggregate(df, ["k"], "ts", 600, 120, aggs=[("m", mean), ("c", "count", F.lit(1))], panes=panes).collect()), key=str)
    assert by(True) == by(False) and len(by(True)) > 10
    with pytest.raises(ValueError):
        UserAggregate({"a": F.sum("v")}, {"b": F.sum("b")}, F.col("a"))


def test_accepted_counts_equal_accepted_rows(spark, slicing):
    rows = spark.range(400).select(F.col("id").alias("seq"), (F.col("id") % 2).alias("k"),
                                   F.timestamp_seconds(F.col("id") * 50 - (F.col("id") * 7919) % 3000).cast("timestamp_ntz").alias("ts"))
    for lateness in (0, 250):
        a = late.accepted_window_rows(rows, "ts", ["seq"], 60, 600, 120, lateness=lateness)
        want = a.groupBy("k", "window_start", "window_end").agg(F.count(F.lit(1)).alias("cnt"))
        got = late.accepted_window_counts(rows, ["k"], "ts", ["seq"], 60, 600, 120, lateness=lateness)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
