"""Keys dealt into hash parts: one handler call answers for all keys of a part, as a plain loop over each key would, and a part
waits for one timer however many of its keys wait."""

import random

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_processors import Key

from eventide.streaming import generic, stateful
from eventide.streaming.replay import read_replay, run_to_parquet, write_replay


def _batches(rows, columns, size):
    for at in range(0, len(rows), size):
        yield pd.DataFrame(rows[at:at + size], columns=columns)


def _plain(rows):
    return sorted((tuple(None if x is None or x != x else x for x in r) for r in rows), key=str)


def _lags_of(rows, keys, k):
    seen, want = {}, []
    for r in rows:
        own = seen.setdefault(tuple(r[c] for c in keys), [])
        want.append((*r, *[own[-j] if len(own) >= j else None for j in range(1, k + 1)]))
        own.append(r[2])
    return want


def test_lags_of_all_keys_of_a_part():
    rng = random.Random(1)
    rows = [(rng.choice(["1", "2", "3", None]), i, rng.choice([True, False, None])) for i in range(200)]
    for size in (1, 13, 200):
        k = Key(generic.LagProcessor(["id"], ["seq"], {"a": ("v", 1), "b": ("v", 2)}, {"seq": "bigint", "v": "boolean"}, ["id", "seq", "v", "a", "b"]), (0,))
        for part in _batches(rows, ["id", "seq", "v"], size):
            k.batch(part, 0)
        assert _plain(tuple(None if x is pd.NA else x for x in r) for r in k.out) == _plain(_lags_of(rows, [0], 2))


def test_a_lag_keeps_longs_and_null_keys(spark):
    rows = [(2 ** 60 + i % 3 if i % 5 else None, i, 2 ** 55 + i) for i in range(40)]
    df = spark.createDataFrame(rows, "user_id long, seq long, n long")
    stream = read_replay(spark, write_replay(df, "seq", chunks=3), df.schema)
    out = run_to_parquet(generic.lag_stream(stream, ["user_id"], ["seq"], {"p": ("n", 1)}, {"p": T.LongType()})).select("user_id", "seq", "n", "p")
    assert out.schema["user_id"].dataType == T.LongType() and _plain(map(tuple, out.collect())) == _plain(_lags_of(rows, [0], 1))


def test_keys_share_a_bounded_number_of_parts(spark):
    df = spark.range(20_000).select(F.col("id").alias("user_id"))
    assert generic.in_parts(df, ["user_id"]).select(generic.PART).distinct().count() == generic.PARTS
    assert generic.in_parts(df.limit(1).select(F.lit(None).cast("long").alias("user_id")), ["user_id"]).first()[generic.PART] is not None


def test_a_part_reconciles_each_of_its_keys():
    rng = random.Random(7)
    rows = sorted((rng.randrange(0, 4000) * 1000, rng.randrange(2), i, f"u{rng.randrange(12)}") for i in range(300))
    tags, within = ("m", "o", "r"), 60_000
    want = []
    for own in {r[3] for r in rows}:
        wait = None
        for row in [r for r in rows if r[3] == own] + [None]:
            if wait and row and wait[1] != row[1] and row[0] - wait[0] <= within:
                a, b = (wait, row) if row[1] else (row, wait)
                want.append((own, a[2], a[0], b[2], b[0], "m"))
                wait = None
                continue
            if wait:
                want.append((own, None, None, wait[2], wait[0], "r") if wait[1] else (own, wait[2], wait[0], None, None, "o"))
            wait = row
    for width in (50_000, 1_000_000):
        k = Key(stateful.ReconcileProcessor(within, tags, width), (3,))
        arrival = sorted(rows, key=lambda r: r[0] + rng.randrange(0, 200_000))
        for at in range(0, 300, 25):
            k.batch(pd.DataFrame(arrival[at:at + 25], columns=["ts_us", "side", "seq", "id"]), max(r[0] for r in arrival[:at + 25]) // 1000 - 201)
        k.batch(pd.DataFrame([], columns=["ts_us", "side", "seq", "id"]), 10 ** 7)
        assert _plain(k.out) == _plain(want) and {r[5] for r in want} == set(tags)
        assert not k.handle.states["held"] and k.handle.states["slot"].get() is None


def test_a_part_checks_the_failures_of_each_of_its_keys():
    rng = random.Random(8)
    rows = sorted((rng.randrange(0, 400) * 1000, i, rng.random() < 0.8, f"u{rng.randrange(9)}") for i in range(300))
    want = []
    for own in {r[3] for r in rows}:
        mine = [r for r in rows if r[3] == own]
        for i, (t, _, fail, _) in enumerate(mine):
            if fail and not any(not f and x <= t + 5000 for x, _, f, _ in mine[i + 1:]):
                start = max((j + 1 for j in range(i) if not mine[j][2]), default=0)
                n = sum(f and x <= t + 5000 for x, _, f, _ in mine[start:])
                if n >= 2:
                    want.append((own, mine[start][0], t, n))
    for size in (1, 25, 300):
        k = Key(stateful.RepeatedFailureProcessor(2, 5000), (3,))
        for part in _batches(rows, ["ts_us", "seq", "fail", "id"], size):
            k.batch(part, (int(part["ts_us"].max()) - 1) // 1000)
            assert len(k.handle.timers) <= 2 + 300 // size
        k.batch(pd.DataFrame([], columns=["ts_us", "seq", "fail", "id"]), 10 ** 6)
        assert _plain(k.out) == _plain(want) and want and not k.handle.states["waiting"] and not k.handle.timers


def test_a_part_settles_the_orders_of_a_week_together():
    week = 7 * 86_400_000_000
    rows = [(f"u{u}", w * week, w * week + 1000 * u + e, 10 * u + e, e == 0) for w in range(2) for u in range(40) for e in range(2) if (u + e) % 4 or u % 3]
    k = Key(stateful.OrderOutcomeProcessor(1, week), (3,))
    for part in _batches(sorted(rows, key=lambda r: r[2]), ["id", "week_us", "ts_us", "seq", "is_create"], 30):
        k.batch(part, int(part["ts_us"].max()) // 1000 - 1)
        assert len(k.handle.timers) <= 2  # one a week, not one an order
    k.batch(pd.DataFrame([], columns=["id", "week_us", "ts_us", "seq", "is_create"]), 2 * week // 1000)
    want = []
    for u, w in {r[:2] for r in rows}:
        c = min((r[2] for r in rows if r[:2] == (u, w) and r[4]), default=None)
        p = min((r[2] for r in rows if r[:2] == (u, w) and not r[4]), default=None)
        want.append((u, w, "data-not-found" if c is None else "time-out" if p is None else "paid" if p < c + 1 else "paid-but-timeout", c, p))
    assert _plain(k.out) == _plain(want) and {r[2] for r in want} >= {"data-not-found", "time-out", "paid-but-timeout"}
    assert not k.handle.states["orders"] and not k.handle.timers


def test_a_part_resolves_the_starts_of_each_of_its_keys():
    rng = random.Random(9)
    rows = sorted((rng.randrange(0, 900) * 1000, i, rng.random() < 0.6, f"u{rng.randrange(9)}", rng.randrange(2)) for i in range(300))
    want = []
    for i, (t, _, start, u, w) in enumerate(rows):
        if start:
            end = next((x[0] for x in rows[i + 1:] if not x[2] and x[3:] == (u, w)), None)
            paid = end is not None and end < t + 40_000
            want.append((u, w, t, end if paid else None, "paid" if paid else "timeout", None if paid else t + 40_000))
    for size in (1, 25, 300):
        k = Key(stateful.FollowedByProcessor(40_000), (3,))
        for part in _batches(rows, ["ts_us", "seq", "is_start", "id", "week_us"], size):
            k.batch(part, (int(part["ts_us"].max()) - 1) // 1000)
            assert len(k.handle.timers) <= 2 + 300 // size
        k.batch(pd.DataFrame([], columns=["ts_us", "seq", "is_start", "id", "week_us"]), 10 ** 6)
        assert _plain(k.out) == _plain(want) and {r[4] for r in want} == {"paid", "timeout"}
        assert not k.handle.states["pending"] and not k.handle.timers


def test_a_block_of_windows_is_reported_corrected_and_cleared():
    rng = random.Random(10)
    minute = 60_000_000
    ends = [m * minute for m in range(5, 65, 5)]
    k, counts = Key(stateful.PageRankingProcessor(2, 60_000), (0, 3)), {}
    calls = 0
    for now in range(0, 70):  # minutes; the watermark trails by the lateness
        rows = [(e, f"/{rng.randrange(5)}", rng.randrange(1, 4)) for e in ends if e // minute >= now for _ in range(2)]
        for e, url, n in rows:
            counts[e, url] = counts.get((e, url), 0) + n
        k.batch(pd.DataFrame(rows, columns=["end_us", "url", "n"]), now * 60_000 - 1)
        calls = max(calls, len(k.handle.timers))
        last = {e: max(r[2] for r in k.out if r[0] == e) for e in {r[0] for r in k.out}}
        for e in last:
            if last[e] == now * 60_000 - 1:  # a window's report of this batch
                got = [r[3:] for r in k.out if r[0] == e and r[2] == last[e]]
                best = sorted((-c, u) for (x, u), c in counts.items() if x == e)[:2]
                assert got == [(u, -c, i) for i, (c, u) in enumerate(best, 1)]
    assert {r[0] for r in k.out} == set(ends) and calls <= 2
    assert not k.handle.states["counts"] and k.handle.states["open"].get() is None and not k.handle.timers


def test_views_counted_by_pane_keep_their_number_and_latest_time(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 11 > 0, F.concat(F.lit("/"), (F.col("id") % 7).cast("string"))).alias("url"),
                                  F.when(F.col("id") % 13 > 0, F.timestamp_seconds(F.col("id") % 1000)).cast("timestamp_ntz").alias("ts")).coalesce(1)
    out = stateful.counted_in_panes(df, "url", "ts", 300)
    pane = lambda c: F.floor(F.unix_micros(F.col(c).cast("timestamp")) / 300_000_000).alias("pane")
    got = out.groupBy("url", pane("ets")).agg(F.sum("n"), F.max("ets").cast("timestamp_ntz"))
    want = df.dropna().groupBy("url", pane("ts")).agg(F.count("ts"), F.max("ts"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and out.count() < 100


def test_a_replay_is_appended_as_it_was_staged(spark):
    df = spark.range(400).select(F.col("id").alias("seq"), F.col("id").cast("string").alias("v")).coalesce(1)
    replay = write_replay(df, "seq", chunks=4)
    where = spark.read.parquet(replay.folder).select("seq", F.input_file_name().alias("file")).collect()
    assert len({r.file for r in where}) == 4 and len(where) == 400  # dealing rows out anew would fill every writer's file


def test_words_are_counted_from_a_stream_of_lines(spark, tmp_path, monkeypatch):
    from collections import Counter

    from eventide.plans import streams

    texts = ["a b  a\nc", "", None, "b b\n\nd a", "c"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts * 6)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    replayed = []
    monkeypatch.setattr(streams, "write_replay", lambda df, *a, **kw: replayed.append(df.columns) or write_replay(df, *a, **kw))
    got = {r.word: r.cnt for r in streams.a2_word_count_update_stream(spark, str(tmp_path)).collect()}
    assert replayed == [["doc_id", "line"]] and got == Counter(w for t in texts * 6 if t for w in t.split())
