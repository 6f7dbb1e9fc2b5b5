"""Micro-batch tables go on from what is stored: a query that is stopped after some batches and started anew from its
checkpoint gives the full table, and the change log of a retract stream is right batch by batch."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.session import checkpoint_root, scratch_path
from eventide.streaming import forms, generic, tables
from eventide.streaming.replay import read_replay, run_to_parquet, write_replay

SCHEMA = "k string, seq long, v double"


def _rows(spark, lo, hi):
    return spark.range(lo, hi).select(F.concat(F.lit("k"), (F.col("id") * 7 % 13).cast("string")).alias("k"), F.col("id").alias("seq"),
                                      (F.col("id") * 1.5).alias("v"))


def test_upsert_resumes_after_a_restart(spark):
    root, ckpt = scratch_path(spark, "t-table"), scratch_path(spark, "t-ckpt")
    first = write_replay(_rows(spark, 0, 100), "seq", chunks=2)
    run = lambda: tables.upsert_stream(read_replay(spark, first, SCHEMA), root, ckpt, ["k"], ["v"], ["seq"])
    run()
    write_replay(_rows(spark, 100, 130), "seq", chunks=2, folder=first.folder, files_per_chunk=first.files)
    got = {r.k: (r.v, r.seq) for r in run().read().collect()}  # a new query over the same checkpoint
    want = {}
    for r in _rows(spark, 0, 130).orderBy("seq").collect():
        want[r.k] = (r.v, r.seq)
    assert got == want


SCHEMA_KVS = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.DoubleType()), T.StructField("seq", T.LongType())])


def _table(spark, name="t-table"):
    return tables.LogTable(spark, scratch_path(spark, name), SCHEMA_KVS, ["k"], ["seq"])


def _one(spark, k, seq, v):
    return spark.createDataFrame([(k, v, seq)], SCHEMA_KVS)


def _bytes(table, prefix):
    root = table.root.removeprefix("file:")
    return {n: sum(os.path.getsize(f"{root}/{n}/{f}") for f in os.listdir(f"{root}/{n}") if f.endswith(".parquet")) for n in os.listdir(root) if n.startswith(prefix)}


def test_what_a_batch_writes_follows_the_batch(spark):
    table = _table(spark)
    big = spark.range(20_000).select(F.concat(F.lit("key"), F.col("id")).alias("k"), (F.col("id") * 1.5).alias("v"), F.col("id").alias("seq")).coalesce(1)
    table.write(0, big)
    whole = sum(_bytes(table, "d=").values())
    for b in range(1, 8):
        table.write(b, _one(spark, f"key{b % 3}", 100_000 + b, float(b)).coalesce(1))
        live = _bytes(table, "d=") | _bytes(table, "c=")
        assert live["d=0"] == whole and sum(n for name, n in live.items() if name != "d=0") < whole / 10
    names = [d["name"] for d in table.manifest()]
    assert names[0] == "d=0" and len(names) <= 4  # small deltas are merged among themselves
    got = {r.k: r.v for r in table.read().filter("k IN ('key0', 'key1', 'key2', 'key9')").collect()}
    assert got == {"key0": 6.0, "key1": 7.0, "key2": 5.0, "key9": 13.5} and table.read().count() == 20_000
    # old manifests and merged deltas are gone, what the last two name is there
    root = table.root.removeprefix("file:")
    assert sorted(n for n in os.listdir(root) if n.startswith("m=")) == ["m=6", "m=7"]
    assert {n for n in os.listdir(root) if n[:2] in ("d=", "c=")} <= {d["name"] for b in (7, 8) for d in table.manifest(b)}


def test_a_table_loses_nothing_between_delta_and_manifest(spark, monkeypatch):
    table, want = _table(spark), {}
    for b in range(6):
        rows = spark.createDataFrame([(f"k{(b + i) % 5}", b * 10.0 + i, b * 10 + i) for i in range(3)], SCHEMA_KVS)
        with monkeypatch.context() as m:  # the batch stops after its delta (and merge), before its manifest
            m.setattr(tables, "_write_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                table.write(b, rows)
        assert {r.k: r.v for r in table.read().collect()} == want
        for _ in range(2):  # it runs again, and once more
            table.write(b, rows)
            after = {**want, **{f"k{(b + i) % 5}": b * 10.0 + i for i in range(3)}}
            assert {r.k: r.v for r in table.read().collect()} == after
        assert {r.k: r.v for r in table.read(b).collect()} == want
        want = after


def test_merging_forgets_what_is_over(spark):
    table = _table(spark)
    table.write(0, _one(spark, "old", 1, 1.0))
    table.write(1, _one(spark, "new", 50, 2.0), live=F.col("seq") >= 10)
    assert [r.k for r in table.read().collect()] == ["new"]
    assert [r.k for r in table.read(1).collect()] == ["old"]


def test_first_clicks_over_batches_and_restarts(spark):
    def rows(lo, hi):
        return spark.range(lo, hi).select(F.when(F.col("id") % 5 < 3, 1).otherwise(F.col("id") % 7).cast("long").alias("user_id"), (F.col("id") % 2).alias("ad_id"),
                                          F.timestamp_seconds(F.col("id") * 1800).cast("timestamp_ntz").alias("ts"), F.col("id").alias("seq"))

    root, ckpt = scratch_path(spark, "t-clicks"), scratch_path(spark, "t-clicks-ckpt")
    first = write_replay(rows(0, 300), "seq", chunks=4)
    schema = rows(0, 1).schema
    run = lambda: tables.first_clicks_stream(read_replay(spark, first, schema), root, ckpt, ["user_id", "ad_id"], "ts", "seq", 3)
    run()
    write_replay(rows(300, 420), "seq", chunks=2, folder=first.folder, files_per_chunk=first.files)
    got = sorted((r.seq, r.click_no, str(r.day)) for r in run().collect())
    from eventide.operators import capping

    want = sorted((r.seq, r.click_no, str(r.day)) for r in capping.first_clicks(rows(0, 420), ["user_id", "ad_id"], "ts", "seq", 3).collect())
    assert got == want
    counts = tables.LogTable(spark, f"{root}/counts", capping.first_clicks(rows(0, 1), ["user_id", "ad_id"], "ts", "seq", 3).select(
        "user_id", "ad_id", "day", F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("_batch")).schema, ["user_id", "ad_id", "day"], ["_batch"])
    assert counts.read().select("day").distinct().count() < len({d for _, _, d in want})


def test_retract_log_is_right_after_every_batch(spark):
    rows = spark.range(300).select((F.col("id") * F.col("id") % 11).alias("item"), F.col("id").alias("seq"),
                                   F.timestamp_seconds(F.col("id") * 20 % 3600).cast("timestamp_ntz").alias("ts"))
    replay = write_replay(rows, "seq", chunks=5)
    counts = (forms.event_time(read_replay(spark, replay, rows.schema), "ts", 7200).groupBy(F.window("ets", "30 minutes").alias("w"), "item")
              .agg(F.count(F.lit(1)).alias("cnt")).select(F.col("w.end").cast("timestamp_ntz").alias("window_end"), "item", "cnt"))
    log = tables.retract_topn_stream(counts, scratch_path(spark, "t-r5"), scratch_path(spark, "t-r5c"), "window_end", "item", 3).collect()
    assert any(not r.flag for r in log)
    table = set()
    source = rows.collect()
    for b in range(5):
        for r in sorted((r for r in log if r.batch == b), key=lambda r: r.flag):
            row = (r.window_end, r.item, r.cnt, r["rank"])
            assert (row in table) != r.flag  # a retraction names a row that stands, an insertion one that does not
            table ^= {row}
        seen, want = {}, set()
        for r in source:
            if r.seq < (b + 1) * 60:
                end = (r.ts.minute // 30 + 1) * 30
                seen.setdefault(end, {}).setdefault(r.item, 0)
                seen[end][r.item] += 1
        for end, items in seen.items():
            for k, (item, cnt) in enumerate(sorted(items.items(), key=lambda x: (-x[1], x[0]))[:3]):
                want.add((end, item, cnt, k + 1))
        assert {((w.minute or 60) if w.hour == 0 else 60, i, c, k) for w, i, c, k in table} == want


def test_late_routing_resumes_with_its_watermark(spark):
    def rows(lo, hi, shift):
        return spark.range(lo, hi).select(F.col("id").alias("seq"), F.timestamp_seconds(F.col("id") * 600 + shift).cast("timestamp_ntz").alias("ts"))

    root, ckpt = scratch_path(spark, "t-l4"), scratch_path(spark, "t-l4c")
    first = write_replay(rows(0, 40, 0), "seq", chunks=2)
    run = lambda: tables.route_late_stream(read_replay(spark, first, "seq long, ts timestamp_ntz"), root, ckpt, "ts", "1 hour", delay_seconds=0)
    run()
    write_replay(rows(100, 110, -100 * 600), "seq", chunks=1, folder=first.folder, files_per_chunk=first.files)
    routed = {r.seq: r.channel for r in run().collect()}
    assert all(routed[s] == "late" for s in range(100, 110)) and routed[39] == "on_time"


def test_streams_count_nulls_and_keep_longs_exact(spark):
    rows = spark.createDataFrame([("a", i, None if i == 3 else float(i), 2 ** 53 + i) for i in range(8)], "k string, seq long, v double, n long")
    replay = write_replay(rows, "seq", chunks=3)
    out = run_to_parquet(generic.count_window_stream(read_replay(spark, replay, rows.schema), "k", ["seq"], "v", 4)).collect()
    assert sorted((r.end_pos, r.cnt, r.max_value) for r in out) == [(4, 4, 2.0), (8, 4, 7.0)]
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("seq", "top", "total")])
    got = run_to_parquet(generic.running_stream(read_replay(spark, replay, rows.schema), ["k"], ["seq"],
                                                [("top", "max", "n"), ("total", "sum", "seq")], schema)).collect()
    assert sorted((r.seq, r.top, r.total) for r in got) == [(i, 2 ** 53 + i, i * (i + 1) // 2) for i in range(8)]


def test_replay_chunks_have_several_writers(spark):
    replay = write_replay(_rows(spark, 0, 40), "seq", chunks=3)
    files = [f for f in os.listdir(replay.folder.removeprefix("file:")) if f.startswith("part-")]
    assert replay.files >= 2 and len(files) == 3 * replay.files
    assert spark.read.parquet(replay.folder).count() == 40


@pytest.mark.parametrize("delay", [" 3 parsecs", "interval 3 seconds", "PT3S", ""])
def test_unreadable_delay_is_an_error(spark, delay):
    with pytest.raises(ValueError):
        forms.event_time(spark.range(1).select(F.timestamp_seconds("id").alias("ts")), "ts", delay)


def test_a_cluster_needs_a_shared_folder(spark):
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError):
        checkpoint_root(Session())
