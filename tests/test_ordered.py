"""The skew-safe primitives must equal plain window functions, whatever the
slicing: tiny slices force every row through the carry paths, and a
single hot key holds most rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventide.operators import ordered


def _rows(seed, n=400, keys=4, hot_share=0.6):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        k = "hot" if rnd.random() < hot_share else f"k{rnd.randrange(keys)}"
        if rnd.random() < 0.03:
            k = None
        t = rnd.randrange(0, 200)  # ties on t are frequent; seq breaks them
        out.append((k, t, i, rnd.choice([1.0, 2.0, 3.0, None]), rnd.random() < 0.5))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    schema = "k string, t long, seq long, v double, flag boolean"
    df = spark.createDataFrame(_rows(1, n=200), schema).coalesce(2)
    return df.withColumn("ts", F.timestamp_seconds("t").cast("timestamp_ntz"))


@pytest.fixture(params=[(12, 4), (60, 8), (100_000, 1024)], ids=["deep", "hot", "whole"])
def sizes(request, monkeypatch):
    """(rows of a slice, buckets of a level): every key cut on several levels, on one, only the hot key, and none."""
    monkeypatch.setattr(ordered, "TARGET", request.param[0])
    monkeypatch.setattr(ordered, "BUCKETS", request.param[1])
    return request.param


@pytest.mark.parametrize("descending,exclusive", [(False, False), (False, True), (True, True)])
def test_running_matches_window(frame, sizes, descending, exclusive):
    got = ordered.running(frame, ["k"], ["t", "seq"], F.col("t"), [
        ("c", "count", F.col("v")), ("s", "sum", F.col("v")), ("mn", "min", F.col("v")),
        ("mx", "max", F.struct("v", "seq"))], exclusive=exclusive, descending=descending)
    order = [F.col("t").desc(), F.col("seq").desc()] if descending else [F.col("t"), F.col("seq")]
    w = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    exp = frame.select("*", F.count("v").over(w).alias("c"), F.sum("v").over(w).alias("s"),
                       F.min("v").over(w).alias("mn"), F.max(F.struct("v", "seq")).over(w).alias("mx"))
    cols = ["seq", "c", "s", "mn", "mx"]
    assert sorted(got.select(cols).collect()) == sorted(exp.select(cols).collect())
    assert got.columns == [*frame.columns, "c", "s", "mn", "mx"]


@pytest.mark.parametrize("descending", [False, True])
def test_lag_matches_window(frame, sizes, descending):
    got = ordered.lag(frame, ["k"], ["t", "seq"], F.col("t"),
                      {"p1": ("v", 1), "p2": ("v", 2), "p3s": ("seq", 3), "pf": ("flag", 1)}, descending=descending)
    order = [F.col("t").desc(), F.col("seq").desc()] if descending else [F.col("t"), F.col("seq")]
    w = Window.partitionBy("k").orderBy(*order)
    exp = frame.select("*", F.lag("v", 1).over(w).alias("p1"), F.lag("v", 2).over(w).alias("p2"),
                       F.lag("seq", 3).over(w).alias("p3s"), F.lag("flag", 1).over(w).alias("pf"))
    cols = ["seq", "p1", "p2", "p3s", "pf"]
    assert sorted(got.select(cols).collect()) == sorted(exp.select(cols).collect())
    assert got.columns == [*frame.columns, "p1", "p2", "p3s", "pf"]


@pytest.mark.parametrize("ahead", [0, 25])
def test_read_ahead_matches_brute_force(spark, frame, sizes, ahead):
    got = ordered.read_ahead(frame, ["k"], "ts", ["seq"], ahead, None, [
        ("n_flag", "count", F.when(F.col("flag"), 1)), ("last", "max", F.col("seq"))], F.col("v").isNotNull(), ["seq"])
    a, b = frame.filter("v IS NOT NULL").alias("a"), frame.alias("b")
    exp = (a.join(b, F.col("a.k").eqNullSafe(F.col("b.k")) & (F.col("b.t") <= F.col("a.t") + ahead), "left")
           .groupBy(F.col("a.seq").alias("seq")).agg(F.count(F.when(F.col("b.flag"), 1)).alias("n_flag"), F.max("b.seq").alias("last")))
    assert sorted(got.select("seq", "n_flag", "last").collect()) == sorted(exp.collect())


def test_a_sweep_holds_two_rows_for_one_that_asks(spark, frame):
    plan = lambda ahead: ordered.read_ahead(frame, ["k"], "ts", ["seq"], ahead, None, [("n", "count", F.lit(1))], F.col("flag"), ["seq"])
    text = plan(10 ** 6)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in text and plan(10 ** 6).count() == frame.filter("flag").count()


def test_running_without_keys_is_global(frame, sizes):
    got = ordered.running(frame, [], ["seq"], F.col("seq"), [("c", "count", F.lit(1))])
    assert sorted(r.c for r in got.collect()) == list(range(1, frame.count() + 1))


@pytest.mark.parametrize("keys,descending", [([], False), (["k"], True)])
@pytest.mark.parametrize("spread", [1, -(10 ** 12)])
def test_slices_of_dense_sparse_and_negative_places(spark, keys, descending, spread, monkeypatch):
    """Two buckets a level force digit upon digit; results equal a plain window whatever the places, nulls among them."""
    monkeypatch.setattr(ordered, "TARGET", 8)
    monkeypatch.setattr(ordered, "BUCKETS", 2)
    frame = spark.createDataFrame(_rows(1, n=80), "k string, t long, seq long, v double, flag boolean")
    place = (F.col("seq") * abs(spread) + min(spread, 0) * 100).cast("bigint")
    frame = frame.withColumn("at", F.when(F.col("seq") % 23 > 0, place))
    order = [F.col("at").desc(), F.col("seq").desc()] if descending else [F.col("at"), F.col("seq")]
    w = Window.partitionBy(*keys).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, -1)
    cuts = ordered.cuts(frame, keys, F.col("at"))
    assert cuts.depth > 1
    got = ordered.running(frame, keys, ["at", "seq"], cuts, [("c", "count", F.col("v")), ("mx", "max", F.col("v"))],
                          exclusive=True, descending=descending)
    exp = frame.select("seq", F.count("v").over(upto).alias("c"), F.max("v").over(upto).alias("mx"))
    assert sorted(got.select("seq", "c", "mx").collect()) == sorted(exp.collect())
    got = ordered.lag(frame, keys, ["at", "seq"], cuts, {"p1": ("v", 1), "p2": ("seq", 2)}, descending=descending)
    exp = frame.select("seq", F.lag("v", 1).over(w).alias("p1"), F.lag("seq", 2).over(w).alias("p2"))
    assert sorted(got.select("seq", "p1", "p2").collect(), key=str) == sorted(exp.collect(), key=str)


def test_slices_hold_what_the_data_says(spark, monkeypatch):
    """One key holds every row, half of them in a burst: slices are about as long as asked, short keys are whole, and no
    window of the carry sees more slices than a level has buckets."""
    monkeypatch.setattr(ordered, "TARGET", 64)
    monkeypatch.setattr(ordered, "BUCKETS", 16)
    rows = spark.range(0, 4096, 1, 2).select(F.lit("hot").alias("k"), F.when(F.col("id") < 2048, F.col("id") + 10 ** 9).otherwise(F.col("id") * 10 ** 6).alias("at"))
    rows = rows.unionByName(spark.range(0, 60, 1, 1).select(F.concat(F.lit("cold"), F.col("id") % 3).alias("k"), F.col("id").alias("at")))
    cuts = ordered.cuts(rows, ["k"], F.col("at"))
    sliced = cuts.slice(rows).groupBy("k", ordered.SLICE).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("lo"), F.max("at").alias("hi")).collect()
    hot = sorted((r for r in sliced if r.k == "hot"), key=lambda r: r[ordered.SLICE])
    assert max(r.n for r in hot) <= 3 * 64 and 20 < len(hot) < 400
    assert all(a.hi < b.lo for a, b in zip(hot, hot[1:]))
    assert sorted((r.k, r.n) for r in sliced if r.k != "hot") == [("cold0", 20), ("cold1", 20), ("cold2", 20)]
    numbers = {r[ordered.SLICE] for r in hot}
    for _ in range(cuts.depth):
        above = {}
        for x in numbers:
            above.setdefault(x >> ordered.DIGIT, set()).add(x)
        assert max(map(len, above.values())) <= ordered.BUCKETS + 1
        numbers = set(above)
    assert numbers == {0}
    got = ordered.running(rows, ["k"], ["at"], cuts, [("c", "count", F.lit(1))])
    assert sorted(r.c for r in got.filter("k = 'hot'").collect()) == list(range(1, 4097))


def test_whole_keys_pass_in_one_stage(spark, frame):
    """With no long key, passes over the same keys share one shuffle."""
    cuts = ordered.cuts(frame, ["k"], F.col("t"))
    assert cuts.depth == 0
    d = cuts.stage(ordered.lag(frame, ["k"], ["t", "seq"], cuts, {"p": ("v", 1)}))
    d = ordered.running(d, ["k"], ["t", "seq"], cuts, [("c", "count", F.col("p"))])
    d.collect()
    assert d._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


def test_a_slice_a_little_over_the_target_is_not_divided_again(spark):
    df = spark.range(10_000).select(F.lit("k").alias("k"), F.col("id").alias("seq"))
    c = ordered.cuts(df, ["k"], F.col("seq"), target=333)  # buckets of 10 rows: slices of 330 to 340
    sizes = [r["count"] for r in c.slice(df).groupBy(ordered.SLICE).count().collect()]
    assert c.depth == 1 and sum(sizes) == 10_000 and 333 < max(sizes) <= 666
    burst = df.withColumn("seq", F.when(F.col("seq") < 5000, F.col("seq")).otherwise(F.col("seq") + 10 ** 7))
    c = ordered.cuts(burst, ["k"], F.col("seq"), target=333)
    assert c.depth == 2 and max(r["count"] for r in c.slice(burst).groupBy(ordered.SLICE).count().collect()) <= 666
