"""Keyed tables and logs that micro-batches maintain, resumable from what is stored.

A table is log-structured: a batch writes the rows it changed as one *delta* and then a *manifest*, a small file
that names the deltas which make up the table after it.  Readers merge the deltas, the newest row of a key
winning.  When newer deltas together are as large as the one before them, they are merged into one, so a row is
rewritten a logarithmic number of times, and what a batch writes follows the batch, not the table.

What came before batch ``b`` is always read from the newest manifest below ``b``, never from a variable: a batch that
runs again -- in the same process or after a restart from the checkpoint, whether it stopped before its delta,
between delta and manifest, or after -- overwrites its own files and sees the same past.  Manifests older than the
last two and deltas that none of these names are deleted.  File names and sizes are all that reaches the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from eventide.operators import late
from eventide.operators.capping import DAY_OFFSET_HOURS
from eventide.functions.time import local_day
from eventide.session import input_bytes
from eventide.sinks.records import latest_by_key


# ------------------------------------------------------------------- small files
def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _folders(spark: SparkSession, path: str) -> list[str]:
    p, fs = _fs(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def _numbered(names: Sequence[str], prefix: str) -> list[int]:
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix))


def _drop(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """The whole text or none of it under ``path``: written beside it and renamed."""
    p, fs = _fs(spark, path)
    beside, _ = _fs(spark, path + ".part")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(p, False)
    if not fs.rename(beside, p):
        raise OSError(f"cannot rename {path}.part")


def _read_text(spark: SparkSession, path: str) -> str:
    p, fs = _fs(spark, path)
    reader = spark.sparkContext._jvm.java.io.BufferedReader(spark.sparkContext._jvm.java.io.InputStreamReader(fs.open(p)))
    try:
        return reader.readLine()
    finally:
        reader.close()


# ------------------------------------------------------------------- the table
class LogTable:
    """``schema`` rows below ``root``, one per ``keys``; of several the one that is last in ``order`` counts."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: Sequence[str], order: Sequence[str]):
        self.spark, self.root, self.schema, self.keys, self.order = spark, root, schema, list(keys), list(order)

    def manifest(self, before: int | None = None) -> list[dict]:
        """The deltas (name, bytes), oldest first, that batches below ``before`` left (all batches: None)."""
        done = [v for v in _numbered([n for n in _folders(self.spark, self.root) if not n.endswith(".part")], "m=") if before is None or v < before]
        return json.loads(_read_text(self.spark, f"{self.root}/m={done[-1]}")) if done else []

    def _rows(self, deltas: Sequence[dict]) -> DataFrame:
        if not deltas:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/{d['name']}" for d in deltas])

    def newest(self, rows: DataFrame) -> DataFrame:
        values = [c for c in self.schema.names if c not in self.keys]
        return latest_by_key(rows, self.keys, values, self.order).select(*self.schema.names)

    def read(self, before: int | None = None) -> DataFrame:
        """The table as batches below ``before`` left it (all batches: None)."""
        return self.newest(self._rows(self.manifest(before)))

    def read_for(self, batch: DataFrame, before: int) -> DataFrame:
        """The rows of the keys that ``batch`` holds."""
        named = batch.select(*[F.col(k).alias(f"_b_{k}") for k in self.keys]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in self.keys]
        return self.newest(self._rows(self.manifest(before)).join(named, same, "left_semi"))

    def write(self, batch_id: int, rows: DataFrame, live: Column | None = None) -> None:
        """Add ``rows`` (one per key) as the delta of ``batch_id``, merging those before it where they have grown no larger.
        ``live`` says which rows such a merge still keeps (all): how a table forgets what is over."""
        past = self.manifest(batch_id)
        name = f"d={batch_id}"
        rows.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.root}/{name}")
        kept, size = list(past), input_bytes(self.spark, f"{self.root}/{name}")
        merged = []
        while kept and kept[-1]["bytes"] <= 2 * size:
            merged.insert(0, kept.pop())
            size += merged[0]["bytes"]
        if merged:
            whole = self.newest(self._rows([*merged, {"name": name}]))
            name = f"c={batch_id}"
            (whole if live is None else whole.filter(live)).write.mode("overwrite").parquet(f"{self.root}/{name}")
            size = input_bytes(self.spark, f"{self.root}/{name}")
        _write_text(self.spark, f"{self.root}/m={batch_id}", json.dumps([*kept, {"name": name, "bytes": size}]))
        self._forget(batch_id)

    def _forget(self, batch_id: int) -> None:
        """Drop manifests below the one before ``batch_id``'s, and deltas that no manifest left names.  A batch that runs
        again needs the manifest just below it."""
        names = _folders(self.spark, self.root)
        versions = _numbered([n for n in names if not n.endswith(".part")], "m=")
        stay = [v for v in versions if v >= max([v for v in versions if v < batch_id], default=batch_id)]
        named = {d["name"] for v in stay for d in json.loads(_read_text(self.spark, f"{self.root}/m={v}"))}
        for n in names:
            if (n.startswith("m=") and n not in {f"m={v}" for v in stay}) or (n[:2] in ("d=", "c=") and n not in named and int(n[2:]) <= batch_id):
                _drop(self.spark, f"{self.root}/{n}")


def _run(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, output_mode: str) -> StreamingQuery:
    """``step`` for every micro-batch, whose rows are computed once."""
    def once(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            step(batch, batch_id)
        finally:
            batch.unpersist()

    q = (stream.writeStream.outputMode(output_mode).foreachBatch(once).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


# ------------------------------------------------------------------- S10
def upsert_stream(stream: DataFrame, root: str, checkpoint: str, keys: Sequence[str], value_cols: Sequence[str],
                  order: Sequence[str] | None = None, *, output_mode: str = "append") -> LogTable:
    """S10 (stream): every micro-batch merged into the keyed table at ``root``: UPDATE when the key exists, INSERT
    otherwise, the later row in ``order`` winning.  Without ``order`` the later batch wins
    (for streams in update mode, which send a key's new value)."""
    one_per_key = order is None and output_mode == "update"  # what such a batch holds already; reading takes the newest in any case
    order = list(order or ["_batch"])
    typed = stream.withColumn("_batch", F.lit(0).cast("bigint"))
    table = LogTable(stream.sparkSession, root, typed.select(*dict.fromkeys([*keys, *value_cols, *order])).schema, keys, order)

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("_batch", F.lit(batch_id).cast("bigint")).select(*table.schema.names)
        table.write(batch_id, rows if one_per_key else table.newest(rows))

    _run(stream, step, checkpoint, output_mode)
    return table


# ------------------------------------------------------------------- R5
def retract_topn_stream(counts: DataFrame, root: str, checkpoint: str, window: str, key: str, n: int) -> DataFrame:
    """The top ``n`` of each window as a retract stream over update-mode (window, key, cnt).

    Counts only rise, so a key that is not in a window's top enters it only by a row of the batch: the stored
    state is the ``n`` rows of each window, and a batch ranks these with its own rows at or above the window's last count --
    never the keys that did not change.  Every change is logged as ``(false, old row)`` / ``(true, new row)``.
    Returns the log (batch, window, key, cnt, rank, flag)."""
    spark = counts.sparkSession
    state = counts.select(window, F.lit(0).cast("bigint").alias("rank"), key, "cnt", F.lit(0).cast("bigint").alias("_batch")).schema
    top, log = LogTable(spark, f"{root}/top", state, [window, "rank"], ["_batch"]), f"{root}/log"
    best = Window.partitionBy(window).orderBy(F.col("cnt").desc(), key)

    def step(batch: DataFrame, batch_id: int) -> None:
        windows = batch.select(window).distinct()
        before = top.newest(top._rows(top.manifest(batch_id)).join(windows, window, "left_semi")).select(window, key, "cnt", "rank").persist()
        try:
            least = before.filter(F.col("rank") == n).select(window, F.col("cnt").alias("_least"))
            new = (batch.select(window, key, "cnt").join(least, window, "left")
                   .filter(F.col("_least").isNull() | (F.col("cnt") >= F.col("_least"))).drop("_least"))
            rows = before.select(window, key, "cnt").unionByName(new).groupBy(window, key).agg(F.max("cnt").alias("cnt"))
            after = (rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)
                     .select(window, key, "cnt", F.col("rank").cast("bigint").alias("rank")).persist())
            fresh = after.exceptAll(before)
            (before.exceptAll(after).withColumn("flag", F.lit(False)).unionByName(fresh.withColumn("flag", F.lit(True)))
             .write.mode("overwrite").parquet(f"{log}/batch={batch_id}"))
            top.write(batch_id, fresh.withColumn("_batch", F.lit(batch_id).cast("bigint")))
            after.unpersist()
        finally:
            before.unpersist()

    _run(counts, step, checkpoint, "update")
    fields = counts.select(window, key, "cnt", F.lit(0).cast("bigint").alias("rank"), F.lit(True).alias("flag"), F.lit(0).alias("batch")).schema
    return spark.read.schema(fields).parquet(log)


# ------------------------------------------------------------------- B1-B3
def first_clicks_stream(clicks: DataFrame, root: str, checkpoint: str, keys: Sequence[str], ts: str, seq: str, limit: int, *,
                        day_offset_hours: int = DAY_OFFSET_HOURS) -> DataFrame:
    """B1/B2 (stream): the first ``limit`` clicks of every (keys, local day), with ``day`` and their number ``click_no``.

    A table holds how many clicks of a group have passed.  A micro-batch keeps the first ``limit`` of its own clicks of a
    group -- a group limit that Spark applies before the shuffle -- reads the stored counts of its groups, and
    passes what is left; all of it column expressions.  Groups whose day ended a day or more before the newest one
    seen are forgotten when deltas are merged.  Returns the passed clicks."""
    spark, out = clicks.sparkSession, f"{root}/passed"
    daily = lambda d: d.withColumn("day", local_day(ts, day_offset_hours))
    group = [*keys, "day"]
    counted = daily(clicks).select(*group, F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("_batch")).schema
    table = LogTable(spark, f"{root}/counts", counted, group, ["_batch"])
    first = Window.partitionBy(*group).orderBy(ts, seq)

    def step(batch: DataFrame, batch_id: int) -> None:
        mine = daily(batch).withColumn("_no", F.row_number().over(first)).filter(F.col("_no") <= limit)
        stored = table.read_for(mine, batch_id).select(*[F.col(c).alias(f"_s_{c}") for c in group], F.col("n").alias("_stored"))
        same = [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in group]
        passed = mine.join(stored, same, "left").withColumn("click_no", F.col("_no") + F.coalesce("_stored", F.lit(0).cast("bigint"))).filter(F.col("click_no") <= limit)
        passed = passed.drop("_no", "_stored", *[f"_s_{c}" for c in group]).persist()
        try:
            passed.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
            newest = batch.agg(F.max(local_day(ts, day_offset_hours))).first()[0]
            live = None if newest is None else F.col("day") >= F.date_sub(F.lit(newest), 1)
            table.write(batch_id, passed.groupBy(*group).agg(F.max("click_no").alias("n")).withColumn("_batch", F.lit(batch_id).cast("bigint")), live)
        finally:
            passed.unpersist()

    _run(clicks, step, checkpoint, "append")
    fields = daily(clicks).withColumn("click_no", F.lit(0).cast("bigint")).schema
    return spark.read.schema(fields).parquet(out)


# ------------------------------------------------------------------- L4
def route_late_stream(stream: DataFrame, root: str, checkpoint: str, ts: str, size, *, delay_seconds: int) -> DataFrame:
    """L4 (stream): each micro-batch is routed against the watermark that the batches before it left: the largest event
    time so far, minus the delay.  A ledger holds that time after every batch; a batch reads the entry below its
    own and writes its own, whole or not at all.  Returns the rows with ``wm`` and ``channel``."""
    spark = stream.sparkSession
    out, ledger = f"{root}/rows", f"{root}/ledger"

    def step(batch: DataFrame, batch_id: int) -> None:
        entries = _numbered([n for n in _folders(spark, ledger) if not n.endswith(".part")], "top=")
        below = max((v for v in entries if v < batch_id), default=None)
        seen = json.loads(_read_text(spark, f"{ledger}/top={below}")) if below is not None else None
        top = F.lit(None).cast("timestamp_ntz") if seen is None else F.timestamp_micros(F.lit(seen)).cast("timestamp_ntz")
        wm = top - F.expr(f"INTERVAL {int(delay_seconds)} SECONDS")
        late.route_by_watermark(batch.withColumn("wm", wm), ts, size).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        own = batch.agg(F.unix_micros(F.max(ts).cast("timestamp"))).first()[0]
        _write_text(spark, f"{ledger}/top={batch_id}", json.dumps(max((x for x in (seen, own) if x is not None), default=None)))
        for v in entries:
            if below is not None and v < below:
                _drop(spark, f"{ledger}/top={v}")

    _run(stream, step, checkpoint, "append")
    fields = late.route_by_watermark(stream.withColumn("wm", F.col(ts).cast("timestamp_ntz")), ts, size).schema
    return spark.read.schema(fields).parquet(out)
