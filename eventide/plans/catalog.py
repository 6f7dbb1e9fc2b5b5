"""Registered queries over the driver tables and their DuckDB oracles.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs one operator of the survey's
inventory on whole tables; ``ORACLES[name]`` is independent SQL over the same
Parquet views (plain window functions / correlated sub-queries, no slicing),
with identical column names.  Doubles that are sums of many terms are
rounded to 4 decimals on both sides so the comparison does not depend on
summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.time import epoch_micros
from eventide.operators import aggregate as agg
from eventide.operators import capping, late, ordered, reconcile, sequence, topk, transform
from eventide.operators.windows import UserAggregate, count_window, session_aggregate, window_aggregate, with_window
from eventide.plans import domain as dm
from eventide.sinks import files as sink_files
from eventide.sinks import records as sink_records
from eventide.session import scratch_path, sql_view
from eventide.sources.bus import bus_records_to_rows, lines_to_bus_records
from eventide.sources.parse import parse_access_log, parse_positional
from eventide.sources.text import document_lines, read_lines

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

HOUR = 3600
DAY = 86400


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# ------------------------------------------------------------ SQL helpers
def win_sql(src: str, size_s: int, slide_s: int | None = None, offset_s: int = 0, ts: str = "ts") -> str:
    """Every (row, window) pair of a tumbling/sliding window, in SQL."""
    slide_s = slide_s or size_s
    n = size_s // slide_s
    su, sz, off = slide_s * 1_000_000, size_s * 1_000_000, offset_s * 1_000_000
    return f"""SELECT *, make_timestamp(_ws) AS window_start, make_timestamp(_ws + {sz}) AS window_end FROM (
  SELECT *, ((epoch_us({ts}) - {off}) // {su}) * {su} + {off} - _i * {su} AS _ws
  FROM (SELECT *, unnest(range({n})) AS _i FROM ({src})))"""


def bloom_sql(col: str) -> str:
    s = f"CAST({col} AS VARCHAR)"
    return (f"CAST(list_sum(list_transform(range(length({s})), lambda i: "
            f"CAST(ascii(substr({s}, i + 1, 1)) AS HUGEINT) * CAST(pow(61, length({s}) - 1 - i) AS HUGEINT))) "
            f"% 536870912 AS BIGINT)")


def _sensor_lines(spark, sf):
    s = dm.sensor(spark, sf)
    return s.select(F.concat_ws(", ", "id", F.col("ts_sec").cast("string"),
                                F.col("temperature").cast("string")).alias("value"))


SENSOR_FIELDS = [("id", "string"), ("timestamp", "bigint"), ("temperature", "double")]
SENSOR_ROWS_SQL = dm.with_ctes("SELECT id, ts_sec AS timestamp, temperature FROM sensor", "sensor")


def encoded_lines(spark, sf):
    """Lines of the documents as text that carries its place: ``doc_id <tab> line_no <tab> line``."""
    lines = document_lines(dm.load_table(spark, sf, "documents"))
    return lines.select("doc_id", F.concat_ws("\t", F.col("doc_id").cast("string"), F.col("line_no").cast("string"), "line").alias("value"))


def decoded_lines(lines):
    parts = F.split(F.col("value"), "\t", 3)
    return lines.select(parts.getItem(0).cast("bigint").alias("doc_id"), parts.getItem(1).cast("int").alias("line_no"),
                        parts.getItem(2).alias("line"))


# ======================================================== S: sources / sinks
@query("s1_text_lines", dm.doc_lines_sql())
def s1_text_lines(spark, sf):
    """The lines as text files, written by Spark and read by the text reader."""
    path = scratch_path(spark, "s1-lines")
    encoded_lines(spark, sf).select("value").write.text(path)
    return decoded_lines(read_lines(spark, path))


@query("s3_parse_positional_trim", SENSOR_ROWS_SQL)
def s3_parse_positional_trim(spark, sf):
    return parse_positional(_sensor_lines(spark, sf), SENSOR_FIELDS, trim=True)


@query("s3b_parse_positional_untrimmed", dm.with_ctes(
    """SELECT user_id AS order_id, event_type, CASE WHEN event_type = 'pay' THEN 'tx' || CAST(seq AS VARCHAR) ELSE '' END AS tx_id,
  CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS timestamp, false AS _corrupt FROM ord""", "ord"))
def s3b_parse_positional_untrimmed(spark, sf):
    o = dm.order_events(spark, sf)
    line = F.concat_ws(",", F.col("user_id").cast("string"), "event_type",
                       F.when(F.col("event_type") == "pay", F.concat(F.lit("tx"), F.col("seq").cast("string"))).otherwise(F.lit("")),
                       F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"))
    return parse_positional(o.select(line.alias("value")),
                            [("order_id", "bigint"), ("event_type", "string"), ("tx_id", "string"), ("timestamp", "bigint")],
                            trim=False, on_error="quarantine")


@query("s4_access_log_parse", dm.with_ctes(
    "SELECT ip, date_trunc('second', ts) AS ts, method, url FROM web", "web"))
def s4_access_log_parse(spark, sf):
    w = dm.weblog(spark, sf)
    line = F.concat_ws(" ", "ip", F.lit("-"), F.lit("-"), F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"),
                       F.lit("+0000"), "method", "url")
    return parse_access_log(w.select(line.alias("value")))


@query("s6_bus_records_parse", SENSOR_ROWS_SQL)
def s6_bus_records_parse(spark, sf):
    return bus_records_to_rows(lines_to_bus_records(_sensor_lines(spark, sf)), SENSOR_FIELDS)


@query("s13_bus_publish_records",
       f"SELECT CAST(NULL AS VARCHAR) AS key, line AS value FROM ({dm.doc_lines_sql()})")
def s13_bus_publish_records(spark, sf):
    return lines_to_bus_records(document_lines(dm.load_table(spark, sf, "documents")), col="line")


SENSOR_PROJ_SQL = dm.with_ctes("SELECT id, ts_sec, temperature FROM sensor", "sensor")


@query("s7_csv_sink_roundtrip", SENSOR_PROJ_SQL)
def s7_csv_sink_roundtrip(spark, sf):
    path = scratch_path(spark, "s7-csv")
    sink_files.write_delimited(dm.sensor(spark, sf).select("id", "ts_sec", "temperature"), path)
    return spark.read.schema("id string, ts_sec bigint, temperature double").csv(path)


@query("s8_rolling_file_sink", dm.with_ctes(
    "SELECT id, ts_sec, temperature, strftime(ts, '%Y-%m-%d--%H') AS bucket FROM sensor", "sensor"))
def s8_rolling_file_sink(spark, sf):
    path = scratch_path(spark, "s8-rolling")
    s = dm.sensor(spark, sf)
    sink_files.write_rolling(s.select("id", "ts_sec", "temperature", "ts"), path, "ts")
    # the bucket folder is the only place the hour survives; ts itself is not written
    back = spark.read.schema("id string, ts_sec bigint, temperature double, ts timestamp_ntz, bucket string").csv(path)
    return back.select("id", "ts_sec", "temperature", "bucket")


@query("s9_bus_payload", dm.with_ctes(
    "SELECT CAST(NULL AS VARCHAR) AS key, id || CAST(temperature AS VARCHAR) AS value FROM sensor", "sensor"))
def s9_bus_payload(spark, sf):
    return sink_records.bus_payload(dm.sensor(spark, sf))


LATEST_SQL = dm.with_ctes("""SELECT id, temperature, ts_sec FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, seq DESC) AS rn FROM sensor) WHERE rn = 1""", "sensor")


@query("s10_latest_by_key", LATEST_SQL)
def s10_latest_by_key(spark, sf):
    return sink_records.latest_by_key(dm.sensor(spark, sf), ["id"], ["temperature", "ts_sec"], ["ts", "seq"])


@query("s11_hash_records", dm.with_ctes("""SELECT 'Sensor_temperature' AS hash_table, id AS field,
  CAST(temperature AS VARCHAR) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts DESC, seq DESC) AS rn FROM sensor) WHERE rn = 1""", "sensor"))
def s11_hash_records(spark, sf):
    latest = sink_records.latest_by_key(dm.sensor(spark, sf), ["id"], ["temperature"], ["ts", "seq"])
    return sink_records.hash_records(latest)


@query("s12_document_records", dm.with_ctes(
    """SELECT 'sensor' AS index, '{"id":"' || id || '","timestamp":"' || CAST(ts_sec AS VARCHAR)
  || '","temperature":"' || CAST(temperature AS VARCHAR) || '"}' AS doc FROM sensor""", "sensor"))
def s12_document_records(spark, sf):
    return sink_records.document_records(dm.sensor(spark, sf), fields=("id", "ts_sec", "temperature"),
                                         names=("id", "timestamp", "temperature"))


# ================================================== P / F / R / M: transforms
@query("p1_project", dm.with_ctes("SELECT id, temperature FROM sensor", "sensor"))
def p1_project(spark, sf):
    return dm.sensor(spark, sf).select("id", "temperature")


@query("p2_constant_key", dm.with_ctes("SELECT 'dummyKey' AS key, user_id FROM ub WHERE behavior = 'pv'", "ub"))
def p2_constant_key(spark, sf):
    ub = dm.pageviews(spark, sf)
    return transform.constant_key(ub, "user_id")


TOKENS_SQL = dm.tokens_sql()


@query("p3_flatmap_words", TOKENS_SQL)
def p3_flatmap_words(spark, sf):
    return agg.tokens(document_lines(dm.load_table(spark, sf, "documents")), keep=["doc_id", "line_no"])


@query("p4_pair_with_literal", dm.with_ctes("""SELECT seq, 0 AS pos, id AS out FROM sensor
  UNION ALL SELECT seq, 1 AS pos, 'value' AS out FROM sensor""", "sensor"))
def p4_pair_with_literal(spark, sf):
    return transform.pair_with_literal(dm.sensor(spark, sf), "id", keep=["seq"]).withColumn("pos", F.col("pos").cast("int"))


@query("p4_rich_flat_map", ORACLES["p4_pair_with_literal"])
def p4_rich_flat_map(spark, sf):
    """P4 through the per-partition lifecycle (open / flat-map / close) on Arrow batches."""
    return transform.rich_flat_map(dm.sensor(spark, sf).select("seq", "id"), transform.pair_rows_batch,
                                   "seq long, pos int, out string", open_fn=lambda: {"literal": "value"})


@query("f1_equal_filter", dm.with_ctes("SELECT user_id, item_id, ts FROM ub WHERE behavior = 'pv'", "ub"))
def f1_equal_filter(spark, sf):
    return dm.pageviews(spark, sf).select("user_id", "item_id", "ts")


@query("f2_not_equal_filter", dm.with_ctes("SELECT channel, behavior, ts FROM mkt WHERE behavior <> 'signup'", "mkt"))
def f2_not_equal_filter(spark, sf):
    return transform.not_equal_filter(dm.marketing(spark, sf), "behavior", "signup").select("channel", "behavior", "ts")


@query("f3_prefix_filter", dm.with_ctes("SELECT id, seq, temperature FROM sensor WHERE starts_with(id, 'sensor_1')", "sensor"))
def f3_prefix_filter(spark, sf):
    return transform.prefix_filter(dm.sensor(spark, sf), "id", "sensor_1").select("id", "seq", "temperature")


@query("f4_non_empty_filter", f"SELECT * FROM ({TOKENS_SQL}) WHERE length(word) > 0")
def f4_non_empty_filter(spark, sf):
    return transform.non_empty_filter(p3_flatmap_words(spark, sf), "word")


@query("f5_expr_select_filter", dm.with_ctes("SELECT id, ts_sec AS timestamp FROM sensor WHERE id = 'sensor_1'", "sensor"))
def f5_expr_select_filter(spark, sf):
    return transform.expr_select_filter(dm.sensor(spark, sf), ["id", "ts_sec AS timestamp"], "id = 'sensor_1'")


TAG_SQL = "CASE WHEN temperature > 30 THEN 'high' ELSE 'low' END"


@query("r1_split_select", dm.with_ctes(f"SELECT seq, id, temperature, {TAG_SQL} AS tag FROM sensor WHERE temperature > 30", "sensor"))
def r1_split_select(spark, sf):
    tagged = transform.tag_threshold(dm.sensor(spark, sf).select("seq", "id", "temperature"), "temperature", 30.0)
    return transform.select_tags(tagged, ["high"])


@query("r2_side_output", dm.with_ctes("""SELECT seq, id, temperature,
  CASE WHEN temperature >= 30 THEN 'side' ELSE 'main' END AS channel,
  CASE WHEN temperature >= 30 THEN 'warning: ' || id || ' temperature ' || CAST(temperature AS VARCHAR) || ' too high' END AS message
  FROM sensor""", "sensor"))
def r2_side_output(spark, sf):
    return transform.route_side_output(dm.sensor(spark, sf).select("seq", "id", "temperature"), "id", "temperature", 30.0)


@query("r3_temp_view_sql", dm.with_ctes(
    "SELECT id, count(*) AS cnt, max(temperature) AS max_temp FROM sensor GROUP BY id", "sensor"))
def r3_temp_view_sql(spark, sf):
    with sql_view(dm.sensor(spark, sf), "sensor_view") as view:
        return spark.sql(f"SELECT id, count(*) AS cnt, max(temperature) AS max_temp FROM {view} GROUP BY id")


@query("m1_union_all", dm.with_ctes(f"""SELECT seq, id, temperature, {TAG_SQL} AS tag FROM sensor WHERE temperature > 30
  UNION ALL SELECT seq, id, temperature, {TAG_SQL} AS tag FROM sensor WHERE temperature <= 30
  UNION ALL SELECT seq, id, temperature, {TAG_SQL} AS tag FROM sensor""", "sensor"))
def m1_union_all(spark, sf):
    tagged = transform.tag_threshold(dm.sensor(spark, sf).select("seq", "id", "temperature"), "temperature", 30.0)
    high, low = transform.select_tags(tagged, ["high"]), transform.select_tags(tagged, ["low"])
    return transform.union_all(high, low, transform.select_tags(tagged, ["high", "low"]))


@query("m2_co_map", dm.with_ctes("""SELECT id, temperature, 'high temp warning' AS message FROM sensor WHERE temperature > 30
  UNION ALL SELECT id, CAST(NULL AS DOUBLE) AS temperature, 'low temp' AS message FROM sensor WHERE temperature <= 30""", "sensor"))
def m2_co_map(spark, sf):
    tagged = transform.tag_threshold(dm.sensor(spark, sf), "temperature", 30.0)
    return transform.co_map(transform.select_tags(tagged, ["high"]), transform.select_tags(tagged, ["low"]),
                            "id", "temperature")


# ============================================================ A: aggregation
@query("a1_word_count", f"SELECT word, count(*) AS cnt FROM ({TOKENS_SQL}) GROUP BY word")
def a1_word_count(spark, sf):
    return agg.word_count(document_lines(dm.load_table(spark, sf, "documents")))


@query("a2_running_word_count", f"""SELECT doc_id, line_no, pos, word,
  count(*) OVER (PARTITION BY word ORDER BY doc_id, line_no, pos ROWS UNBOUNDED PRECEDING) AS cnt
  FROM ({TOKENS_SQL}) WHERE length(word) > 0""")
def a2_running_word_count(spark, sf):
    toks = agg.tokens(document_lines(dm.load_table(spark, sf, "documents")), keep=["doc_id", "line_no"],
                      drop_empty=True)
    return agg.running_word_count(toks, ["doc_id", "line_no", "pos"], F.col("doc_id"))


@query("a3_rolling_min_by", dm.with_ctes("""SELECT seq, id, m.v AS min_temperature, m.t AS min_ts, m.s AS min_seq FROM (
  SELECT seq, id, min(struct_pack(v := temperature, t := ts, s := seq))
    OVER (PARTITION BY id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS m FROM sensor)""", "sensor"))
def a3_rolling_min_by(spark, sf):
    out = agg.rolling_min_by(dm.sensor(spark, sf), "id", ["ts", "seq"], "temperature", epoch_micros("ts"))
    return out.select("seq", "id", "min_temperature", "min_ts", "min_seq")


@query("a4_rolling_reduce", dm.with_ctes("""SELECT seq, id,
  ts_sec + CASE WHEN row_number() OVER w > 1 THEN 1 ELSE 0 END AS red_ts, min(temperature) OVER w AS red_value
  FROM sensor WINDOW w AS (PARTITION BY id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)""", "sensor"))
def a4_rolling_reduce(spark, sf):
    out = agg.rolling_reduce(dm.sensor(spark, sf), "id", ["ts", "seq"], "ts_sec", "temperature", epoch_micros("ts"))
    return out.select("seq", "id", "red_ts", "red_value")


PV_SQL = "SELECT * FROM ub WHERE behavior = 'pv'"


@query("a5_window_count_sliding", dm.with_ctes(
    f"SELECT item_id, window_start, window_end, count(*) AS cnt FROM ({win_sql(PV_SQL, HOUR, 300)}) GROUP BY ALL", "ub"))
def a5_window_count_sliding(spark, sf):
    pv = dm.pageviews(spark, sf)
    return window_aggregate(pv, ["item_id"], "ts", "1 hour", "5 minutes")


@query("a6_window_avg", dm.with_ctes(f"""SELECT id, window_start, window_end, count(*) AS n,
  round(sum(temperature) / count(*), 4) AS avg_value FROM ({win_sql('SELECT * FROM sensor', HOUR)}) GROUP BY ALL""", "sensor"))
def a6_window_avg(spark, sf):
    out = agg.window_avg(dm.sensor(spark, sf), "id", "ts", "1 hour", "temperature")
    return out.withColumn("avg_value", F.round("avg_value", 4))


@query("a7_window_max_reduce", dm.with_ctes(f"""SELECT id, window_start, window_end, max(temperature) AS max_value,
  count(*) AS n, arg_max(ts_sec, seq) + CASE WHEN count(*) > 1 THEN 1 ELSE 0 END AS red_ts
  FROM ({win_sql('SELECT * FROM sensor', HOUR)}) GROUP BY ALL""", "sensor"))
def a7_window_max_reduce(spark, sf):
    return agg.window_max_reduce(dm.sensor(spark, sf), "id", "ts_sec", "ts", "1 hour", "temperature", "seq")


@query("a7b_window_min_by", dm.with_ctes(f"""SELECT id, window_start, window_end, m.v AS min_temperature,
  m.t AS min_ts, m.s AS min_seq FROM (SELECT id, window_start, window_end,
  min(struct_pack(v := temperature, t := ts, s := seq)) AS m FROM ({win_sql('SELECT * FROM sensor', HOUR)}) GROUP BY ALL)""", "sensor"))
def a7b_window_min_by(spark, sf):
    out = agg.window_min_by(dm.sensor(spark, sf), "id", "ts", "1 hour", "temperature", ["ts", "seq"])
    return out


@query("a8_full_window_count", dm.with_ctes(f"""SELECT channel, behavior, window_start, window_end, count(*) AS cnt
  FROM ({win_sql("SELECT * FROM mkt WHERE behavior <> 'signup'", HOUR, 300)}) GROUP BY ALL""", "mkt"))
def a8_full_window_count(spark, sf):
    m = transform.not_equal_filter(dm.marketing(spark, sf), "behavior", "signup")
    return window_aggregate(m, ["channel", "behavior"], "ts", "1 hour", "5 minutes")


@query("a8f_full_window_count_fine", dm.with_ctes(f"""SELECT window_start, window_end, count(*) AS cnt, min(seq) AS first_seq, max(seq) AS last_seq
  FROM ({win_sql("SELECT ts, seq FROM mkt WHERE behavior <> 'signup'", HOUR, 5)}) GROUP BY ALL""", "mkt"))
def a8f_full_window_count_fine(spark, sf):
    """All channels together, one hour every five seconds: 720 windows hold each row."""
    m = transform.not_equal_filter(dm.marketing(spark, sf), "behavior", "signup")
    return window_aggregate(m, [], "ts", "1 hour", "5 seconds", aggs=[("cnt", "count", F.lit(1)), ("first_seq", "min", F.col("seq")), ("last_seq", "max", F.col("seq"))])


UV_SLIDING_SQL = dm.with_ctes(f"""SELECT window_start, window_end, count(DISTINCT user_id) AS uv, true AS near
  FROM ({win_sql(PV_SQL, HOUR, 300)}) GROUP BY ALL""", "ub")


def near(estimate, exact):
    """Within a twelfth of the exact number: five times the error of 2**12 registers, and one for small windows."""
    return F.abs(F.col(estimate) - F.col(exact)) <= F.col(exact) / 12 + 1


@query("a9h_uv_sketch_sliding", UV_SLIDING_SQL)
def a9h_uv_sketch_sliding(spark, sf):
    """Unique visitors of sliding windows by merged sketches, held against exact counts."""
    pv = dm.pageviews(spark, sf)
    sketched = agg.sketch_distinct_per_window(pv, "ts", "1 hour", "5 minutes", "user_id")
    pairs = window_aggregate(pv, ["user_id"], "ts", "1 hour", "5 minutes")
    exact = pairs.groupBy("window_start", "window_end").agg(F.count(F.lit(1)).alias("uv"))
    return (exact.join(sketched.drop("uv_sketch"), ["window_start", "window_end"], "left")
            .select("window_start", "window_end", "uv", F.coalesce(near("uv_estimate", "uv"), F.lit(False)).alias("near")))


@query("a9_uv_exact", dm.with_ctes(
    f"SELECT window_start, window_end, count(DISTINCT user_id) AS uv FROM ({win_sql(PV_SQL, HOUR)}) GROUP BY ALL", "ub"))
def a9_uv_exact(spark, sf):
    pv = dm.pageviews(spark, sf)
    return agg.distinct_per_window(pv, "ts", "1 hour", "user_id")


@query("a10_uv_bloom", dm.with_ctes(f"""SELECT window_start, window_end, count(DISTINCT {bloom_sql('user_id')}) AS uv
  FROM ({win_sql(PV_SQL, HOUR)}) GROUP BY ALL""", "ub"))
def a10_uv_bloom(spark, sf):
    pv = dm.pageviews(spark, sf)
    return agg.bloom_distinct_per_window(pv, "ts", "1 hour", "user_id")


@query("a10b_uv_bloom_changelog", dm.with_ctes(f"""SELECT window_start, window_end, "offset", first_seq,
  count(*) OVER (PARTITION BY window_start ORDER BY first_seq ROWS UNBOUNDED PRECEDING) AS uv FROM (
  SELECT window_start, window_end, {bloom_sql('user_id')} AS "offset", min(seq) AS first_seq
  FROM ({win_sql(PV_SQL, HOUR)}) GROUP BY ALL)""", "ub"))
def a10b_uv_bloom_changelog(spark, sf):
    pv = dm.pageviews(spark, sf)
    return agg.bloom_changelog(pv, "ts", "1 hour", "user_id", "seq")


PV_COUNT_SQL = dm.with_ctes(
    f"SELECT window_start, window_end, count(*) AS pv FROM ({win_sql(PV_SQL, HOUR)}) GROUP BY ALL", "ub")


@query("a11_pv_salted", PV_COUNT_SQL)
def a11_pv_salted(spark, sf):
    pv = dm.pageviews(spark, sf)
    return agg.salted_window_count(pv, "ts", "1 hour", "seq")


@query("a12_sql_window_count", dm.with_ctes(
    f"SELECT item_id, window_end, count(*) AS cnt FROM ({win_sql(PV_SQL, HOUR, 300)}) GROUP BY ALL", "ub"))
def a12_sql_window_count(spark, sf):
    """Two-level SQL: counts per five-minute pane first, then each pane into its windows."""
    with sql_view(dm.pageviews(spark, sf), "pageviews") as view:
        return spark.sql(f"""SELECT item_id, window.end AS window_end, CAST(sum(cnt) AS BIGINT) AS cnt FROM (
            SELECT item_id, window(ts, '5 minutes').start AS pane, count(*) AS cnt FROM {view} GROUP BY item_id, window(ts, '5 minutes'))
            GROUP BY item_id, window(pane, '1 hour', '5 minutes')""")


@query("a13_sum_count_shortcut", PV_COUNT_SQL)
def a13_sum_count_shortcut(spark, sf):
    pv = dm.pageviews(spark, sf)
    salted = pv.withColumn("_salt", F.pmod(F.xxhash64("seq"), F.lit(16)))
    phase1 = (salted.groupBy(F.window("ts", "1 hour").alias("w"), "_salt").count()
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "count"))
    return agg.sum_count_shortcut(phase1, ["window_start", "window_end"])


# ================================================================ W: windows
@query("w1_tumbling_keyed", dm.with_ctes(f"""SELECT id, window_start, window_end, count(*) AS cnt,
  min(temperature) AS min_temp FROM ({win_sql('SELECT * FROM sensor', HOUR)}) GROUP BY ALL""", "sensor"))
def w1_tumbling_keyed(spark, sf):
    return window_aggregate(dm.sensor(spark, sf), ["id"], "ts", "1 hour",
                            aggs=[("cnt", "count", F.lit(1)), ("min_temp", "min", F.col("temperature"))])


@query("w2_sliding_keyed", dm.with_ctes(f"""SELECT id, window_start, window_end, count(*) AS cnt,
  max(temperature) AS max_temp FROM ({win_sql('SELECT * FROM sensor', HOUR, 300)}) GROUP BY ALL""", "sensor"))
def w2_sliding_keyed(spark, sf):
    return window_aggregate(dm.sensor(spark, sf), ["id"], "ts", "1 hour", "5 minutes",
                            aggs=[("cnt", "count", F.lit(1)), ("max_temp", "max", F.col("temperature"))])


@query("w3_tumbling_global",
       f"SELECT window_start, window_end, count(*) AS cnt FROM ({win_sql('SELECT * FROM events', HOUR)}) GROUP BY ALL")
def w3_tumbling_global(spark, sf):
    return window_aggregate(dm.events(spark, sf), [], "ts", "1 hour")


@query("w2u_sliding_user_aggregate", dm.with_ctes(f"""SELECT id, window_start, window_end, round(avg(temperature), 4) AS avg_temp,
  max(temperature) - min(temperature) AS spread FROM ({win_sql('SELECT * FROM sensor', HOUR, 300)}) GROUP BY ALL""", "sensor"))
def w2u_sliding_user_aggregate(spark, sf):
    """A user's own aggregates over sliding windows, pre-aggregated per pane like the built-in ones."""
    mean = UserAggregate({"s": F.sum("temperature"), "n": F.count("temperature")}, {"s": F.sum("s"), "n": F.sum("n")},
                         F.round(F.col("s") / F.col("n"), 4))
    spread = UserAggregate({"lo": F.min("temperature"), "hi": F.max("temperature")}, {"lo": F.min("lo"), "hi": F.max("hi")},
                           F.col("hi") - F.col("lo"))
    return window_aggregate(dm.sensor(spark, sf), ["id"], "ts", "1 hour", "5 minutes", aggs=[("avg_temp", mean), ("spread", spread)])


@query("w4_sliding_global",
       f"SELECT window_start, window_end, count(*) AS cnt FROM ({win_sql('SELECT * FROM events', 600, 120)}) GROUP BY ALL")
def w4_sliding_global(spark, sf):
    return window_aggregate(dm.events(spark, sf), [], "ts", "10 minutes", "2 minutes")


POS_SQL = "SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts, seq) AS pos FROM sensor"


@query("w5_count_window_sliding", dm.with_ctes("""SELECT e.id, e.pos AS end_pos, count(*) AS cnt,
  max(x.temperature) AS max_temp, min(x.temperature) AS min_temp
  FROM p e JOIN p x ON x.id = e.id AND x.pos > e.pos - 100 AND x.pos <= e.pos
  WHERE e.pos % 10 = 0 GROUP BY e.id, e.pos""", "sensor", extra={"p": POS_SQL}))
def w5_count_window_sliding(spark, sf):
    return count_window(dm.sensor(spark, sf), ["id"], ["ts", "seq"], 100, 10,
                        aggs=[("cnt", "count", F.lit(1)), ("max_temp", "max", F.col("temperature")),
                              ("min_temp", "min", F.col("temperature"))],
                        slice_col=epoch_micros("ts"))


@query("w6_count_window_tumbling", dm.with_ctes("""SELECT id, ((pos - 1) // 100 + 1) * 100 AS end_pos, count(*) AS cnt,
  max(temperature) AS max_temp FROM p GROUP BY ALL HAVING count(*) = 100""", "sensor", extra={"p": POS_SQL}))
def w6_count_window_tumbling(spark, sf):
    return count_window(dm.sensor(spark, sf), ["id"], ["ts", "seq"], 100,
                        aggs=[("cnt", "count", F.lit(1)), ("max_temp", "max", F.col("temperature"))],
                        slice_col=epoch_micros("ts"))


@query("w7_count_window_global", dm.with_ctes("""SELECT e.pos AS end_pos, count(*) AS cnt, max(x.temperature) AS max_temp
  FROM g e JOIN g x ON x.pos > e.pos - 100 AND x.pos <= e.pos WHERE e.pos % 10 = 0 GROUP BY e.pos""",
    "sensor", extra={"g": "SELECT *, row_number() OVER (ORDER BY ts, seq) AS pos FROM sensor"}))
def w7_count_window_global(spark, sf):
    return count_window(dm.sensor(spark, sf), [], ["ts", "seq"], 100, 10,
                        aggs=[("cnt", "count", F.lit(1)), ("max_temp", "max", F.col("temperature"))],
                        slice_col=epoch_micros("ts"))


@query("w8_session_window", """WITH s AS (SELECT user_id, ts, event_id,
  CASE WHEN lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL 1 HOUR THEN 1 ELSE 0 END AS st
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 g AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM s)
SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 1 HOUR AS window_end, count(*) AS cnt
FROM g GROUP BY user_id, sid""")
def w8_session_window(spark, sf):
    e = dm.events(spark, sf)
    return session_aggregate(e, ["user_id"], "ts", "1 hour", ["ts", "event_id"])


@query("w9_tumbling_offset", f"""SELECT window_start, window_end, count(*) AS cnt
  FROM ({win_sql('SELECT * FROM events', HOUR, HOUR, 600)}) GROUP BY ALL""")
def w9_tumbling_offset(spark, sf):
    return window_aggregate(dm.events(spark, sf), [], "ts", "1 hour", "1 hour", "10 minutes")


@query("w10_window_metadata", f"SELECT event_id, window_start, window_end FROM ({win_sql('SELECT * FROM events', HOUR, 1800)})")
def w10_window_metadata(spark, sf):
    return with_window(dm.events(spark, sf).select("event_id", "ts"), "ts", "1 hour", "30 minutes").drop("ts")


# ================================================================ K: top-N
TOPN_BODY = f"""SELECT window_end, item_id, cnt, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS rank FROM (
    SELECT item_id, window_end, count(*) AS cnt FROM ({win_sql(PV_SQL, HOUR, 300)}) GROUP BY ALL)) WHERE rank <= 5"""
TOPN_SQL = dm.with_ctes(TOPN_BODY, "ub")


def _item_counts(spark, sf):
    pv = dm.pageviews(spark, sf)
    return window_aggregate(pv, ["item_id"], "ts", "1 hour", "5 minutes")


@query("k1_topn_items_sliding", TOPN_SQL)
def k1_topn_items_sliding(spark, sf):
    ranked = topk.top_n(_item_counts(spark, sf), ["window_end"], [F.col("cnt").desc(), F.col("item_id")], 5)
    return ranked.select("window_end", "item_id", "cnt", "rank")


@query("k2_topn_items_sql", TOPN_SQL)
def k2_topn_items_sql(spark, sf):
    with sql_view(_item_counts(spark, sf), "agg") as view:
        return spark.sql(f"""SELECT window_end, item_id, cnt, rank FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS BIGINT) AS rank
            FROM {view}) WHERE rank <= 5""")


K3_SQL = dm.with_ctes(f"""SELECT window_end, url, cnt, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS rank FROM (
    SELECT url, window_end, count(*) AS cnt FROM ({win_sql("SELECT * FROM wm", HOUR, 300)})
    WHERE wm IS NULL OR wm < window_end + INTERVAL 60 SECOND GROUP BY ALL)) WHERE rank <= 5""", "web", extra={
    "wm": """SELECT *, max(ts) OVER (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
      - INTERVAL 3 SECOND AS wm FROM web WHERE method = 'GET'"""})


@query("k3_topn_pages_late", K3_SQL)
def k3_topn_pages_late(spark, sf):
    get = transform.equal_filter(dm.weblog(spark, sf, get_only=True), "method", "GET")
    counts = late.accepted_window_counts(get, ["url"], "ts", ["arrival", "seq"], "3 seconds", "1 hour", "5 minutes", lateness=60)
    ranked = topk.top_n(counts, ["window_end"], [F.col("cnt").desc(), F.col("url")], 5)
    return ranked.select("window_end", "url", "cnt", "rank")


@query("k4_ranking_report", dm.with_ctes("""SELECT window_end, 'window end: ' || CAST(epoch_ms(window_end) AS VARCHAR)
  || chr(10) || string_agg('NO.' || CAST(rank AS VARCHAR) || ': item ' || CAST(item_id AS VARCHAR)
  || ' count ' || CAST(cnt AS VARCHAR), chr(10) ORDER BY rank) AS report FROM topn GROUP BY window_end""",
    "ub", extra={"topn": TOPN_BODY}))
def k4_ranking_report(spark, sf):
    ranked = k1_topn_items_sliding(spark, sf)
    line = F.concat(F.lit("NO."), F.col("rank").cast("string"), F.lit(": item "), F.col("item_id").cast("string"),
                    F.lit(" count "), F.col("cnt").cast("string"))
    header = F.concat(F.lit("window end: "), F.unix_millis(F.col("window_end").cast("timestamp")).cast("string"))
    return topk.ranking_report(ranked, "window_end", "rank", line, header)


# ============================================================ Q: sequences
LOGIN_RUN = """SELECT *, event_type = 'fail' AS fail, count(*) FILTER (WHERE event_type = 'success')
  OVER (PARTITION BY user_id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS run FROM login"""


@query("q1_login_fail_check", dm.with_ctes("""SELECT f.user_id,
  (SELECT min(x.ts) FROM l x WHERE x.user_id = f.user_id AND x.fail AND x.run = f.run) AS first_fail_ts,
  f.ts AS fail_ts,
  (SELECT count(*) FROM l x WHERE x.user_id = f.user_id AND x.fail AND x.run = f.run
     AND x.ts <= f.ts + INTERVAL 6 HOUR) AS fail_count
FROM l f WHERE f.fail
  AND NOT EXISTS (SELECT 1 FROM l s WHERE s.user_id = f.user_id AND NOT s.fail
     AND (s.ts > f.ts OR (s.ts = f.ts AND s.seq > f.seq)) AND s.ts <= f.ts + INTERVAL 6 HOUR)
  AND (SELECT count(*) FROM l x WHERE x.user_id = f.user_id AND x.fail AND x.run = f.run
     AND x.ts <= f.ts + INTERVAL 6 HOUR) >= 2""", "login", extra={"l": LOGIN_RUN}))
def q1_login_fail_check(spark, sf):
    lg = dm.login(spark, sf)
    return sequence.repeated_failures(lg, "user_id", "ts", "seq", F.col("event_type") == "fail",
                                      n=2, check_after=6 * HOUR)


@query("q2_login_fail_pair", dm.with_ctes("""SELECT user_id, pts AS first_fail_ts, ts AS fail_ts FROM (
  SELECT *, lag(event_type) OVER w AS pt, lag(ts) OVER w AS pts FROM login WINDOW w AS (PARTITION BY user_id ORDER BY seq))
  WHERE event_type = 'fail' AND pt = 'fail' AND ts <= pts + INTERVAL 6 HOUR""", "login"))
def q2_login_fail_pair(spark, sf):
    lg = dm.login(spark, sf)
    return sequence.consecutive_pair(lg, "user_id", "ts", "seq", F.col("event_type") == "fail", within=6 * HOUR)


Q3_SQL_BODY = """SELECT user_id, t2 AS {a}_ts, t1 AS {b}_ts, ts AS {c}_ts FROM (
  SELECT *, lag(event_type, 1) OVER w AS e1, lag(event_type, 2) OVER w AS e2, lag(ts, 1) OVER w AS t1,
    lag(ts, 2) OVER w AS t2 FROM login WINDOW w AS (PARTITION BY user_id ORDER BY ts, seq))
  WHERE event_type = 'fail' AND e1 = 'fail' AND e2 = 'fail' AND ts < t2 + INTERVAL 1 DAY"""


@query("q3_login_fail_cep", dm.with_ctes(Q3_SQL_BODY.format(a="first", b="second", c="third"), "login"))
def q3_login_fail_cep(spark, sf):
    fail = F.col("event_type") == "fail"
    return sequence.strict_sequence(dm.login(spark, sf), "user_id", "ts", "seq",
                                    [("first", fail), ("second", fail), ("third", fail)], within=DAY)


@query("q3b_login_fail_named_steps", dm.with_ctes(Q3_SQL_BODY.format(a="begin", b="next", c="next2"), "login"))
def q3b_login_fail_named_steps(spark, sf):
    fail = F.col("event_type") == "fail"
    return sequence.strict_sequence(dm.login(spark, sf), "user_id", "ts", "seq",
                                    [("begin", fail), ("next", fail), ("next2", fail)], within=DAY)


Q45_SQL = """SELECT c.user_id, c.week_start, c.ts AS start_ts,
  CASE WHEN p.ts < c.ts + INTERVAL 1 DAY THEN p.ts END AS end_ts,
  CASE WHEN p.ts < c.ts + INTERVAL 1 DAY THEN 'paid' ELSE 'timeout' END AS outcome,
  CASE WHEN p.ts IS NULL OR p.ts >= c.ts + INTERVAL 1 DAY THEN c.ts + INTERVAL 1 DAY END AS timeout_at
FROM ord c LEFT JOIN LATERAL (
  SELECT x.ts FROM ord x WHERE x.user_id = c.user_id AND x.week_start = c.week_start AND x.event_type = 'pay'
    AND (x.ts > c.ts OR (x.ts = c.ts AND x.seq > c.seq)) ORDER BY x.ts, x.seq LIMIT 1) p ON true
WHERE c.event_type = 'create'"""


@query("q4_order_pay_followed_by", dm.with_ctes(
    f"SELECT user_id, week_start, start_ts, end_ts, outcome FROM ({Q45_SQL}) WHERE outcome = 'paid'", "ord"))
def q4_order_pay_followed_by(spark, sf):
    o = dm.order_events(spark, sf)
    return sequence.followed_by(o, ["user_id", "week_start"], "ts", "seq", F.col("event_type") == "create",
                                F.col("event_type") == "pay", within=DAY)


@query("q5_order_pay_timeout", dm.with_ctes(Q45_SQL, "ord"))
def q5_order_pay_timeout(spark, sf):
    o = dm.order_events(spark, sf)
    return sequence.followed_by(o, ["user_id", "week_start"], "ts", "seq", F.col("event_type") == "create",
                                F.col("event_type") == "pay", within=DAY, timeouts=True)


@query("q6_temp_jump", dm.with_ctes("""SELECT id, seq, prev_value, temperature FROM (
  SELECT *, lag(temperature) OVER (PARTITION BY id ORDER BY seq) AS prev_value FROM sensor)
  WHERE prev_value IS NOT NULL AND abs(temperature - prev_value) >= 10""", "sensor"))
def q6_temp_jump(spark, sf):
    out = sequence.jumps(dm.sensor(spark, sf), "id", ["seq"], "temperature", 10.0, F.col("seq"))
    return out.select("id", "seq", "prev_value", "temperature")


@query("q7_temp_rising", dm.with_ctes("""SELECT id, ts AS rise_start_ts, ts + INTERVAL 1 HOUR AS alert_ts FROM (
  SELECT *, temperature > p1 AND (p2 IS NULL OR p1 <= p2) AS st,
    (SELECT min(b.ts) FROM r b WHERE b.id = r.id AND NOT b.rise AND (b.ts > r.ts OR (b.ts = r.ts AND b.seq > r.seq))) AS nb
  FROM r) WHERE st AND (nb IS NULL OR nb > ts + INTERVAL 1 HOUR)""", "sensor", extra={
    "r": """SELECT *, coalesce(temperature > p1, false) AS rise FROM (SELECT *, lag(temperature, 1) OVER w AS p1,
      lag(temperature, 2) OVER w AS p2 FROM sensor WINDOW w AS (PARTITION BY id ORDER BY ts, seq))"""}))
def q7_temp_rising(spark, sf):
    return sequence.rising_alerts(dm.sensor(spark, sf), "id", "ts", "seq", "temperature", HOUR)


# ================================================================ B: capping
CLICK_POS_SQL = """SELECT *, CAST(ts + INTERVAL 8 HOUR AS DATE) AS day, row_number() OVER (
  PARTITION BY user_id, ad_id, CAST(ts + INTERVAL 8 HOUR AS DATE) ORDER BY ts, seq) AS click_no FROM ad"""


@query("b1_capped_clicks", dm.with_ctes(
    "SELECT user_id, ad_id, province, day, seq, ts, click_no FROM cp WHERE click_no <= 2", "ad", extra={"cp": CLICK_POS_SQL}))
def b1_capped_clicks(spark, sf):
    passed = capping.cap_clicks(dm.raw_clicks(spark, sf), ["user_id", "ad_id"], "ts", "seq", 2)
    return dm.with_province(spark, sf, passed).select("user_id", "ad_id", "province", "day", "seq", "ts", "click_no")


@query("b2_black_list", dm.with_ctes(
    "SELECT user_id, ad_id, day, 'black user: 2 times today' AS warning FROM cp WHERE click_no = 3", "ad",
    extra={"cp": CLICK_POS_SQL}))
def b2_black_list(spark, sf):
    return capping.black_list(dm.raw_clicks(spark, sf), ["user_id", "ad_id"], "ts", "seq", 2)


@query("b3_province_counts", dm.with_ctes(f"""SELECT province, window_start, window_end, count(*) AS cnt
  FROM ({win_sql('SELECT * FROM cp WHERE click_no <= 2', HOUR, 300)}) GROUP BY ALL""", "ad", extra={"cp": CLICK_POS_SQL}))
def b3_province_counts(spark, sf):
    passed = capping.cap_clicks(dm.raw_clicks(spark, sf), ["user_id", "ad_id"], "ts", "seq", 2)
    return window_aggregate(dm.with_province(spark, sf, passed), ["province"], "ts", "1 hour", "5 minutes")


# =========================================================== J: reconcile
J1_SQL = dm.with_ctes("""SELECT tx_id, coalesce(pay_seq, p_pay_seq) AS pay_seq, coalesce(pay_ts, p_pay_ts) AS pay_ts,
  coalesce(receipt_seq, p_receipt_seq) AS receipt_seq, coalesce(receipt_ts, p_receipt_ts) AS receipt_ts, 'match' AS outcome FROM placed WHERE n % 2 = 0
UNION ALL SELECT tx_id, pay_seq, pay_ts, receipt_seq, receipt_ts, CASE WHEN side = 0 THEN 'single-order' ELSE 'single-receipt' END
  FROM placed WHERE n % 2 = 1 AND n = last_n""", "pays", "rcpts", extra={
    "rows_": """SELECT tx_id, 0 AS side, pay_ts AS t, pay_seq AS s, pay_seq, pay_ts, CAST(NULL AS BIGINT) AS receipt_seq, CAST(NULL AS TIMESTAMP) AS receipt_ts FROM pays
  UNION ALL SELECT tx_id, 1, receipt_ts, receipt_seq, NULL, NULL, receipt_seq, receipt_ts FROM rcpts""",
    "linked": """SELECT *, lag(pay_seq) OVER w AS p_pay_seq, lag(pay_ts) OVER w AS p_pay_ts, lag(receipt_seq) OVER w AS p_receipt_seq, lag(receipt_ts) OVER w AS p_receipt_ts,
  CASE WHEN lag(side) OVER w <> side AND epoch_us(t) - epoch_us(lag(t) OVER w) <= 21600000000 THEN 0 ELSE 1 END AS head FROM rows_
  WINDOW w AS (PARTITION BY tx_id ORDER BY t, side, s)""",
    "chained": "SELECT *, sum(head) OVER (PARTITION BY tx_id ORDER BY t, side, s ROWS UNBOUNDED PRECEDING) AS chain FROM linked",
    "placed": """SELECT *, row_number() OVER (PARTITION BY tx_id, chain ORDER BY t, side, s) AS n, count(*) OVER (PARTITION BY tx_id, chain) AS last_n FROM chained"""})


@query("j1_tx_reconcile", J1_SQL)
def j1_tx_reconcile(spark, sf):
    pays, receipts = dm.pays_and_receipts(spark, sf)
    return reconcile.interval_reconcile(pays, receipts, "tx_id", bound_seconds=6 * HOUR,
                                        left_cols=["pay_seq", "pay_ts"], right_cols=["receipt_seq", "receipt_ts"],
                                        lts="pay_ts", rts="receipt_ts", lseq="pay_seq", rseq="receipt_seq")


@query("j2_order_outcome", dm.with_ctes("""SELECT user_id, week_start,
  CASE WHEN c IS NULL THEN 'data-not-found' WHEN p IS NULL THEN 'time-out'
       WHEN p < c + INTERVAL 1 DAY THEN 'paid' ELSE 'paid-but-timeout' END AS outcome, c AS create_ts, p AS pay_ts
FROM (SELECT user_id, week_start, min(ts) FILTER (WHERE event_type = 'create') AS c,
        min(ts) FILTER (WHERE event_type = 'pay') AS p FROM ord GROUP BY ALL)""", "ord"))
def j2_order_outcome(spark, sf):
    o = dm.order_events(spark, sf)
    return reconcile.order_outcomes(o, ["user_id", "week_start"], "ts", "seq", F.col("event_type") == "create",
                                    F.col("event_type") == "pay", limit_seconds=DAY)


# ============================================================ L: late data
WM_EVENTS = """SELECT event_id, ts, max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  - INTERVAL 1 HOUR AS wm FROM (SELECT *, """ + dm.ARRIVAL_SQL + " AS arrival FROM events)"


@query("l4_late_routing", f"""SELECT event_id, ts, wm, CASE WHEN wm IS NOT NULL AND wm >= window_end THEN 'late'
  ELSE 'on_time' END AS channel FROM ({win_sql(WM_EVENTS, HOUR)})""")
def l4_late_routing(spark, sf):
    e = dm.events(spark, sf).select("event_id", "ts", dm._arrival())
    return late.route_late(e, "ts", ["arrival", "event_id"], "1 hour", "1 hour").select("event_id", "ts", "wm", "channel")


@query("l3_allowed_lateness_counts", f"""SELECT window_start, window_end, count(*) AS cnt FROM ({win_sql(WM_EVENTS, HOUR)})
  WHERE wm IS NULL OR wm < window_end + INTERVAL 600 SECOND GROUP BY ALL""")
def l3_allowed_lateness_counts(spark, sf):
    e = dm.events(spark, sf).select("event_id", "ts", dm._arrival())
    rows = late.accepted_window_rows(e, "ts", ["arrival", "event_id"], "1 hour", "1 hour", lateness=600)
    return rows.groupBy("window_start", "window_end").agg(F.count(F.lit(1)).alias("cnt"))
