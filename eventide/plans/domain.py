"""The behaviour jobs' record types, derived from the driver tables.

Each entity is built twice, side by side so they cannot drift: as a Spark
DataFrame (used by the registered queries) and as a SQL CTE (used by the
DuckDB oracles).  Only Catalyst-visible expressions are used, so filters and
column pruning reach the Parquet scan.

| entity         | from ``events``                                                       |
|----------------|-----------------------------------------------------------------------|
| user behaviour | item = k % 10, category = k div 10, ``view`` -> ``pv``                |
| sensor reading | id = 'sensor_' + user % 10, temperature = value, epoch-second stamp   |
| ad click       | ad = k % 2, province = nation name of user % 25                       |
| marketing      | channel = 'c' + user % 2, behaviour = event type                      |
| web log        | ip from user, GET for ``view`` else POST, url = '/p/' + k             |
| login          | ``error`` -> fail, everything else -> success                         |
| order / pay    | order = (user, ISO week), ``signup`` -> create, ``purchase`` -> pay   |
| receipts       | ``click`` rows, tx id = user                                          |

``k`` is the integer in ``props``.  ``seq`` = event_id is the arrival order;
``arrival`` is a deterministic disorder used by the late-data replays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions.time import epoch_seconds
from eventide.sources.tables import load_table

# Fixed parameters of the synthetic disorder (arrival = id + (id * 7919) % 50).
DISORDER_PRIME = 7919
DISORDER_SPAN = 50


def events(spark: SparkSession, sf: str) -> DataFrame:
    return load_table(spark, sf, "events")


def _k():
    return F.get_json_object("props", "$.k").cast("bigint")


def _arrival():
    return (F.col("event_id") + F.pmod(F.col("event_id") * DISORDER_PRIME, F.lit(DISORDER_SPAN))).alias("arrival")


K_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
ARRIVAL_SQL = f"(event_id + (event_id * {DISORDER_PRIME}) % {DISORDER_SPAN})"


def user_behavior(spark, sf) -> DataFrame:
    e = events(spark, sf)
    return e.select("user_id", (_k() % 10).alias("item_id"), (_k() / 10).cast("int").alias("category_id"),
                    F.when(F.col("event_type") == "view", F.lit("pv")).otherwise(F.col("event_type")).alias("behavior"),
                    "ts", F.col("event_id").alias("seq"))


def pageviews(spark, sf) -> DataFrame:
    """User behaviour restricted to ``pv``, filtered on the raw column first so
    the predicate reaches the Parquet scan (a filter on the derived behaviour
    column could not be pushed down)."""
    e = events(spark, sf).filter(F.col("event_type") == "view")
    return e.select("user_id", (_k() % 10).alias("item_id"), (_k() / 10).cast("int").alias("category_id"),
                    F.lit("pv").alias("behavior"), "ts", F.col("event_id").alias("seq"))


UB_SQL = f"""SELECT user_id, {K_SQL} % 10 AS item_id, CAST({K_SQL} // 10 AS INTEGER) AS category_id,
  CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END AS behavior, ts, event_id AS seq FROM events"""


def sensor(spark, sf) -> DataFrame:
    e = events(spark, sf)
    return e.select(F.concat(F.lit("sensor_"), (F.col("user_id") % 10).cast("string")).alias("id"),
                    "ts", epoch_seconds("ts").alias("ts_sec"), F.col("value").alias("temperature"),
                    F.col("event_id").alias("seq"))


SENSOR_SQL = """SELECT 'sensor_' || CAST(user_id % 10 AS VARCHAR) AS id, ts,
  CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS ts_sec, value AS temperature, event_id AS seq FROM events"""


def raw_clicks(spark, sf) -> DataFrame:
    """Ad clicks before their province is looked up."""
    return events(spark, sf).select("user_id", (_k() % 2).alias("ad_id"), "ts", F.col("event_id").alias("seq"))


def with_province(spark, sf, clicks: DataFrame) -> DataFrame:
    # nation is a fixed 25-row dimension: Catalyst broadcasts it from its file size
    nation = load_table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("province"))
    c = clicks.withColumn("_nk", (F.col("user_id") % 25).cast("int"))
    return c.join(nation, c["_nk"] == nation["n_nationkey"], "inner").drop("_nk", "n_nationkey")


def ad_click(spark, sf) -> DataFrame:
    return with_province(spark, sf, raw_clicks(spark, sf))


AD_SQL = f"""SELECT user_id, {K_SQL} % 2 AS ad_id, ts, event_id AS seq, n_name AS province
  FROM events JOIN nation ON n_nationkey = user_id % 25"""


def marketing(spark, sf) -> DataFrame:
    e = events(spark, sf)
    return e.select("user_id", F.concat(F.lit("c"), (F.col("user_id") % 2).cast("string")).alias("channel"),
                    F.col("event_type").alias("behavior"), "ts", F.col("event_id").alias("seq"))


MKT_SQL = """SELECT user_id, 'c' || CAST(user_id % 2 AS VARCHAR) AS channel, event_type AS behavior, ts,
  event_id AS seq FROM events"""


def weblog(spark, sf, get_only: bool = False) -> DataFrame:
    """Access-log rows; ``get_only`` filters on the raw column (GET is exactly
    ``view``) so the predicate reaches the Parquet scan."""
    e = events(spark, sf)
    if get_only:
        e = e.filter(F.col("event_type") == "view")
    ip = F.concat(F.lit("10.0."), F.floor(F.col("user_id") / 256).cast("string"), F.lit("."),
                  (F.col("user_id") % 256).cast("string"))
    return e.select(ip.alias("ip"), F.when(F.col("event_type") == "view", F.lit("GET")).otherwise(F.lit("POST")).alias("method"),
                    F.concat(F.lit("/p/"), _k().cast("string")).alias("url"), "ts",
                    F.col("event_id").alias("seq"), _arrival())


WEB_SQL = f"""SELECT '10.0.' || CAST(user_id // 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) AS ip,
  CASE WHEN event_type = 'view' THEN 'GET' ELSE 'POST' END AS method, '/p/' || CAST({K_SQL} AS VARCHAR) AS url,
  ts, event_id AS seq, {ARRIVAL_SQL} AS arrival FROM events"""


def login(spark, sf) -> DataFrame:
    e = events(spark, sf)
    return e.select("user_id", F.when(F.col("event_type") == "error", F.lit("fail")).otherwise(F.lit("success")).alias("event_type"),
                    "ts", F.col("event_id").alias("seq"))


LOGIN_SQL = """SELECT user_id, CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS event_type, ts,
  event_id AS seq FROM events"""


def order_events(spark, sf) -> DataFrame:
    e = events(spark, sf).filter(F.col("event_type").isin("signup", "purchase"))
    return e.select("user_id", F.date_trunc("week", "ts").cast("timestamp_ntz").alias("week_start"),
                    F.when(F.col("event_type") == "signup", F.lit("create")).otherwise(F.lit("pay")).alias("event_type"),
                    "ts", F.col("event_id").alias("seq"))


ORDER_SQL = """SELECT user_id, date_trunc('week', ts) AS week_start,
  CASE WHEN event_type = 'signup' THEN 'create' ELSE 'pay' END AS event_type, ts, event_id AS seq
  FROM events WHERE event_type IN ('signup', 'purchase')"""


def pays_and_receipts(spark, sf) -> tuple[DataFrame, DataFrame]:
    e = events(spark, sf)
    pays = e.filter(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("tx_id"), F.col("event_id").alias("pay_seq"), F.col("ts").alias("pay_ts"))
    receipts = e.filter(F.col("event_type") == "click").select(
        F.col("user_id").alias("tx_id"), F.col("event_id").alias("receipt_seq"), F.col("ts").alias("receipt_ts"))
    return pays, receipts


PAY_SQL = "SELECT user_id AS tx_id, event_id AS pay_seq, ts AS pay_ts FROM events WHERE event_type = 'purchase'"
RCPT_SQL = "SELECT user_id AS tx_id, event_id AS receipt_seq, ts AS receipt_ts FROM events WHERE event_type = 'click'"


def doc_lines_sql() -> str:
    return """SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS line_no, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)"""


def jvm_split_sql(col: str) -> str:
    """String.split(' ') semantics in SQL (trailing empties dropped)."""
    return (f"CASE WHEN {col} = '' THEN [''] WHEN rtrim({col}, ' ') = '' THEN []::VARCHAR[] "
            f"ELSE string_split(rtrim({col}, ' '), ' ') END")


def tokens_sql() -> str:
    return f"""SELECT doc_id, line_no, CAST(generate_subscripts(toks, 1) - 1 AS INTEGER) AS pos, unnest(toks) AS word
  FROM (SELECT doc_id, line_no, {jvm_split_sql('line')} AS toks FROM ({doc_lines_sql()}))"""


CTES = {
    "ub": UB_SQL, "sensor": SENSOR_SQL, "ad": AD_SQL, "mkt": MKT_SQL, "web": WEB_SQL, "login": LOGIN_SQL,
    "ord": ORDER_SQL, "pays": PAY_SQL, "rcpts": RCPT_SQL,
}


def with_ctes(body: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH name AS (...), ... body`` for the named entity CTEs."""
    parts = [f"{n} AS ({CTES[n]})" for n in names]
    parts += [f"{n} AS ({q})" for n, q in (extra or {}).items()]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body
