"""Secret scans by multipart credential linking, with DataFrame functions only.

Single finds (``assign``, ``access``, ``hex``) stand for themselves.  Weak parts --
a client name, a bare 40-character token, an endpoint -- are reported only where
their complements lie within ``scope`` code points in the same document: a client
needs a secret, a bare token needs an identifier, an endpoint needs both.  The
interval join of parts runs as a sorted merge: within a document the nearest
complement to the left is the largest end so far, to the right the smallest start
to come, so hits never multiply into pairs.

Positions are code points: ``split`` gives the gaps between the matches that
``regexp_extract_all`` lists, and their running lengths are the offsets.

Edge cases: null and empty texts have no spans; rows with equal ids are separate
documents; a weak part that overlaps a single find is dropped; ties in start are
ordered by kind as listed in ``KINDS``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.base import fresh, materialize, text_key, texts

# Patterns of the single finds.  Runs are maximal, so a minimum length in the pattern drops
# exactly the matches that are too short; an assignment's value is measured after matching.
ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
          r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
# Weak parts, ours.
CLIENT = (r"""(?:[Uu][Ss][Ee][Rr](?:[Nn][Aa][Mm][Ee])?|[Ll][Oo][Gg][Ii][Nn]|[Cc][Ll][Ii][Ee][Nn][Tt]_?[Ii][Dd])["']?\x20*[:=]\x20*["']?"""
          r"""[A-Za-z0-9_.@-]+""")
BARE = r"[A-Za-z0-9+/]{40,}"
ENDPOINT = r"""[a-z][a-z0-9+]{1,15}://[A-Za-z0-9.:-]+"""
KINDS = ("assign", "access", "hex", "client", "bare", "endpoint")
PATTERNS = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, CLIENT, BARE, ENDPOINT)))
MIN_VALUE = 12
SCOPE = 256

_PART = "array<struct<kind:int,i:int,gap:bigint,len:bigint,ok:boolean>>"


def _parts(kind: int) -> Column:
    """The matches ``_m<kind>`` of one kind as (kind, i, gap before, length, long enough)."""
    m, pattern = F.col(f"_m{kind}"), PATTERNS[KINDS[kind]]
    ok = (lambda x: F.length(F.regexp_extract(x, pattern, 2)) >= MIN_VALUE) if kind == 0 else (lambda x: F.lit(True))
    indexed = F.transform(m, lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    zipped = F.zip_with(F.slice(F.split("_text", pattern, -1), F.lit(1), F.size(m)), indexed, lambda g, x: F.struct(
        F.lit(kind).alias("kind"), x["i"].alias("i"), F.length(g).cast("bigint").alias("gap"),
        F.length(x["x"]).cast("bigint").alias("len"), ok(x["x"]).alias("ok")))
    return F.when(F.size(m) > 0, zipped.cast(_PART)).otherwise(F.array().cast(_PART))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """(_id, spans): one row per document, spans an array of (start, kind, end) in order, end exclusive.

    One shuffle, of spans alone; no row is wider than the spans of one document."""
    d = texts(docs, id_col, text_col).withColumn("_row", F.monotonically_increasing_id())
    found = d.select("_row", "_id", "_text", *[F.regexp_extract_all("_text", F.lit(PATTERNS[k]), F.lit(0)).alias(f"_m{i}")
                                               for i, k in enumerate(KINDS)])
    parts = found.select("_row", "_id", F.explode_outer(F.concat(*[_parts(i) for i in range(len(KINDS))])).alias("p"))
    upto = Window.partitionBy("_row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = (parts.select("_row", "_id", "p.*").repartition("_row")
              .withColumn("end", F.sum(F.col("gap") + F.col("len")).over(upto))
              .withColumn("start", F.col("end") - F.col("len"))
              .withColumn("kind", F.when(F.col("ok"), F.col("kind"))))  # a match that failed stays as its document's row
    by_start = Window.partitionBy("_row").orderBy("start", "kind")
    left, right = by_start.rowsBetween(Window.unboundedPreceding, -1), by_start.rowsBetween(1, Window.unboundedFollowing)

    def near(*kinds: str, slack: int) -> Column:
        mine = F.col("kind").isin([KINDS.index(k) for k in kinds])
        to_left = F.max(F.when(mine, F.col("end"))).over(left) + slack
        to_right = F.min(F.when(mine, F.col("start"))).over(right) - slack
        return F.coalesce(to_left >= F.col("start"), F.lit(False)) | F.coalesce(to_right <= F.col("end"), F.lit(False))

    ident, secret = ("access", "client"), ("assign", "hex", "bare")
    linked = placed.select(
        "*", near(*ident, slack=scope).alias("_ident"), near(*secret, slack=scope).alias("_secret"),
        near("assign", "access", "hex", slack=-1).alias("_covered"))
    k = F.col("kind")
    keep = (F.when(k < 3, True).when(F.col("_covered"), False).when(k == 3, F.col("_secret"))
            .when(k == 4, F.col("_ident")).when(k == 5, F.col("_ident") & F.col("_secret")))
    span = F.when(keep, F.struct("start", "kind", "end"))
    return linked.groupBy("_row", "_id").agg(F.sort_array(F.collect_list(span)).alias("spans")).select("_id", "spans")


def may_hold(text: Column) -> Column:
    """False only where no span can be: a span is a single find, or needs a client and a bare token."""
    has = lambda kind: text.rlike(PATTERNS[kind])
    assigned = F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))
    return F.coalesce((assigned & has("assign")) | (F.contains(text, F.lit("AKIA")) & has("access")) | has("hex")
                      | (assigned & has("client") & has("bare")), F.lit(False))


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Per document: id, counts of single finds, digest of the single finds, and all spans."""
    spans = F.col("spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return find_spans(docs, id_col, text_col, scope).select(
        F.col("_id").alias(id_col), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(joined(F.filter(spans, lambda s: s["kind"] < 3)), 256).alias("base_sha256"), joined(spans).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[secret]", scope: int = SCOPE) -> DataFrame:
    """``docs`` with every span replaced by ``mask`` (overlapping spans by one); all columns kept, null texts stay null.

    A text that cannot hold a span stays where it is; only the others are scanned, dealt by key and joined to their
    spans, at every size alike.  Spans depend on the text alone and travel by its hash, so null and
    repeated ids mask no other row; empty texts and an empty table stay as they are."""
    key, of, spans = fresh(docs, "_text_key", "_spans_of", "_spans")
    some = docs.filter(may_hold(F.col(text_col)))
    keyed = some.select(text_key(F.col(text_col)).alias("_key"), F.col(text_col).alias("_text"))
    hits = materialize(find_spans(keyed, "_key", "_text", scope).filter(F.size("spans") > 0)
                       .groupBy(F.col("_id").alias(of)).agg(F.first("spans").alias(spans)))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def step(acc, s):
        new = s["start"] >= acc["at"]
        gap = F.when(new, F.concat(F.substr(F.col(text_col), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask))).otherwise(F.lit(""))
        return F.struct(F.concat(acc["out"], gap).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    masked = F.aggregate(F.sort_array(spans), start, step,
                         lambda acc: F.concat(acc["out"], F.substr(F.col(text_col), acc["at"] + 1)))
    joined = some.withColumn(key, text_key(F.col(text_col))).join(hits.hint("shuffle_hash"), F.col(key) == F.col(of), "left")
    done = joined.withColumn(text_col, F.when(F.col(spans).isNotNull(), masked).otherwise(F.col(text_col))).drop(key, of, spans)
    return docs.filter(~may_hold(F.col(text_col))).unionByName(done)


def oracle(table: str = "documents", id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> str:
    """The same finds in DuckDB SQL: nearest complements by correlated conditions on pairs, not by windows."""
    lit = lambda s: "'" + s.replace("'", "''") + "'"
    each = "\nUNION ALL ".join(f"""SELECT doc_id, {i} AS kind, m, g, len(m) AS n FROM (SELECT {id_col} AS doc_id,
  regexp_extract_all(coalesce({text_col}, ''), {lit(PATTERNS[k])}) AS m, regexp_split_to_array(coalesce({text_col}, ''), {lit(PATTERNS[k])}) AS g
  FROM {table}) WHERE len(m) > 0""" for i, k in enumerate(KINDS))
    near = lambda kinds, a, b: f"EXISTS (SELECT 1 FROM ok b WHERE b.doc_id = a.doc_id AND b.kind IN {kinds} AND (b.start_, b.kind) <> (a.start_, a.kind) AND b.end_ + {a} >= a.start_ AND b.start_ - {b} <= a.end_)"
    names = "CASE kind " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(KINDS)) + " END"
    return f"""WITH each AS ({each}),
placed AS (SELECT doc_id, kind, m[i] AS hit, CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS start_
  FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM each)),
ok AS (SELECT doc_id, kind, start_, start_ + length(hit) AS end_ FROM placed
  WHERE kind <> 0 OR length(regexp_extract(hit, {lit(ASSIGN)}, 2)) >= {MIN_VALUE}),
kept AS (SELECT *, {names} || ':' || start_ || ':' || end_ AS s FROM ok a WHERE kind < 3 OR (NOT {near('(0, 1, 2)', -1, -1)} AND (
  (kind = 3 AND {near('(0, 2, 4)', scope, scope)}) OR (kind = 4 AND {near('(1, 3)', scope, scope)})
  OR (kind = 5 AND {near('(0, 2, 4)', scope, scope)} AND {near('(1, 3)', scope, scope)})))),
per AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  coalesce(string_agg(s, ',' ORDER BY start_, kind) FILTER (kind < 3), '') AS base, string_agg(s, ',' ORDER BY start_, kind) AS spans FROM kept GROUP BY 1)
SELECT d.{id_col} AS doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM {table} d LEFT JOIN per p ON p.doc_id = d.{id_col}"""
