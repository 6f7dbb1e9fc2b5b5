"""One registered query per operator, over its whole table, in the columns that its contract names."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.llm import byte_bpe, centroids, decontaminate, importance, packing, quality, secret_scan, simhash, substring, suffix_array, toxicity, url_filter, warc
from eventide.llm.base import ORACLES, QUERIES, load_table, query

__all__ = ["ORACLES", "QUERIES"]


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    """Path of an installed public tokenizer file; packing takes it as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_url_filters")
def op1(spark, sf_dir):
    """Host, path, rule and verdict of every page's URL; the model judges what no rule fits."""
    pages = load_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "score")


def fold(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 3; 1 is held out."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3))


@query("op2_toxicity")
def op2(spark, sf_dir):
    """Toxicity score of every document, learnt from the labels of two thirds of the ids."""
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = load_table(spark, sf_dir, "labels").filter(fold() != 1)
    model = toxicity.fit(docs, labels)
    scored = docs.select("doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), toxicity.score_column(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query("op3_best_fit_packing")
def op3(spark, sf_dir):
    """Every document tokenised, cut at 4096 tokens and packed."""
    return packing.pack_documents(load_table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizer())


@query("op4_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT html, min(page_id) AS first FROM p GROUP BY html),
b AS (SELECT p.page_id, CAST(octet_length(encode(p.html)) AS BIGINT) AS payload_bytes, CAST(('0x' || sha1(p.html)) AS VARCHAR) AS h, first FROM p JOIN f USING (html))
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(h, 3 + 5 * CAST(i // 4 AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER) + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM b""")
def op4(spark, sf_dir):
    """Every page written as a WARC record and read back."""
    pages = load_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.archive_round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op5_benchmark_decontamination")
def op5(spark, sf_dir):
    """Documents that overlap a benchmark item, one row for each document and item: 13 words or the whole item, 80 % equal."""
    docs, benchmark = (load_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontaminate.find_overlaps(docs.select("doc_id", "text"), benchmark.select("item_id", "text"), min_words=13, similarity=0.8)


@query("op6_secret_scans", secret_scan.oracle())
def op6(spark, sf_dir):
    """Single finds and linked parts of every whole text."""
    return secret_scan.scan(load_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op7_simhash_near_dedup")
def op7(spark, sf_dir):
    """Fingerprint and component of every document: 4-word shingles, 4 bits."""
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, shingle=4, distance=4)


@query("op8_substring_dedup", r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
u AS (SELECT doc_id, len(w) AS n, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
k AS (SELECT doc_id, p, n, string_agg(x, ' ') OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS k FROM u),
f AS (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS n FROM k WHERE p + 19 <= n),
g AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM f WHERE n > 1),
r AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS m FROM u ANTI JOIN g USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(m, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)""")
def op8(spark, sf_dir):
    """Every document without the 20-word strings that start earlier."""
    return substring.dedup(load_table(spark, sf_dir, "documents").select("doc_id", "text"), window=20)


@query("op9_quality_rules")
def op9(spark, sf_dir):
    """Statistics and verdict of every document; small sources lean on their language, as if it were 50 rows of theirs."""
    judged = quality.judge(load_table(spark, sf_dir, "documents"), prior_rows=50)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("d2", 6).alias("d2"))


@query("op10_suffix_array_dedup", r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
k AS (SELECT doc_id, i, md5(b[i:i + 399]) AS h FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 398)) AS i FROM d)),
g AS (SELECT doc_id, i FROM k SEMI JOIN (SELECT h FROM k GROUP BY h HAVING count(*) > 1) m USING (h)),
x AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 0 ELSE 1 END AS new FROM g),
z AS (SELECT doc_id, min(i) AS a, max(i) + 399 AS e FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM x) GROUP BY doc_id, run),
q AS (SELECT *, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS pe FROM z),
r AS (SELECT doc_id, string_agg(hex(b[pe + 1:a - 1]), '' ORDER BY a) AS hx, max(e) AS last, count(*) AS spans, sum(e - a + 1) AS removed
  FROM q JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
  sha256(CASE WHEN hx IS NULL THEN b ELSE unhex(hx || hex(b[last + 1:])) END) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)""")
def op10(spark, sf_dir):
    """Every document without the bytes of 400-byte strings that start anywhere else too."""
    return suffix_array.dedup(load_table(spark, sf_dir, "documents").select("doc_id", "text"), length=400)


@query("op11_centroid_clustering", centroids.oracle())
def op11(spark, sf_dir):
    """Cluster, distance and inertia of every whole vector after three rounds of 16 integer centroids."""
    return centroids.with_inertia(*centroids.cluster(load_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")))


@query("op12_byte_bpe")
def op12(spark, sf_dir):
    """Digests of every text's ids and of the bytes they decode to."""
    from public_tokenizers import PATTERN

    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.encode(docs, public_tokenizer("byte_bpe_50k.tiktoken"), PATTERN, decoded=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op13_importance_resampling", importance.oracle())
def op13(spark, sf_dir):
    """Weight, score and rank of every document, resampled towards the benchmark."""
    docs, benchmark = (load_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return importance.resample(docs.select("doc_id", "text"), benchmark.select("text"))
