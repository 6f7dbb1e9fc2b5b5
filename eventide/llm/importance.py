"""Resampling towards a target distribution, with weights by bit-sliced aggregation.

Hashed word runs are counted over the corpus and over the target; a bucket's gain is the smoothed log ratio of the two in
thousandths, an integer.  The gains are stored as bit planes of their two's complement, one bit for each bucket.
A document's bucket counts become bit planes too: plane i holds bit i of every bucket's count.  The sum of count times gain over
all buckets is then the sum over pairs of planes of popcount(count plane i AND gain plane j) times 2**(i + j), the sign
plane counting negative: exact in integers, whatever the counts.

The draw is Gumbel top-k.  Rows are written with a number, range-partitioned by (drawable, score, id, number) and written
again with their place in their partition; partition sizes, one row for each partition, turn places into ranks.  No
window runs over more than one partition's rows.

Edge cases: null text has no features and weight 0; a null id is hashed as the bare seed and sorts after other ids of its
score; rows with equal ids are drawn each for itself; an empty target or corpus has count 0 everywhere; an empty table gives no
rows; further columns are not read; very long texts are counted in blocks of features.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.base import by_value, materialize, shuffle_width, texts

BUCKETS = 10_000
DOCS = 64  # documents whose planes are held at once
FEATURES = 1 << 18  # features whose buckets are held at once
# A-Z become a-z, every other ASCII character but digits and a-z becomes a space; bytes above 127 stay
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def buckets(text: bytes, ngram: tuple[int, int], size: int) -> tuple[int, Iterator[np.ndarray]]:
    """Number of words, and the buckets of all runs of ngram[0] to ngram[1] words, in blocks."""
    words = text.translate(WORDS).split()

    def blocks() -> Iterator[np.ndarray]:
        for n in range(ngram[0], ngram[1] + 1):
            for at in range(0, len(words) - n + 1, FEATURES):
                part = words[at:at + FEATURES + n - 1]
                runs = part if n == 1 else [b" ".join(part[i:i + n]) for i in range(len(part) - n + 1)]
                yield np.fromiter(map(zlib.crc32, runs), np.uint32, len(runs)) % size

    return len(words), blocks()


def bucket_counts(docs: DataFrame, text_col: str, ngram: tuple[int, int], size: int) -> np.ndarray:
    """Features of all texts by bucket: each task sends one count a bucket, Spark adds them up, ``size`` numbers reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            for t in b.column(0):
                for block in buckets(t.as_py(), ngram, size)[1]:
                    total += np.bincount(block, minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    d = docs.select(F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    out = np.zeros(size, np.int64)
    for r in d.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """floor(scale * ln of the smoothed ratio of target to corpus) by bucket."""
    size, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(scale * math.log((t + 1) * (s_all + size) / ((s + 1) * (t_all + size))))
                     for s, t in zip(corpus.astype(float).tolist(), target.astype(float).tolist())], dtype=np.int64)


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    size = bits.shape[-1]
    whole = np.zeros((*bits.shape[:-1], -(-size // 64) * 64), bool)
    whole[..., :size] = bits
    return np.packbits(whole, axis=-1, bitorder="little").view(np.uint64)


def gain_planes(gain: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Bit planes of the two's complement, and what a bit of each plane is worth; the last plane is the sign."""
    width = int(np.abs(gain).max(initial=0)).bit_length()
    planes = packed(np.array([(gain >> j) & 1 for j in range(width + 1)], dtype=bool))
    return planes, [1 << j for j in range(width)] + [-(1 << width)]


def totals(counts: np.ndarray, planes: np.ndarray, worth: list[int]) -> np.ndarray:
    """Sum of count times gain by row of ``counts``, from popcounts of ANDed planes."""
    out = np.zeros(len(counts), np.int64)
    for i in range(int(counts.max(initial=0)).bit_length()):
        own = packed((counts >> i) & 1 == 1)
        for plane, value in zip(planes, worth):
            out += (value << i) * np.bitwise_count(own & plane).sum(axis=1, dtype=np.int64)
    return out


def noise(seed: str, doc_id: str, scale: int = 1000) -> int:
    """floor of ``scale`` times a Gumbel variate, from the SHA-256 of seed and id."""
    h = int(hashlib.sha256((seed + doc_id).encode()).hexdigest()[:8], 16)
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


def weights(docs: DataFrame, gain: np.ndarray, *, id_col: str, text_col: str, ngram: tuple[int, int], seed: str) -> DataFrame:
    """(_id, n_words, n_features, weight, score) of every text."""
    size, (planes, worth) = len(gain), gain_planes(gain)
    d = texts(docs, id_col, text_col)
    kind = d.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_features, sums = [], np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            for at in range(0, b.num_rows, DOCS):
                counts = np.zeros((min(DOCS, b.num_rows - at), size), np.int64)
                for k in range(len(counts)):
                    n, blocks = buckets(b.column(2)[at + k].as_py(), ngram, size)
                    n_words.append(n)
                    for block in blocks:
                        counts[k] += np.bincount(block, minlength=size)
                n_features[at:at + DOCS] = counts.sum(axis=1)
                sums[at:at + DOCS] = totals(counts, planes, worth)
            weight = sums // np.maximum(n_features, 1)
            score = weight + np.array([noise(seed, i or "") for i in b.column(1).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, (np.array(n_words, np.int64), n_features, weight, score))],
                                             names=["_id", "n_words", "n_features", "weight", "score"])

    return (d.select("_id", F.col("_id").cast("string").alias("_name"), F.col("_text").cast("binary"))
            .mapInArrow(run, f"_id {kind}, n_words long, n_features long, weight long, score long"))


def resample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
             ngram: tuple[int, int] = (1, 1), size: int = BUCKETS, min_words: int = 20, percent: int = 10, seed: str = "2024:") -> DataFrame:
    """(id, n_features, weight, score, rank) of every document; rank (1, 2, ...) is set for the drawn ones: the highest scores
    among documents of at least ``min_words`` words, ``percent`` of these rounded down, ties to the smaller id."""
    gain = gains(bucket_counts(docs, text_col, ngram, size), bucket_counts(target, target_text_col, ngram, size))
    scored = weights(docs, gain, id_col=id_col, text_col=text_col, ngram=ngram, seed=seed)
    rows = materialize(scored.withColumn("_drawable", F.col("n_words") >= min_words).withColumn("_row", F.monotonically_increasing_id()))
    order = [F.col("_drawable").desc(), F.col("score").desc(), F.col("_id").asc_nulls_last(), F.col("_row").asc()]
    # ids of a partition's rows count up from its number times 2**33
    dealt = rows.repartitionByRange(shuffle_width(rows), *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    dealt = materialize(dealt.withColumn("_part", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))))
    # one row for each partition
    parts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("_drawable"), 1)).alias("drawable"))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"),
                         F.floor(F.sum("drawable").over(every) * F.lit(percent) / F.lit(100)).cast("long").alias("_draw"))
    rank = F.col("_before") + F.col("_at") + 1
    return dealt.join(F.broadcast(parts), "_part").select(
        F.col("_id").alias(id_col), "n_features", "weight", "score", F.when(F.col("_drawable") & (rank <= F.col("_draw")), rank).alias("rank"))


def oracle(size: int = BUCKETS, min_words: int = 20, percent: int = 10, seed: str = "2024:") -> str:
    """The same draw in DuckDB SQL: CRC-32 by its polynomial over the distinct words, counts joined to gains."""
    step = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"
    table = "range(256)"
    for _ in range(8):
        table = f"list_transform({table}, lambda n: {step.format('n')})"
    return rf"""WITH t AS MATERIALIZED (SELECT list_transform({table}, lambda n: CAST(n AS BIGINT)) AS t),
w AS (SELECT 0 AS side, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents
  UNION ALL SELECT 1, NULL, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
n AS MATERIALIZED (SELECT side, doc_id, w, count(*) AS n FROM w GROUP BY ALL),
h AS (SELECT w, xor(list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode(w))), lambda i: CAST(('0x' || substr(hex(encode(w)), 2 * i + 1, 2)) AS BIGINT))),
  lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % {size} AS b FROM (SELECT DISTINCT w FROM n), t),
c AS (SELECT b, coalesce(sum(n) FILTER (side = 0), 0) AS s, coalesce(sum(n) FILTER (side = 1), 0) AS t FROM n JOIN h USING (w) GROUP BY b),
a AS (SELECT coalesce(sum(n) FILTER (side = 0), 0) AS s_all, coalesce(sum(n) FILTER (side = 1), 0) AS t_all FROM n),
g AS (SELECT b, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(s_all + {size} AS DOUBLE) / (CAST(s + 1 AS DOUBLE) * CAST(t_all + {size} AS DOUBLE)))) AS BIGINT) AS g FROM c, a),
d AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS f, CAST(sum(n * g) AS BIGINT) AS x FROM n JOIN h USING (w) JOIN g USING (b) WHERE side = 0 GROUP BY doc_id),
r AS (SELECT doc_id, coalesce(f, 0) AS n_features, coalesce((x - ((x % f) + f) % f) // f, 0) AS weight, CAST('0x' || substr(sha256('{seed}' || doc_id), 1, 8) AS BIGINT) AS h
  FROM documents LEFT JOIN d USING (doc_id)),
k AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM r),
o AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM k WHERE n_features >= {min_words})
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= {percent} * n // 100 THEN rank END AS rank FROM k LEFT JOIN o USING (doc_id)"""


by_value(__name__)
