"""Best-fit packing of tokenised documents into sequences of a fixed number of tokens.

Best-fit decreasing treats documents of one length alike, so the whole placement
follows from how many pieces of each length there are: a histogram of at most
``capacity`` rows.  Open bins are kept as ranges of equal remaining capacity, a
segment tree over the capacities finds the tightest that fits in logarithmic time, and
a range takes as many equal pieces as it can at once.  The result -- runs of ranks of a
length and where they go -- has a size that the capacity bounds, whatever the corpus;
each task then looks up the place of its pieces by (length, rank).

Ranks come from two levels: a number within (length, salt) and the count of the salts
before it, so a length that a third of all pieces share is spread over many groups.

Edge cases: null and empty texts are one token (the end mark); only pieces longer than
the capacity are cut; rows with equal ids are packed each for itself; an empty table
gives no sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.base import by_value, materialize, texts

ROWS = 128  # documents whose new chunks are tokenised together
RANK_GROUP = 4096


def tokenize(docs: DataFrame, tokenizer_path: str, *, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's ids, cut at ``capacity``.

    The tokenizer cuts at white space, so a chunk between spaces or line ends always
    has the same ids; a worker process tokenises a chunk once (see ``word_cache``) and joins the id bytes."""
    d = texts(docs, id_col, text_col)
    kind = d.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from eventide.llm.word_cache import learn

        end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity
        for whole in batches:
            for b in (whole.slice(i, ROWS) for i in range(0, whole.num_rows, ROWS)):
                out: dict[str, list] = {"at": [], "piece": [], "start": [], "length": [], "crc": []}
                words = [t.as_py().replace("\n", " ").split(" ") for t in b.column(1)]
                known = learn(tokenizer_path, set().union(*words))
                for k, ws in enumerate(words):
                    ids = b"".join(map(known.__getitem__, ws)) + end
                    for p, at in enumerate(range(0, len(ids), step)):
                        part = ids[at:at + step]
                        for name, v in zip(out, (k, p, at // 4, len(part) // 4, zlib.crc32(part))):
                            out[name].append(v)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(out["at"], pa.int64())), pa.array(out["piece"], pa.int32()), pa.array(out["start"], pa.int64()),
                     pa.array(out["length"], pa.int64()), pa.array(out["crc"], pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return d.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class CapacityTree:
    """Segment tree over remaining capacities: which of them has open bins."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.some = bytearray(2 * self.size)

    def set(self, at: int, value: bool) -> None:
        at += self.size
        self.some[at] = value
        while at > 1:
            at //= 2
            self.some[at] = self.some[2 * at] or self.some[2 * at + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` that has an open bin."""
        at = least + self.size
        if not self.some[at]:
            while at > 1 and not (at % 2 == 0 and self.some[at + 1]):
                at //= 2
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.some[2 * at] else 2 * at + 1
        return at - self.size


def plan(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Best-fit decreasing over (length -> pieces): rows (length, first rank, pieces per bin, first bin, offset) in order."""
    tree, opened, runs = CapacityTree(capacity), {}, []
    bins = 0

    def file(first: int, n: int, left: int) -> None:
        if n:
            opened.setdefault(left, []).append((first, n))
            tree.set(left, True)

    for length in sorted(histogram, reverse=True):
        todo, rank = histogram[length], 0
        while todo:
            left = tree.tightest(length)
            if left is None:
                left, per = capacity, capacity // length
                first, n = bins, -(-todo // per)
                bins += n
            else:
                first, n = opened[left].pop()
                if not opened[left]:
                    tree.set(left, False)
                per = left // length
            full = min(n, todo // per)
            rest = todo - full * per if full < n else 0  # the pieces of one bin more, which stays open
            runs.append((length, rank, per, first, capacity - left))
            used = full + (1 if rest else 0)
            file(first, full, left - per * length)
            file(first + full, 1 if rest else 0, left - rest * length)
            file(first + used, n - used, left)
            rank += full * per + rest
            todo -= full * per + rest
    return np.array(sorted(runs), dtype=np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` with sequence_id and offset; each sequence is filled without gaps from 0."""
    spark = pieces.sparkSession
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    runs = plan(histogram, capacity)
    shared = spark.sparkContext.broadcast((runs[:, 0] << 40 | runs[:, 1], runs))
    salts = max(1, sum(histogram.values()) // RANK_GROUP)
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = Window.partitionBy("_length").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    base = (salted.groupBy(F.col("length").alias("_length"), F.col("_salt").alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))))
    own = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (salted.withColumn("_rank", F.row_number().over(own) - 1)
              .join(base, (F.col("length") == F.col("_length")) & (F.col("_salt") == F.col("_s")))
              .withColumn("_rank", F.col("_rank") + F.col("_before")))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        keys, table = shared.value
        run = table[np.searchsorted(keys, length.to_numpy() << 40 | rank.to_numpy(), "right") - 1]
        i = rank.to_numpy() - run[:, 1]
        return pd.DataFrame({"sequence_id": run[:, 3] + i // run[:, 2], "offset": run[:, 4] + i % run[:, 2] * run[:, 0]})

    return ranked.withColumn("_p", place("length", "_rank")).select(*pieces.columns, "_p.sequence_id", "_p.offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, *, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, cut and pack; the narrow piece table is written once and read by both later passes."""
    return pack(materialize(tokenize(docs, tokenizer_path, capacity=capacity, id_col=id_col, text_col=text_col)), capacity)


by_value(__name__)
