"""Benchmark decontamination by spaced-seed hashing.

A fixed mask reads some of the words of a window and ignores the others, so a seed
still meets its twin where ignored words were substituted.  Test seeds (every mask
of an item's length at each of its positions) and training seeds are joined on their
hash; a Bloom filter of fixed size, built from the test seeds, lets the training side
shuffle only seeds that may have a twin.  Around each hit the overlap is verified on its
diagonal: there must be ``min_words`` consecutive aligned words (the whole item, if it
is shorter) of which ``similarity`` are equal.  The masks of an item's length miss no
pattern of substitutions that this accepts (``missed`` enumerates them); masks that no
item of the benchmark uses are not searched for.

Words are compared in lower case without surrounding punctuation.  Training hits
travel as runs -- close-by hits of one document with the words around them -- so the
texts themselves are never shuffled.

Edge cases: null and empty texts match nothing; items of up to four words
are searched for as they are, items without words not at all; items of equal text count as the one of the
smallest id; rows with equal document ids are searched each for itself and reported
under that id; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.base import by_value, fresh, materialize, text_key, texts

# Fixed masks, ours: 1 reads a word, 0 ignores it.  By the words of the shortest overlap, complete at 80 % equal words.
LONG = ("1111111", "11101011001", "11011000111", "10110110101", "11011111")
MASKS = {1: ("1",), 2: ("11",), 3: ("111",), 4: ("1111",), 5: ("1111", "11011", "10111", "11101"), 6: ("1111", "11011"), 7: ("1111", "11011"),
         8: ("1111",), 9: ("1111",), **dict.fromkeys((10, 11, 12), ("11111", "111011", "11010011"))}
PATTERNS = 100_000  # substitution patterns that are enumerated at the most
FILTER_BITS = 26
GAP, MARGIN = 32, 64
PUNCTUATION = b".,;:!?\"'()[]{}"
KNOWN_WORDS = 200_000
ROWS = 256  # documents whose words are held side by side

_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63,
               0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


class WordHash(dict):
    """Raw word -> hash of its compared form; starts afresh when full."""

    def __missing__(self, raw: bytes) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        word = raw.decode("utf-8", "replace").lower().encode("utf-8", "replace").strip(PUNCTUATION)
        self[raw] = h = xxhash.xxh64_intdigest(word)
        return h


def word_hashes(text: bytes, known: WordHash) -> np.ndarray:
    words = text.split()
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def missed(masks: tuple[str, ...], n: int, most: int) -> list[tuple[int, ...]]:
    """The patterns of ``most`` substitutions in ``n`` words that no place of a mask avoids."""
    reads = [{o + i for i, c in enumerate(m) if c == "1"} for m in masks for o in range(n - len(m) + 1)]
    return [p for p in combinations(range(n), most) if not any(r.isdisjoint(p) for r in reads)]


def allowed(n: int, similarity: float) -> int:
    """Substitutions in ``n`` words that leave ``similarity`` of them equal."""
    return n - math.ceil(similarity * n - 1e-9)


@lru_cache(maxsize=1024)
def masks_of(n: int, similarity: float) -> tuple[str, ...]:
    """Masks that find every overlap of ``n`` words with ``similarity`` equal: the fixed ones, and where those miss a pattern (or
    there are too many to tell) a run of words, of which some place is always free of substitutions."""
    fixed, most = MASKS.get(n, LONG), allowed(n, similarity)
    if math.comb(n, most) <= PATTERNS and not missed(fixed, n, most):
        return fixed
    return (*fixed, "1" * max(1, min(len(_K), math.ceil((n - most) / (most + 1)))))


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """The seed hash of one mask at every position of a word sequence."""
    at = [i for i, c in enumerate(mask) if c == "1"]
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, int(mask, 2), np.uint64)
    for j, o in enumerate(at):
        h += words[o:o + n] * _K[j]
    h ^= h >> np.uint64(29)
    h *= _K[0]
    return h ^ (h >> np.uint64(32))


def _filter_places(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64((1 << FILTER_BITS) - 1)
    return (h & low).astype(np.int64), ((h >> np.uint64(64 - FILTER_BITS)) & low).astype(np.int64)


def item_words(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, words array of hashes), one row for each different text that has words."""
    d = texts(items, id_col, text_col).groupBy("_text").agg(F.min("_id").alias("_id"))
    kind = d.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for b in batches:
            words = [word_hashes(t.as_py(), known).view(np.int64) for t in b.column(1)]
            keep = [i for i, w in enumerate(words) if len(w)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep, pa.int64())), pa.array([words[i] for i in keep], pa.list_(pa.int64()))],
                                             names=["item_id", "item"])

    return d.select("_id", F.col("_text").cast("binary")).mapInArrow(run, f"item_id {kind}, item array<long>")


def item_seeds(items: DataFrame, min_words: int, similarity: float) -> DataFrame:
    """(h, item_id, item_pos, mask, whole) of every mask of an item's length at every position; ``whole`` seeds read all of an item."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ident, words in zip(b.column(0), b.column(1)):
                w = np.array(words.as_py(), np.int64).view(np.uint64)
                for m in masks_of(min(len(w), min_words), similarity):
                    h = seeds(w, m)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array([ident.as_py()] * len(h), b.column(0).type), pa.array(np.arange(len(h), dtype=np.int32)),
                         pa.array([m] * len(h), pa.string()), pa.array([m == "1" * len(w)] * len(h), pa.bool_())],
                        names=["h", "item_id", "item_pos", "mask", "whole"])

    return items.mapInArrow(run, f"h long, item_id {kind}, item_pos int, mask string, whole boolean")


def seed_filter(test: DataFrame) -> np.ndarray:
    """Bloom filter of the test seeds: 2**26 bits as bytes of 8, two places a seed.  Spark ORs the words; at
    most 2**20 of them reach the driver, whatever the benchmark."""
    low = (1 << FILTER_BITS) - 1
    places = test.select(F.explode(F.array(F.col("h").bitwiseAND(F.lit(low)),
                                           F.shiftrightunsigned("h", 64 - FILTER_BITS).bitwiseAND(F.lit(low)))).alias("p"))
    words = places.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(p & 63 AS INT))")).alias("bits"))
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for w, bits in words.toLocalIterator():
        out[w] = bits
    return out.view(np.uint8)


def training_runs(docs: DataFrame, bits: np.ndarray, masks: list[str], id_col: str, text_col: str) -> DataFrame:
    """(run, doc_id, hits array<(h, pos)>, words, words_at): close-by seeds that pass the filter, with MARGIN words around."""
    d = texts(docs, id_col, text_col)
    kind = d.schema["_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = WordHash(), shared.value
        for b in (whole.slice(i, ROWS) for whole in batches for i in range(0, whole.num_rows, ROWS)):
            each = [word_hashes(t.as_py(), known) for t in b.column(1)]
            sizes = np.array([len(w) for w in each], np.int64)
            words, ends = np.concatenate([*each, np.zeros(0, np.uint64)]), np.cumsum(sizes)
            doc = np.repeat(np.arange(len(each)), sizes)
            found_at, found_h = [], []
            for mask in masks:
                h = seeds(words, mask)
                p, q = _filter_places(h)
                at = np.flatnonzero((table[p >> 3] >> (p & 7).astype(np.uint8)) & (table[q >> 3] >> (q & 7).astype(np.uint8)) & 1)
                at = at[at + len(mask) <= ends[doc[at]]]
                found_at.append(at)
                found_h.append(h[at])
            at, h = np.concatenate([*found_at, np.zeros(0, np.int64)]), np.concatenate([*found_h, np.zeros(0, np.uint64)])
            order = np.argsort(at, kind="stable")
            at, h = at[order], h[order]
            new = np.flatnonzero(np.concatenate([[True], (np.diff(at) > GAP) | (doc[at[1:]] != doc[at[:-1]])])) if len(at) else np.zeros(0, np.int64)
            rows: dict[str, list] = {"doc": [], "hits": [], "words": [], "at": []}
            for lo, hi in zip(new, np.append(new[1:], len(at))):
                k = doc[at[lo]]
                base = ends[k] - sizes[k]
                first, last = max(base, at[lo] - MARGIN), min(ends[k], at[hi - 1] + max(map(len, masks)) + MARGIN)
                rows["doc"].append(k)
                rows["hits"].append([{"h": x, "pos": int(y)} for x, y in zip(h[lo:hi].view(np.int64).tolist(), at[lo:hi] - base)])
                rows["words"].append(words[first:last].view(np.int64))
                rows["at"].append(int(first - base))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows["doc"], pa.int64())), pa.array(rows["hits"], pa.list_(pa.struct([("h", pa.int64()), ("pos", pa.int32())]))),
                 pa.array(rows["words"], pa.list_(pa.int64())), pa.array(rows["at"], pa.int32())], names=["doc_id", "hits", "words", "words_at"])

    found = d.select("_id", F.col("_text").cast("binary")).mapInArrow(
        run, f"doc_id {kind}, hits array<struct<h:long,pos:int>>, words array<long>, words_at int")
    return found.withColumn("run", F.monotonically_increasing_id())


def overlap(words: np.ndarray, item: np.ndarray, shift: int, min_words: int, similarity: float) -> tuple[int, int, int] | None:
    """(aligned words, equal words, first place in ``words``) of the verified overlap on one diagonal, or None.

    ``shift`` is the place of the item's first word in ``words``; an overlap is what windows
    of min(min_words, item) words with enough equal ones cover."""
    lo, hi = max(0, shift), min(len(words), shift + len(item))
    n = min(min_words, len(item))
    if hi - lo < n:
        return None
    equal = (words[lo:hi] == item[lo - shift:hi - shift]).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(equal)])
    good = np.flatnonzero(total[n:] - total[:-n] >= similarity * n - 1e-9)
    if not len(good):
        return None
    cover = np.zeros(len(equal) + 1, np.int64)
    np.add.at(cover, good, 1)
    np.add.at(cover, good + n, -1)
    inside = np.cumsum(cover)[:-1] > 0
    return int(inside.sum()), int(equal[inside].sum()), int(lo + good[0])


def find_overlaps(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", min_words: int = 13, similarity: float = 0.8) -> DataFrame:
    """(doc_id, item_id, n_words, n_equal, doc_word): the longest verified overlap of each pair that has one."""
    items = materialize(item_words(benchmark, item_id_col, item_text_col))
    test = materialize(item_seeds(items, min_words, similarity))
    masks = sorted(r.mask for r in test.select("mask").distinct().collect())
    runs = materialize(training_runs(docs, seed_filter(test), masks, id_col, text_col))
    met = (runs.select("run", F.explode("hits").alias("hit")).select("run", "hit.h", "hit.pos").join(test, "h")
           .select("run", "item_id", "whole", (F.col("pos") - F.col("item_pos")).alias("diagonal")))
    # a whole item met as it is needs no second place in its run
    hits = met.groupBy("run", "item_id", F.when(~F.col("whole"), F.col("diagonal")).alias("_d")).agg(F.min("diagonal").alias("diagonal")).drop("_d")
    pairs = (hits.join(items, "item_id").join(runs.select(F.col("run").alias("_run"), "doc_id", "words", "words_at"), F.col("run") == F.col("_run"))
             .select("doc_id", "item_id", "words", "item", (F.col("diagonal") - F.col("words_at")).alias("shift"), "words_at"))
    kinds = [pairs.schema[c].dataType.simpleString() for c in ("doc_id", "item_id")]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, out = [], []
            for k, (w, i, s, at) in enumerate(zip(b.column(2), b.column(3), b.column(4), b.column(5))):
                got = overlap(w.values.to_numpy(), i.values.to_numpy(), s.as_py(), min_words, similarity)
                if got:
                    keep.append(k)
                    out.append((got[0], got[1], got[2] + at.as_py()))
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows),
                                              *[pa.array([o[j] for o in out], pa.int64()) for j in range(3)]],
                                             names=["doc_id", "item_id", "n_words", "n_equal", "doc_word"])

    verified = pairs.mapInArrow(verify, f"doc_id {kinds[0]}, item_id {kinds[1]}, n_words long, n_equal long, doc_word long")
    best = F.max(F.struct("n_words", "n_equal", F.negative("doc_word").alias("_at")))
    return (verified.groupBy("doc_id", "item_id").agg(best.alias("b"))
            .select("doc_id", "item_id", "b.n_words", "b.n_equal", F.negative(F.col("b._at")).alias("doc_word")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **args) -> DataFrame:
    """``docs`` without the documents that overlap a benchmark item; all columns.

    An overlap depends on the text alone and travels by its hash, so rows without an id or of a repeated one go or stay by
    their own text; null and empty texts overlap nothing and stay."""
    own, listed = fresh(docs, "_text_key", "_listed")
    keyed = docs.select(text_key(F.col(text_col)).alias("doc_id"), F.col(text_col).alias("text"))
    bad = materialize(find_overlaps(keyed, benchmark, **args).select(F.col("doc_id").alias(listed)).distinct())
    return docs.withColumn(own, text_key(F.col(text_col))).join(bad, F.col(own) == F.col(listed), "left_anti").drop(own)


by_value(__name__)
