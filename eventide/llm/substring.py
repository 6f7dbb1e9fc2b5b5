"""Substring dedup by fixed-block anchors over words.

Reference blocks of ``window // 2`` words at multiples of that length are indexed, and
every rolling window of that length probes the index: a repeat of ``window`` words
always holds a whole block of either side, so a block that no other place equals
rules out all windows around it.  Hits are extended to every ``window``-word string
that holds a hit block; those are compared as wholes, and the runs of
them that started earlier are the maximal exact repeats, which go.

The whole corpus is shuffled as keys of about four bytes a word (see ``exchange``), its
texts once, compressed; windows are shipped only around hits.  Equality of words is
equality of 64-bit hashes for blocks and of 96 bits for windows.

Rows are told apart by id and a hash of their text (``base.keyed_texts``).

Edge cases: null and empty texts have no words; null ids come before all others; rows
with equal ids are documents of their own that do not precede each other; further columns are not
read; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.base import bounded_batches, by_value, keyed_texts, materialize, shuffle_width
from eventide.llm.exchange import SLICE, WINDOW_SLICE, marked_windows, repeated, slices, window_slices

CHUNK_BYTES = 12 << 20  # of text whose keys a task holds at once
KNOWN_WORDS = 200_000
_STEP, _OTHER, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xC2B2AE3D27D4EB4F)


class WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def hashes(words: list[bytes], known: WordHash) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def rolling(h: np.ndarray, n: int, step: np.uint64 = _STEP) -> np.ndarray:
    """Hash of every run of n words of a sequence."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = h[:m].copy()
    for j in range(1, n):
        out *= step
        out += h[j:j + m]
    out ^= out >> np.uint64(31)
    out *= _MIX
    return out ^ (out >> np.uint64(29))


def chunks(batches: Iterator[pa.RecordBatch], column: int, most: int = CHUNK_BYTES) -> Iterator[tuple[pa.Array, list[tuple]]]:
    """Consecutive rows as (ids, [row values from ``column`` on]), about ``most`` bytes at a time."""
    rows = ((b.column(0)[i:i + 1], [c[i] for c in b.columns[column:]]) for b in batches for i in range(b.num_rows))
    for part in bounded_batches(rows, lambda r: len(r[1][0].as_buffer() or b"") if r[1][0].is_valid else 0, most):
        yield pa.concat_arrays([p[0] for p in part]), [tuple(x.as_py() for x in p[1]) for p in part]


def block_slices(docs: DataFrame, block: int, width: int, kind: str) -> DataFrame:
    """Every rolling window as a probe key, every reference block as a located key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for ids, rows in chunks(batches, 1):
            each = [hashes(t.split(), known) for t, in rows]
            sizes = np.array([len(w) for w in each], np.int64)
            ends = np.cumsum(sizes)
            doc = np.repeat(np.arange(len(each)), sizes)
            place = np.arange(len(doc)) - (ends - sizes)[doc]
            keys = rolling(np.concatenate(each), block)
            inside = place[:len(keys)] + block <= sizes[doc[:len(keys)]]
            at = np.flatnonzero(inside & (place[:len(keys)] % block == 0))
            yield from slices(keys[inside], keys[at], doc[at], place[at], ids, width)

    return docs.select("_id", F.col("_text").cast("binary")).mapInArrow(run, SLICE.format(kind=kind))


def shrunk(docs: DataFrame, kind: str) -> DataFrame:
    """(doc_id, text zstd-compressed): what is shuffled of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([press.compress(t.as_py()) for t in b.column(1)], pa.binary())], names=["doc_id", "z"])

    return docs.select("_id", F.col("_text").cast("binary")).mapInArrow(run, f"doc_id {kind}, z binary")


def unshrink(z: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(z) if z else b""


def candidate_windows(hit_docs: DataFrame, window: int, width: int, kind: str) -> DataFrame:
    """The ``window``-word strings that hold a hit block, as slices."""
    block = window // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for ids, rows in chunks(batches, 1, CHUNK_BYTES // 4):
            key, extra, doc, pos = [], [], [], []
            for k, (z, blocks) in enumerate(rows):
                h = hashes(unshrink(z).split(), known)
                n = len(h) - window + 1
                if n <= 0:
                    continue
                cover = np.zeros(n + 1, np.int64)
                b = np.array(blocks, np.int64)
                b = b[b < len(h)]
                np.add.at(cover, np.clip(b - (window - block), 0, n), 1)
                np.add.at(cover, np.clip(b + 1, 0, n), -1)
                at = np.flatnonzero(np.cumsum(cover)[:-1] > 0)
                key.append(rolling(h, window)[at])
                extra.append(rolling(h, window, _OTHER)[at] >> np.uint64(32))
                doc.append(np.full(len(at), k))
                pos.append(at)
            if key:
                yield from window_slices(np.concatenate(key), np.concatenate(extra), np.concatenate(doc), np.concatenate(pos), ids, width, keep_first=True)

    return hit_docs.select("doc_id", "z", "pos").mapInArrow(run, WINDOW_SLICE.format(kind=kind))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, texts_out: bool = False) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) per row; with ``texts_out`` also kept_text.

    Removed is each word that a ``window``-word string covers whose words also start earlier."""
    if window < 2 or window % 2:
        raise ValueError("window must be an even number of words")
    d = keyed_texts(docs, id_col, text_col)
    kind, width = d.schema["_id"].dataType.simpleString(), shuffle_width(docs)
    hits = repeated(block_slices(d, window // 2, width, kind), kind, width).select(F.col("doc_id").alias("_hit"), "pos")
    small = shrunk(d, kind)
    hit_docs = small.join(hits, small["doc_id"].eqNullSafe(F.col("_hit")))
    marks = materialize(marked_windows(candidate_windows(hit_docs, window, width, kind), kind, keep_first=True, width=width))
    marks = marks.select(F.col("doc_id").alias("_hit"), "pos")
    joined = small.join(marks, small["doc_id"].eqNullSafe(F.col("_hit")), "left").select("doc_id", "z", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, gone, digest, kept = [], [], [], []
            for z, starts in zip(b.column(1), b.column(2)):
                words = unshrink(z.as_py()).split()
                total.append(len(words))
                if starts.is_valid and len(starts.values):
                    at = starts.values.to_numpy()
                    cover = np.zeros(len(words) + 1, np.int64)
                    at = at[at + window <= len(words)]
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + window, -1)
                    stay = np.flatnonzero(np.cumsum(cover)[:-1] == 0)
                    words = [words[i] for i in stay.tolist()]
                gone.append(total[-1] - len(words))
                text = b" ".join(words)
                digest.append(hashlib.sha256(text).hexdigest())
                kept.append(text.decode("utf-8", "replace") if texts_out else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest, pa.string()),
                                              pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    out = joined.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string")
    return out.select(F.col("doc_id.id").alias(id_col), "n_words", "n_removed", "kept_sha256", *["kept_text"] * texts_out)


by_value(__name__)
