"""Exact substring dedup over bytes with per-shard suffix arrays.

Which text a shard must hold is found first.  Of the ``length`` - GRAM + 1 byte grams that
a ``length``-byte string holds, the one with the smallest hash is its anchor; equal strings
have equal anchors, so a string whose anchor occurs nowhere else cannot repeat and is
never looked at again.  Around each repeated anchor the strings that it anchors
form one region of at most 2 * length - GRAM bytes, and regions meet by anchor.

Regions that are equal as a whole -- a 64-bit hash travels with each anchor -- settle each
other before any text is shipped; of each different region that shares its anchor with another
one, one copy is sent on and laid out in a shard.  Each shard gets a suffix array by Larsson-Sadakane refinement (ranks
double their depth, only groups that are still tied are sorted again) and its common
prefixes by Kasai's walk, run in lanes.  A group of regions that spans shards is
merged by binary search of one shard's strings in the other's array.  An anchor with more
than ``hot`` different regions would not fit shards of bounded size: their strings are
compared by 96-bit hashes spread over all tasks -- exact in the same way, and linear.

Rows are told apart by id and a hash of their text (``base.keyed_texts``).

Edge cases: null and empty texts have no bytes; documents are never joined; rows with
equal or null ids are documents of their own; further columns are not read; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.base import by_value, keyed_texts, materialize, shuffle_width
from eventide.llm.exchange import REPLY, SLICE, WINDOW_SLICE, Slices, answered, by_document, marked_windows, replies, slices, window_slices
from eventide.llm.substring import chunks, shrunk, unshrink

SHARD_BYTES = 1 << 19
LANES = 1024
CHUNK_BYTES = 1 << 19  # of text whose anchors are found at once
PLACE_BITS = 22
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


# ---------------------------------------------------------------- anchors
def gram_hashes(data: np.ndarray, n: int, salt: int = 1) -> np.ndarray:
    """Hash of every run of n bytes: runs of powers of two by doubling, joined as n's binary digits say."""
    m = len(data) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = (data.astype(np.uint64) + np.uint64(salt)) * _A
    h ^= h >> np.uint64(32)
    size, done, out = 1, 0, np.zeros(m, np.uint64)
    while True:
        if n & size:
            out *= _B
            out += h[done:done + m]
            done += size
        if 2 * size > n:
            break
        h = h[:-size] * (_B + np.uint64(2 * size)) + h[size:]
        h ^= h >> np.uint64(31)
        size *= 2
    out *= _A
    return out ^ (out >> np.uint64(32))


def gram_of(length: int) -> int:
    """Bytes of an anchor: the largest power of two up to two thirds of a string."""
    return 1 << max(0, (2 * length // 3).bit_length() - 1)


def sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every n consecutive values."""
    size = 1
    while 2 * size <= n:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (n - size)], x[n - size:]) if n > size else x


def anchors(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first, last): runs of string starts with one anchor, over texts laid end to end in less than 2**22 bytes.

    The anchor is the gram of the smallest hash, the rightmost of equal ones, so it depends on the string alone."""
    gram = gram_of(length)
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return np.zeros(0, np.uint64), none, none
    h = gram_hashes(data, gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    ranked = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))
    place = (low - (sliding_min(ranked, length - gram + 1) & low)).astype(np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    gone = np.zeros(len(place) + 1, np.int64)  # strings that would cross the end of a text
    np.add.at(gone, np.clip(np.maximum(ends - length + 1, starts), 0, len(place)), 1)
    np.add.at(gone, np.clip(ends, 0, len(place)), -1)
    valid = np.flatnonzero(np.cumsum(gone)[:-1] == 0)
    if not len(valid):
        return np.zeros(0, np.uint64), none, none
    p = place[valid]
    new = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
    key = h[p[new]] * _B  # smallest hashes lie close to zero; mixed again they fall on all key ranges alike
    key ^= key >> np.uint64(32)
    return key * _A, valid[new], valid[np.append(new[1:], len(valid)) - 1]


def text_anchors(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of one text of any size, in overlapping pieces at fixed places."""
    if len(text) <= CHUNK_BYTES:
        return anchors(np.frombuffer(text, np.uint8), np.array([len(text)]), length)
    parts = []
    for at in range(0, len(text) - length + 1, CHUNK_BYTES):
        piece = np.frombuffer(text, np.uint8, min(CHUNK_BYTES + length - 1, len(text) - at), at)
        h, a, b = anchors(piece, np.array([len(piece)]), length)
        parts.append((h, a + at, b + at))
    return tuple(np.concatenate(x) for x in zip(*parts))


def anchor_slices(docs: DataFrame, length: int, width: int, kind: str) -> DataFrame:
    """Every anchor as a located key: its place is the first string start that it serves, with how many there are and
    the hash of its region."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for ids, rows in chunks(batches, 1, 32 * CHUNK_BYTES):
            keys, doc, pos, n, region = [], [], [], [], []
            held, size = [], 0

            def found(h: np.ndarray, a: np.ndarray, b: np.ndarray, data: bytes) -> None:
                keys.append(h)
                n.append(b - a + 1)
                region.append(np.fromiter((digest(data[x:y]) for x, y in zip(a.tolist(), (b + length).tolist())), np.uint64, len(a)))

            def settle() -> None:
                nonlocal held, size
                if held:
                    ends = np.cumsum([len(t) for _, t in held])
                    data = b"".join(t for _, t in held)
                    h, a, b = anchors(np.frombuffer(data, np.uint8), ends, length)
                    found(h, a, b, data)
                    k = np.searchsorted(ends, a, "right")
                    doc.append(np.array([x for x, _ in held])[k])
                    pos.append(a - np.concatenate([[0], ends[:-1]])[k])
                held, size = [], 0

            for k, (t,) in enumerate(rows):
                if len(t) > CHUNK_BYTES:
                    h, a, b = text_anchors(t, length)
                    found(h, a, b, t)
                    doc.append(np.full(len(a), k))
                    pos.append(a)
                    continue
                if size + len(t) > CHUNK_BYTES:
                    settle()
                held.append((k, t))
                size += len(t)
            settle()
            if keys and sum(map(len, keys)):
                every = np.concatenate(keys)
                yield from slices(every, every, np.concatenate(doc), np.concatenate(pos), ids, width, np.concatenate(n), np.concatenate(region))

    return docs.select("_id", F.col("_text").cast("binary")).mapInArrow(run, SLICE.format(kind=kind))


SETTLED, SHIP, HOT = 1, 2, 4  # SETTLED is also what a task answers by itself


def region_replies(parts: DataFrame, kind: str, hot: int, width: int) -> DataFrame:
    """(doc_id, pos, n, flag arrays): anchors that occur elsewhere too.  SETTLED: an equal region is elsewhere, all its
    strings repeat.  SHIP: the one copy of a region that must be compared with others of its anchor; HOT: with
    more than ``hot`` others."""

    def reduce(table: pa.Table) -> pa.Table:
        if (done := answered(table, width)) is not None:
            return done
        s = Slices(table)
        at = np.flatnonzero(s.again)
        at = at[np.lexsort((s.text[at], s.located[at]))]
        key, text = s.located[at], s.text[at]
        new_key = np.concatenate([[True], key[1:] != key[:-1]]) if len(at) else np.zeros(0, bool)
        new = new_key | np.concatenate([[True], text[1:] != text[:-1]]) if len(at) else new_key
        copies = np.diff(np.append(np.flatnonzero(new), len(at)))[np.cumsum(new) - 1] if len(at) else np.zeros(0, np.int64)
        group = np.cumsum(new_key) - 1
        different = np.bincount(group, new, minlength=1)[group] if len(at) else np.zeros(0)
        flag = SETTLED * (copies > 1) + (SHIP + HOT * (different > hot)) * (new & (different > 1))
        keep = flag > 0
        return replies(s.ids, s.doc[at][keep], s.pos[at][keep], width, s.n[at][keep], flag[keep])

    return by_document(parts.groupBy("r").applyInArrow(reduce, REPLY.format(kind=kind)), kind)


# ---------------------------------------------------------------- suffix arrays
def _words(text: np.ndarray) -> np.ndarray:
    """The 8 bytes at every place as a big-endian number, zeros beyond the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.zeros(len(text), np.uint64)
    for j in range(8):
        out <<= np.uint64(8)
        out |= padded[j:j + len(text)]
    return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes in order: Larsson-Sadakane refinement from 8 bytes on, where a group's rank is the place of its first
    member and only groups still tied are sorted again."""
    n = len(text)
    key = _words(text)
    sa = np.argsort(key, kind="stable")
    key = key[sa]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[sa] = first
    open_ = np.flatnonzero(~new | np.append(~new[1:], False))
    done = 8
    while done < n and len(open_):
        suffix = sa[open_]
        ahead = suffix + done
        pair = (rank[suffix] << 32) | np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        order = np.argsort(pair, kind="stable")
        suffix, pair = suffix[order], pair[order]
        new = np.concatenate([[True], pair[1:] != pair[:-1]])
        sa[open_] = suffix
        rank[suffix] = np.maximum.accumulate(np.where(new, open_, 0))
        open_ = open_[~new | np.append(~new[1:], False)]
        done *= 2
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray, cap: int) -> np.ndarray:
    """lcp[k]: bytes that suffixes sa[k-1] and sa[k] share, up to ``cap``.  Kasai's walk in text order (a prefix shrinks by
    one at most from place to place), in lanes side by side: each turn every lane compares 8 bytes, and those that
    found their mismatch step on."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    words = np.concatenate([_words(text), np.zeros(cap + 16, np.uint64)])
    step = -(-n // max(1, min(LANES, n // 64)))
    i = np.arange(0, n, step)
    end = np.minimum(i + step, n)
    held = np.zeros(len(i), np.int64)
    plcp = np.zeros(n, np.int64)
    while len(i):
        j = before[i]
        most = np.where(j < 0, 0, np.minimum(cap, n - np.maximum(i, j)))
        held = np.minimum(held, most)
        diff = words[i + held] ^ words[j + held]
        top = np.frexp((diff & ~(diff >> np.uint64(1))).astype(np.float64))[1]  # the highest set bit, unrounded
        same = (64 - top) >> 3
        held = np.minimum(held + same, most)
        done = (same < 8) | (held == most)
        plcp[i[done]] = held[done]
        held = np.where(done, np.maximum(held - 1, 0), held)
        i = i + done
        if (i == end).any():
            go = i < end
            i, end, held = i[go], end[go], held[go]
    lcp = plcp[sa]
    lcp[0] = 0
    return lcp


class Shard:
    """Regions laid end to end, the string starts in them, and those starts in suffix order."""

    def __init__(self, regions: list[bytes], length: int):
        self.length = length
        self.text = np.frombuffer(b"".join(regions), np.uint8)
        sizes = np.array([len(x) for x in regions])
        self.at = np.cumsum(sizes) - sizes
        valid = np.zeros(len(self.text) + 1, np.int64)
        np.add.at(valid, self.at, 1)
        np.add.at(valid, self.at + sizes - length + 1, -1)
        valid = np.cumsum(valid)[:-1] > 0
        sa = suffix_array(self.text)
        lcp = common_prefixes(self.text, sa, length)
        in_order = np.flatnonzero(valid[sa])
        self.order = sa[in_order]
        self.words = np.concatenate([_words(self.text), np.zeros(length + 8, np.uint64)])
        self.marked = np.zeros(len(self.text), bool)
        if len(in_order) > 1:
            same = np.minimum.reduceat(lcp[:in_order[-1] + 1], in_order[:-1] + 1) >= length
            self.marked[self.order[1:][same]] = True
            self.marked[self.order[:-1][same]] = True

    def compare(self, mine: np.ndarray, other: "Shard", theirs: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 for each pair of strings, 8 bytes a step while any pair is equal."""
        out = np.zeros(len(mine), np.int64)
        go = np.arange(len(mine))
        for done in range(0, self.length, 8):
            a, b = self.words[mine[go] + done], other.words[theirs[go] + done]
            if self.length - done < 8:
                cut = np.uint64(8 * (8 - (self.length - done)))
                a, b = a >> cut, b >> cut
            out[go] = np.where(a < b, -1, np.where(a > b, 1, 0))
            go = go[a == b]
            if not len(go):
                break
        return out

    def merge(self, starts: np.ndarray, other: "Shard") -> None:
        """Mark the strings at ``starts`` that the other shard has too, and theirs: binary search in its order."""
        if not len(starts) or not len(other.order):
            return
        lo, hi = np.zeros(len(starts), np.int64), np.full(len(starts), len(other.order))
        while (go := np.flatnonzero(lo < hi)).size:
            mid = (lo[go] + hi[go]) // 2
            above = self.compare(starts[go], other, other.order[mid]) > 0
            lo[go] = np.where(above, mid + 1, lo[go])
            hi[go] = np.where(above, hi[go], mid)
        inside = np.flatnonzero(lo < len(other.order))
        equal = inside[self.compare(starts[inside], other, other.order[lo[inside]]) == 0]
        self.marked[starts[equal]] = True
        other.marked[other.order[lo[equal]]] = True  # its equals in that shard are marked already


def repeated_strings(keys: list[int], regions: list[bytes], length: int, shard_bytes: int = SHARD_BYTES) -> list[np.ndarray]:
    """For each different region (given with its anchor's key, in order of keys) the offsets of strings that other regions
    or other places of it have too."""
    out: list[np.ndarray] = []
    open_: list[tuple[list[int], Shard]] = []  # shards that share the last anchor, in order

    def close(shards: list) -> None:
        for own, shard in shards:
            out.extend(np.flatnonzero(shard.marked[a:a + len(regions[d])]) for d, a in zip(own, shard.at))

    held, size = [], 0
    for d in range(len(regions)):
        held.append(d)
        size += len(regions[d])
        if size < shard_bytes and d < len(regions) - 1:
            continue
        shard = Shard([regions[i] for i in held], length)
        if open_ and keys[open_[-1][0][-1]] != keys[held[0]]:
            close(open_)
            open_ = []
        shared = [k for k, i in enumerate(held) if open_ and keys[i] == keys[held[0]]]
        if shared:
            starts = np.concatenate([np.arange(shard.at[k], shard.at[k] + len(regions[held[k]]) - length + 1) for k in shared])
            for _, other in open_:
                shard.merge(starts, other)
        if keys[held[0]] != keys[held[-1]]:
            close(open_)
            open_ = []
        open_.append((held, shard))
        held, size = [], 0
    close(open_)
    return out


# ---------------------------------------------------------------- the operator
def region_rows(hit_docs: DataFrame, length: int, width: int, kind: str) -> DataFrame:
    """(r, key, region, at, hot, doc_id) of the anchors to ship, dealt by anchor (those of hot anchors by region)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, rows in chunks(batches, 1, 2 * CHUNK_BYTES):
            doc, key, text, place, busy = [], [], [], [], []
            for k, (z, pos, n, flag) in enumerate(rows):
                t = unshrink(z)
                for a, m, f in zip(pos, n, flag):
                    region = t[a:a + m - 1 + length]
                    if f & SHIP and len(region) == m - 1 + length:
                        h = anchors(np.frombuffer(region, np.uint8), np.array([len(region)]), length)[0]
                        doc.append(k)
                        key.append(int(h[0]))
                        text.append(region)
                        place.append(a)
                        busy.append(bool(f & HOT))
            dealt = [(xxhash.xxh64_intdigest(x) if b else h) * width >> 64 for h, x, b in zip(key, text, busy)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(dealt, pa.int32()), pa.array(np.array(key, np.uint64).view(np.int64)), pa.array(text, pa.binary()), pa.array(place, pa.int64()),
                 pa.array(busy, pa.bool_()), ids.take(pa.array(doc, pa.int64()))], names=["r", "key", "region", "at", "hot", "doc_id"])

    return hit_docs.select("doc_id", "z", "pos", "n", "flag").mapInArrow(run, f"r int, key long, region binary, at long, hot boolean, doc_id {kind}")


def shard_or_pass(rows: DataFrame, length: int, kind: str) -> DataFrame:
    """(doc_id, at, starts): offsets of repeated strings in the region at ``at``, as runs (first, count, ...); regions of hot
    anchors are passed on with their text."""

    def reduce(table: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        hot = table.filter(table.column("hot"))
        table = table.filter(pc.invert(table.column("hot"))).sort_by("key")
        keys, regions = table.column("key").to_pylist(), table.column("region").to_pylist()
        found = repeated_strings(keys, regions, length) if keys else []
        runs = [as_runs(x) for x in found]
        some = [i for i, r in enumerate(runs) if r]
        names = ["doc_id", "at", "starts", "region"]
        mine = table.take(pa.array(some, pa.int64()))
        mine = pa.table([mine.column("doc_id"), mine.column("at"), pa.array([runs[i] for i in some], pa.list_(pa.int64())), pa.nulls(len(some), pa.binary())], names=names)
        passed = pa.table([hot.column("doc_id"), hot.column("at"), pa.nulls(len(hot), pa.list_(pa.int64())), hot.column("region")], names=names)
        return pa.concat_tables([mine, passed])

    return rows.groupBy("r").applyInArrow(reduce, f"doc_id {kind}, at long, starts array<long>, region binary")


def as_runs(offsets: np.ndarray) -> list[int]:
    """first, count, first, count ... of runs of consecutive offsets."""
    if not len(offsets):
        return []
    cut = np.flatnonzero(np.concatenate([[True], np.diff(offsets) > 1]))
    return np.stack([offsets[cut], np.diff(np.append(cut, len(offsets)))], 1).reshape(-1).tolist()


def hot_marks(rows: DataFrame, length: int, width: int, kind: str) -> DataFrame:
    """(doc_id, pos array) of the repeated strings among different regions (doc_id, at, region) of hot anchors, by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, regions in chunks(batches, 1, CHUNK_BYTES):
            key, extra, doc, pos = [], [], [], []
            for k, (t, at) in enumerate(regions):
                data = np.frombuffer(t, np.uint8)
                key.append(gram_hashes(data, length))
                extra.append(gram_hashes(data, length, 77) >> np.uint64(32))
                doc.append(np.full(len(key[-1]), k))
                pos.append(at + np.arange(len(key[-1])))
            if key:
                yield from window_slices(np.concatenate(key), np.concatenate(extra), np.concatenate(doc), np.concatenate(pos), ids, width, keep_first=False)

    windows = rows.select("doc_id", "region", "at").mapInArrow(run, WINDOW_SLICE.format(kind=kind))
    return marked_windows(windows, kind, keep_first=False, width=width)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, hot: int = 4096, texts_out: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) per row; with ``texts_out`` also kept (binary).

    Removed is each byte that a ``length``-byte string covers which starts anywhere else, too."""
    d = keyed_texts(docs, id_col, text_col)
    kind, width = d.schema["_id"].dataType.simpleString(), shuffle_width(docs)
    hits = materialize(region_replies(anchor_slices(d, length, width, kind), kind, hot, width)).withColumnRenamed("doc_id", "_hit")
    small = shrunk(d, kind)
    shipping = hits.filter(F.exists("flag", lambda f: f.bitwiseAND(SHIP) > 0))
    rows = region_rows(small.join(shipping, small["doc_id"].eqNullSafe(F.col("_hit"))), length, width, kind)
    found = materialize(shard_or_pass(rows, length, kind))
    sharded = (found.filter("region IS NULL").groupBy(F.col("doc_id").alias("_shard"))
               .agg(F.collect_list("at").alias("at"), F.collect_list("starts").alias("starts")))
    hashed = hot_marks(found.filter("region IS NOT NULL"), length, width, kind).select(F.col("doc_id").alias("_hot"), F.col("pos").alias("hot"))
    joined = (small.join(hits, small["doc_id"].eqNullSafe(F.col("_hit")), "left")
              .join(sharded, small["doc_id"].eqNullSafe(F.col("_shard")), "left")
              .join(hashed, small["doc_id"].eqNullSafe(F.col("_hot")), "left")
              .select("doc_id", "z", "pos", "n", "flag", "at", "starts", "hot"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, gone, spans, digest, kept = [], [], [], [], []
            for z, pos, n, flag, at, starts, hot_ in zip(*b.columns[1:]):
                t = unshrink(z.as_py())
                total.append(len(t))
                first, count = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                if pos.is_valid:
                    settled = (flag.values.to_numpy() & SETTLED) > 0
                    first.append(pos.values.to_numpy()[settled])
                    count.append(n.values.to_numpy()[settled])
                if at.is_valid:
                    for a, s in zip(at.as_py(), starts.as_py()):
                        first.append(a + np.array(s[::2]))
                        count.append(np.array(s[1::2]))
                if hot_.is_valid:
                    first.append(hot_.values.to_numpy())
                    count.append(np.ones(len(first[-1]), np.int64))
                a, e = np.concatenate(first), np.concatenate(first) + np.concatenate(count) - 1 + length
                runs = 0
                if len(a):
                    cover = np.zeros(len(t) + 1, np.int64)
                    np.add.at(cover, a, 1)
                    np.add.at(cover, e, -1)
                    out = np.cumsum(cover)[:-1] > 0
                    runs = int(out[:1].sum() + (out[1:] & ~out[:-1]).sum())
                    t = np.frombuffer(t, np.uint8)[~out].tobytes()
                gone.append(total[-1] - len(t))
                spans.append(runs)
                digest.append(hashlib.sha256(t).hexdigest())
                kept.append(t if texts_out else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string()),
                 pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    out = joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out.select(F.col("doc_id.id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * texts_out)


by_value(__name__)
