"""Packed key exchange: which 64-bit keys occur more than once in the corpus, and where.

A map task sends its keys not as rows but as slices: for each of ``width`` ranges
of the key space one row with the distinct keys in order (as byte planes of their
differences, 48 bits deep, which the shuffle compresses to about four bytes each), which of
them occurred twice, and the located entries that point at them.  A key occurs once in
a task's slice however often the task met it, and what the task can settle by itself -- entries whose key it
met twice -- it answers at once: those rows go straight to their documents, and of a key that a third of all
documents share a reducer sees one entry for each task, not one for each document.  48 bits decide only
what is looked at again.  What a reducer finds goes back packed in the same way, by groups of document ids.

Answers travel with the slices, as ranges from ``width`` on, and pass the reducers untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

from eventide.llm.base import by_value

KEY_BITS = 48
SLICE = "r int, keys binary, twice binary, at binary, doc binary, pos binary, n binary, text binary, ids array<{kind}>"


def planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each value, byte plane after byte plane."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unplanes(data: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, :width] = raw.T
    return out.reshape(-1).view("<u8")


def id_list(ids: pa.Array, rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), ids.take(pa.array(rows, pa.int64())))


def concat_lists(arrays: list[pa.Array], kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays([a.cast(kind) for a in arrays]) if arrays else pa.array([], kind)


def slices(keys: np.ndarray, loc_key: np.ndarray, loc_doc: np.ndarray, loc_pos: np.ndarray, ids: pa.Array, width: int,
           loc_n: np.ndarray | None = None, loc_text: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """One row for each key range that has keys.  ``keys`` are all keys of the chunk, the located ones among them; a
    located entry may carry a count and a 64-bit hash of the text around it.

    Located entries whose key the chunk holds twice are answered (flag 1) and not sent on.  With text hashes these are the ones whose
    text the chunk holds twice, and one of each text is sent on all the same, to be held against other texts."""
    low = np.uint64(64 - KEY_BITS)
    uniq, counts = np.unique(keys >> low, return_counts=True)
    where = np.searchsorted(uniq, loc_key >> low)
    if loc_text is None:
        known = counts[where] > 1
        sent = ~known
    else:
        order = np.lexsort((loc_text, where))
        new = np.ones(len(order), bool)
        new[1:] = (where[order[1:]] != where[order[:-1]]) | (loc_text[order[1:]] != loc_text[order[:-1]])
        copies = np.diff(np.append(np.flatnonzero(new), len(order)))
        known, sent = np.zeros(len(order), bool), np.zeros(len(order), bool)
        known[order] = np.repeat(copies > 1, copies)
        sent[order] = new
    yield from answers(replies(ids, loc_doc[known], loc_pos[known], width, None if loc_n is None else loc_n[known], np.ones(known.sum(), np.uint64)), width)
    where, loc_doc, loc_pos = where[sent], loc_doc[sent], loc_pos[sent]
    loc_n, loc_text = (None if x is None else x[sent] for x in (loc_n, loc_text))
    order = np.argsort(where, kind="stable")
    where, loc_doc, loc_pos = where[order], loc_doc[order], loc_pos[order]
    loc_n = np.zeros(0, np.uint64) if loc_n is None else loc_n[order]
    loc_text = np.zeros(0, np.uint64) if loc_text is None else loc_text[order]
    edges = [(i << KEY_BITS) // width for i in range(1, width)]
    cut = np.concatenate([[0], np.searchsorted(uniq, np.array(edges, np.uint64)), [len(uniq)]]).astype(np.int64)
    loc_cut = np.searchsorted(where, cut)
    for r in range(width):
        lo, hi = cut[r], cut[r + 1]
        if lo == hi:
            continue
        a, b = loc_cut[r], loc_cut[r + 1]
        own = uniq[lo:hi]
        docs, doc = np.unique(loc_doc[a:b], return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r], pa.int32()), pa.array([planes(np.diff(own, prepend=np.uint64(0)), 6)], pa.binary()),
             pa.array([np.packbits(counts[lo:hi] > 1).tobytes()], pa.binary()),
             pa.array([planes((where[a:b] - lo).astype(np.uint64), 4)], pa.binary()), pa.array([planes(doc.astype(np.uint64), 4)], pa.binary()),
             pa.array([planes(loc_pos[a:b].astype(np.uint64), 5)], pa.binary()), pa.array([planes(loc_n[a:b].astype(np.uint64), 4)], pa.binary()),
             pa.array([planes(loc_text[a:b], 8)], pa.binary()), id_list(ids, docs)],
            names=["r", "keys", "twice", "at", "doc", "pos", "n", "text", "ids"])


def answers(parts: pa.Table, width: int) -> Iterator[pa.RecordBatch]:
    """Replies as rows among slices."""
    empty = pa.array([b""] * len(parts), pa.binary())
    yield from pa.table([pa.array(np.asarray(parts.column("q")) + width, pa.int32()), empty, parts.column("flag"), empty, parts.column("doc"), parts.column("pos"),
                         parts.column("n"), empty, parts.column("ids")], names=["r", "keys", "twice", "at", "doc", "pos", "n", "text", "ids"]).to_batches()


def answered(table: pa.Table, width: int) -> pa.Table | None:
    """The replies that a group of rows is, if it is no group of slices."""
    if table.column("r")[0].as_py() < width:
        return None
    return pa.table([pa.array(np.asarray(table.column("r")) - width, pa.int32()), *[table.column(c) for c in ("ids", "doc", "pos", "n", "twice")]],
                    names=["q", "ids", "doc", "pos", "n", "flag"])


class Slices:
    """The slices of one key range: distinct keys of each task and the located entries."""

    def __init__(self, table: pa.Table):
        keys, twice, loc, ids, base = [], [], [], [], 0
        parts: dict[str, list] = {"doc": [], "pos": [], "n": [], "text": []}
        for row in table.to_batches():
            for i in range(row.num_rows):
                get = lambda c: row.column(c)[i].as_py()  # noqa: B023, E731
                own = np.cumsum(unplanes(get("keys"), 6), dtype=np.uint64)
                keys.append(own)
                twice.append(np.unpackbits(np.frombuffer(get("twice"), np.uint8), count=len(own)))
                loc.append(own[unplanes(get("at"), 4).astype(np.int64)])
                for name, width in (("doc", 4), ("pos", 5), ("n", 4), ("text", 8)):
                    parts[name].append(unplanes(get(name), width))
                parts["doc"][-1] = parts["doc"][-1].astype(np.int64) + base
                ids.append(row.column("ids")[i].values)
                base += len(ids[-1])
        self.ids = concat_lists(ids, table.schema.field("ids").type.value_type)
        self.located = np.concatenate(loc)
        self.doc, self.pos, self.n, self.text = (np.concatenate(parts[c]) for c in ("doc", "pos", "n", "text"))
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")
        every, many = every[order], np.concatenate(twice)[order].astype(bool)
        many[1:] |= every[1:] == every[:-1]
        again = np.unique(every[many])
        place = np.minimum(np.searchsorted(again, self.located), max(len(again) - 1, 0))
        self.again = again[place] == self.located if len(again) else np.zeros(len(self.located), bool)


REPLY = "q int, ids array<{kind}>, doc binary, pos binary, n binary, flag binary"


def id_ranks(keys: pa.Array) -> np.ndarray:
    """Order of the ids of row keys, equal ids equal, null first."""
    encoded = pc.dictionary_encode(keys.flatten()[0])
    uniq = encoded.dictionary
    rank = np.empty(len(uniq), np.int64)
    rank[pc.sort_indices(uniq).to_numpy()] = np.arange(1, len(uniq) + 1)
    index = encoded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    return np.where(index < 0, 0, np.append(rank, 0)[index])


def row_numbers(keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(number of each row key in the order of id, then text; where each number is found first)."""
    rank, text = id_ranks(keys), keys.flatten()[1].to_numpy(zero_copy_only=False)
    order = np.lexsort((text, rank))
    new = np.ones(len(order), bool)
    new[1:] = (rank[order[1:]] != rank[order[:-1]]) | (text[order[1:]] != text[order[:-1]])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return out, order[new]


def key_ranges(keys: pa.Array, width: int) -> np.ndarray:
    """The one of ``width`` groups that a row key belongs to, the same in every task."""
    ids, texts = (c.to_pylist() for c in keys.flatten())
    return np.fromiter((xxhash.xxh64_intdigest(str(x).encode("utf-8", "surrogatepass"), t & 0xFFFFFFFF) % width for x, t in zip(ids, texts)), np.int64, len(keys))


def replies(ids: pa.Array, doc: np.ndarray, pos: np.ndarray, width: int, n: np.ndarray | None = None, flag: np.ndarray | None = None) -> pa.Table:
    """Marks for documents, packed: one row for each group of ids, however many documents and places it names."""
    used, doc = np.unique(doc, return_inverse=True)
    group = key_ranges(ids.take(pa.array(used, pa.int64())), width)[doc] if len(used) else doc
    order = np.lexsort((doc, group))
    none = np.zeros(len(doc), np.uint64)
    columns = {"pos": (pos, 5), "n": (none if n is None else n, 4), "flag": (none if flag is None else flag, 1)}
    group, doc = group[order], doc[order]
    cut = np.append(np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])), len(group)) if len(group) else np.zeros(1, np.int64)
    rows: dict[str, list] = {"q": [], "ids": [], "doc": [], "pos": [], "n": [], "flag": []}
    for lo, hi in zip(cut[:-1], cut[1:]):
        docs, inv = np.unique(doc[lo:hi], return_inverse=True)
        rows["q"].append(int(group[lo]))
        rows["ids"].append(ids.take(pa.array(used[docs], pa.int64())))
        rows["doc"].append(planes(inv.astype(np.uint64), 4))
        for name, (values, size) in columns.items():
            rows[name].append(planes(values[order[lo:hi]].astype(np.uint64), size))
    offsets = pa.array(np.cumsum([0] + [len(x) for x in rows["ids"]]), pa.int32())
    return pa.table([pa.array(rows["q"], pa.int32()), pa.ListArray.from_arrays(offsets, concat_lists(rows["ids"], ids.type)),
                     *[pa.array(rows[c], pa.binary()) for c in ("doc", "pos", "n", "flag")]], names=["q", "ids", "doc", "pos", "n", "flag"])


def by_document(parts: DataFrame, kind: str) -> DataFrame:
    """(doc_id, pos array, n array, flag array): the replies to each document in one row."""

    def gather(table: pa.Table) -> pa.Table:
        doc, columns, ids, base = [], {"pos": [], "n": [], "flag": []}, [], 0
        for row in table.to_batches():
            for i in range(row.num_rows):
                doc.append(unplanes(row.column("doc")[i].as_py(), 4).astype(np.int64) + base)
                for name, size in (("pos", 5), ("n", 4), ("flag", 1)):
                    columns[name].append(unplanes(row.column(name)[i].as_py(), size))
                ids.append(row.column("ids")[i].values)
                base += len(ids[-1])
        every = concat_lists(ids, table.schema.field("ids").type.value_type)
        number, first = row_numbers(every)
        own = number[np.concatenate(doc)]
        order = np.argsort(own, kind="stable")
        offsets = pa.array(np.searchsorted(own[order], np.arange(len(first) + 1)), pa.int32())
        return pa.table([every.take(pa.array(first, pa.int64()))] + [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(c)[order].astype(np.int64)))
                                                                     for c in columns.values()], names=["doc_id", *columns])

    return parts.groupBy("q").applyInArrow(gather, f"doc_id {kind}, pos array<long>, n array<long>, flag array<long>")


def repeated(parts: DataFrame, kind: str, width: int) -> DataFrame:
    """(doc_id, pos array): the located entries whose key occurs elsewhere too, gathered by document."""

    def reduce(table: pa.Table) -> pa.Table:
        if (done := answered(table, width)) is not None:
            return done
        s = Slices(table)
        return replies(s.ids, s.doc[s.again], s.pos[s.again], width)

    return by_document(parts.groupBy("r").applyInArrow(reduce, REPLY.format(kind=kind)), kind).select("doc_id", "pos")


WINDOW_SLICE = "r int, key binary, extra binary, doc binary, pos binary, ids array<{kind}>"


class Windows:
    """Located windows in the order of their key, 32 further bits, row and place, and which of them start elsewhere too.

    ``again``: all of those; with ``keep_first`` all but the ones of the smallest id and, in each row of that id, the first start."""

    def __init__(self, key: np.ndarray, extra: np.ndarray, doc: np.ndarray, pos: np.ndarray, ids: pa.Array, keep_first: bool):
        row = row_numbers(ids)[0][doc]
        order = np.lexsort((pos, row, extra, key))
        self.key, self.extra, self.doc, self.pos, self.ids = key[order], extra[order], doc[order], pos[order], ids
        row, rank, pos = row[order], id_ranks(ids)[self.doc], self.pos
        new = np.ones(len(order), bool)
        new[1:] = (self.key[1:] != self.key[:-1]) | (self.extra[1:] != self.extra[:-1])
        first = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        if keep_first:
            own = new.copy()
            own[1:] |= row[1:] != row[:-1]
            self.again = (rank != rank[first][group]) | (pos != pos[np.flatnonzero(own)][np.cumsum(own) - 1])
            self.left = ~self.again
        else:
            self.again = np.diff(np.append(first, len(order)))[group] > 1
            self.left = new  # one of each, for the other tasks to see


def window_slices(key: np.ndarray, extra: np.ndarray, doc: np.ndarray, pos: np.ndarray, ids: pa.Array, width: int, keep_first: bool) -> Iterator[pa.RecordBatch]:
    """Located windows by ranges of a 64-bit key, with 32 further bits that must agree too.  What starts elsewhere in the
    chunk is answered; of the others, and of each window once at least, goes on what another task must see."""
    w = Windows(key, extra, doc, pos, ids, keep_first)
    names = ["r", "key", "extra", "doc", "pos", "ids"]
    done = replies(ids, w.doc[w.again], w.pos[w.again], width)
    empty = pa.array([b""] * len(done), pa.binary())
    yield from pa.table([pa.array(np.asarray(done.column("q")) + width, pa.int32()), empty, empty, done.column("doc"), done.column("pos"), done.column("ids")], names=names).to_batches()
    key, extra, doc, pos = (x[w.left] for x in (w.key, w.extra, w.doc, w.pos))
    edges = [(i << 64) // width for i in range(1, width)]
    cut = np.concatenate([[0], np.searchsorted(key, np.array(edges, np.uint64)), [len(key)]]).astype(np.int64)
    for r in range(width):
        lo, hi = cut[r], cut[r + 1]
        if lo < hi:
            docs, inv = np.unique(doc[lo:hi], return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r], pa.int32()), pa.array([planes(np.diff(key[lo:hi], prepend=np.uint64(0)), 8)], pa.binary()),
                 pa.array([planes(extra[lo:hi].astype(np.uint64), 4)], pa.binary()), pa.array([planes(inv.astype(np.uint64), 4)], pa.binary()),
                 pa.array([planes(pos[lo:hi].astype(np.uint64), 5)], pa.binary()), id_list(ids, docs)], names=names)


def marked_windows(parts: DataFrame, kind: str, keep_first: bool, width: int) -> DataFrame:
    """(doc_id, pos array) of the windows that start elsewhere too: all of them, or with ``keep_first`` all but those
    of the smallest id and, in each row of that id, the first start."""

    def reduce(table: pa.Table) -> pa.Table:
        if table.column("r")[0].as_py() >= width:
            size = [len(x.as_py()) // 4 for x in table.column("doc")]
            return pa.table([pa.array(np.asarray(table.column("r")) - width, pa.int32()), *[table.column(c) for c in ("ids", "doc", "pos")],
                             pa.array([bytes(4 * n) for n in size], pa.binary()), pa.array([bytes(n) for n in size], pa.binary())],
                            names=["q", "ids", "doc", "pos", "n", "flag"])
        key, extra, doc, pos, ids, base = [], [], [], [], [], 0
        for row in table.to_batches():
            for i in range(row.num_rows):
                key.append(np.cumsum(unplanes(row.column("key")[i].as_py(), 8), dtype=np.uint64))
                extra.append(unplanes(row.column("extra")[i].as_py(), 4))
                doc.append(unplanes(row.column("doc")[i].as_py(), 4).astype(np.int64) + base)
                pos.append(unplanes(row.column("pos")[i].as_py(), 5).astype(np.int64))
                ids.append(row.column("ids")[i].values)
                base += len(ids[-1])
        every = concat_lists(ids, table.schema.field("ids").type.value_type)
        w = Windows(*(np.concatenate(x) for x in (key, extra, doc, pos)), every, keep_first)
        return replies(every, w.doc[w.again], w.pos[w.again], width)

    return by_document(parts.groupBy("r").applyInArrow(reduce, REPLY.format(kind=kind)), kind).select("doc_id", "pos")


by_value(__name__)
