"""SimHash near-duplicates by deletion-variant signatures.

Two 64-bit fingerprints that differ in at most d bits are cut into d // 2 + 1
segments; one segment then differs in at most one bit.  Each segment is indexed once
for every bit of it taken as a wildcard (64 variants per fingerprint), so a pair that
differs in one bit of the segment meets in that bit's variant, and an equal pair
in any.  Variants are joined on equality and verified by the whole distance.

Copies collapse into one fingerprint before anything is compared.  Within a
variant's bucket pairs are compared in sorted runs inside the task that holds
the bucket; what leaves the task is a spanning forest of the verified links, never
the pairs.  Buckets over ``bucket_rows`` fingerprints are handed back whole and
dealt out as pairs of blocks, so no task holds a group that grows with the data.

Edge cases: null text is empty; a text without words has fingerprint zero and is
linked like any other; fewer words than ``shingle`` are one shingle; rows with equal
ids are kept as rows; null ids never become a component's id unless it has no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.base import by_value, fresh, materialize, shuffle_width, text_key, texts
from eventide.llm.graph import components

CHUNK = 1 << 16  # shingles whose bits are counted at once
HELD_LINKS = 1 << 18  # links that a task holds before it reduces them to a forest
HELD_ROWS = 1 << 17


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """Majority bits of the XXH64 of the word shingles of a UTF-8 text, repeats included; A-Z in lower case."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    spans = zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    n = len(words) - k + 1
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, n)
    for at in range(0, n, CHUNK):
        bits = np.unpackbits(hashes[at:at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp) per row; fp is the fingerprint as a signed long."""
    d = texts(docs, id_col, text_col)
    kind = d.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=["id", "fp"])

    return d.select("_id", F.col("_text").cast("binary")).mapInArrow(run, f"id {kind}, fp long")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for every non-root node of the links a-b; root is the smallest value of its component."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[:len(a)], inv[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        if (new == label).all():
            break
        label = new
    rest = label != np.arange(len(nodes))
    return nodes[rest], nodes[label[rest]]


def _links_in_buckets(distance: int, most: int | None):
    """Task function over rows (bucket keys..., fp) sorted by bucket: a forest of links (a, b, false) and, if ``most``
    is given, the rows of larger buckets handed back as (key, fp, true)."""

    def compare(bucket: np.ndarray, fp: np.ndarray, held: list) -> None:
        """All pairs at growing lag within equal buckets; ``at`` shrinks to the rows whose bucket still reaches.  Rows that are
        connected already add no link, so a chunk yields fewer links than it has rows."""
        label = np.arange(len(fp))
        at, lag = np.arange(len(fp) - 1), 1
        while len(at):
            at = at[at + lag < len(fp)]
            at = at[bucket[at + lag] == bucket[at]]
            near = at[np.bitwise_count((fp[at] ^ fp[at + lag]).view(np.uint64)) <= distance]
            a, b = label[near], label[near + lag]
            if (new := a != b).any():
                node, root = forest(a[new], b[new])
                joined = np.arange(len(fp))
                joined[node] = root
                label = joined[label]
            lag += 1
        linked = np.flatnonzero(label != np.arange(len(fp)))
        if len(linked):
            held.append((fp[linked], fp[label[linked]]))
        if sum(len(x) for x, _ in held) > HELD_LINKS and len(held) > 1:
            held[:] = [forest(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))]

    def out(a, b, hot) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(np.full(len(a), hot))], names=["a", "b", "hot"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        bucket, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        overfull = None  # a bucket that was handed back so far

        def settle(done: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
            if most is not None and len(done):
                starts = np.flatnonzero(np.concatenate([[True], done[1:] != done[:-1]]))
                size = np.diff(np.append(starts, len(done)))
                big = np.repeat(size > most, size)
                if overfull is not None:
                    big |= done == overfull
                if big.any():
                    yield out(done[big], fps[big], True)
                    done, fps = done[~big], fps[~big]
            if len(done) > 1:
                compare(done, fps, held)

        for b in batches:
            bucket = np.concatenate([bucket, b.column(0).to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, b.column(1).to_numpy(zero_copy_only=False)])
            if len(bucket) < HELD_ROWS:
                continue
            last = int(np.searchsorted(bucket, bucket[-1], "left"))  # the last bucket may go on in the next batch
            if last:
                yield from settle(bucket[:last], fp[:last])
                overfull = None
            if most is not None and len(bucket) - last > most:
                overfull = bucket[-1]
                yield out(bucket[last:], fp[last:], True)
                last = len(bucket)
            bucket, fp = bucket[last:], fp[last:]
        yield from settle(bucket, fp)
        if held:
            a, b_ = forest(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
            yield out(a, b_, False)

    return run


def variants(fps: DataFrame, distance: int) -> DataFrame:
    """(bucket, fp): 64 rows per fingerprint; a bucket is a wildcard bit and the other bits of its segment."""
    n = distance // 2 + 1
    cuts = [64 * i // n for i in range(n + 1)]
    keep = []
    for lo, hi in zip(cuts, cuts[1:]):
        for bit in range(lo, hi):
            mask = ((1 << (hi - lo)) - 1) & ~(1 << (bit - lo))
            keep.append(F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit(mask)).bitwiseOR(F.lit(bit << 40)))
    return fps.select(F.explode(F.array(*keep)).alias("bucket"), "fp")


def links(fps: DataFrame, distance: int = 4, bucket_rows: int = 20_000, width: int | None = None) -> DataFrame:
    """(a, b) links among distinct fingerprints, enough of them to connect whatever differs in ``distance`` bits or less.

    2 <= distance: segments of at most 32 bits, so that a bucket fits one long."""
    if not 2 <= distance <= 16:
        raise ValueError("distance must be from 2 to 16")
    spread = variants(fps, distance)
    n = width or shuffle_width(fps)
    found = materialize(spread.repartition(n, "bucket").sortWithinPartitions("bucket", "fp")
                        .mapInArrow(_links_in_buckets(distance, bucket_rows), "a long, b long, hot boolean"))
    hot = found.filter("hot").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    blocks = hot.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / bucket_rows).cast("int").alias("n"))
    dealt = (hot.join(blocks, "key").withColumn("i", F.pmod(F.xxhash64("fp"), F.col("n")).cast("int"))
             .select("key", "fp", "i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("j"))
             .select(F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")).alias("bucket"), "fp"))
    rest = (dealt.repartition(n, "bucket").sortWithinPartitions("bucket", "fp")
            .mapInArrow(_links_in_buckets(distance, None), "a long, b long, hot boolean"))
    return found.filter("NOT hot").unionByName(rest).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = 4,
                    bucket_rows: int = 20_000) -> DataFrame:
    """(id, fingerprint hex, component_id) per row; component_id is the smallest id it is linked to, itself included."""
    width = shuffle_width(docs)
    rows = materialize(fingerprints(docs, id_col, text_col, shingle))
    each = materialize(rows.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(links(each.select("fp"), distance, bucket_rows, width))
    rooted = each.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", F.col("root").alias("_root")).join(ids, F.col("_root") == F.col("root")).select(F.col("fp").alias("_fp"), "component_id")
    return rows.join(named, F.col("fp") == F.col("_fp")).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **args) -> DataFrame:
    """One row of each component, all columns: that of the smallest id (null after all others), of the smallest text hash
    among rows of that id, any one among equal rows.

    Rows are told apart by id and text, so a repeated id loses only the rows that are copies; equal rows count as copies, null and
    empty texts as texts without words; an empty table stays empty.  What goes is joined to the
    documents, not what stays.  That list grows with the documents, so the join is the same at every size: documents are
    dealt by key once, for both uses of the list, and a task holds the keys of its part alone."""
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("text"))
    keyed = near_duplicates(docs.select(key.alias("_key"), F.col(text_col).alias("_text")), "_key", "_text", **args)
    own, listed = fresh(docs, "_mine", "_listed")
    found = materialize(keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_rows"), F.first("component_id").alias("_first"))
                        .filter("_rows > 1 OR _key <> _first").select(F.col("_key").alias(listed), (F.col("_key") == F.col("_first")).alias("_stays")))
    mine, same = docs.withColumn(own, key), F.col(own) == F.col(listed)
    single = mine.join(found.select(listed).hint("shuffle_hash"), same, "left_anti")
    again = mine.join(found.filter("_stays").select(listed).hint("shuffle_hash"), same, "left_semi").dropDuplicates([own])
    return single.unionByName(again).drop(own)


by_value(__name__)
