"""Centroid clustering, byte-level BPE and importance resampling against plain versions of themselves, and on awkward tables."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import tiktoken
from public_tokenizers import PATTERN
from pyspark.sql import functions as F

from eventide.llm import byte_bpe, centroids, importance
from eventide.llm.base import load_table, prepare
from eventide.llm.queries import public_tokenizer

SF001 = "/root/testdata/sf0.001"
AWKWARD = [(1, None), (2, ""), (3, "one"), (4, " \n\t"), (5, "a b c d e"), (6, "a b c d e"), (7, "x" * 70_000), (7, "seven again"),
           (8, " ".join(f"w{i}" for i in range(3000))), (9, "é ü 漢字   \x1c z"), (None, "no id here at all"), (None, None)]


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# ------------------------------------------------------------------ 11 centroid clustering
def plain_clusters(rows, dims, k, rounds):
    """Every distance in Python integers."""
    vecs = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    vecs = [(i, [max(-2**27, min(2**27, x)) for x in v]) for i, v in vecs]
    hashed = sorted((i is None, "" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in vecs)
    cents = [v for _, _, v in hashed[:k]]
    d = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((d(v, c), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in vecs]
        for n in range(len(cents)):
            mine = [v for (_, v), o in zip(vecs, own) if o == n]
            if mine:
                cents[n] = [sum(c) // len(mine) for c in zip(*mine)]
    return sorted(((str(i), near(v)[1], near(v)[0]) for i, v in vecs)), cents


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


@pytest.mark.parametrize("dims,k,leading,spread", [(64, 16, 16, 1.0), (5, 3, 2, 0.02), (8, 7, 8, 300.0), (3, 4, 0, 1.0), (4, 40, 1, 0.01)])
def test_clusters_like_every_distance(spark, dims, k, leading, spread):
    rng = random.Random(dims * k)
    centre = [[rng.gauss(0, 3) for _ in range(dims)] for _ in range(4)]
    rows = [(i, [c + rng.gauss(0, spread) for c in rng.choice(centre)]) for i in range(250)]
    rows += [(i % 5, rows[i % 3][1]) for i in range(300, 340)]  # repeated ids and vectors
    rows += [(500, None), (501, []), (502, rows[0][1][:-1]), (503, [None] + rows[0][1][1:]), (504, [float("nan")] * dims), (505, [float("-inf")] * dims), (None, rows[1][1]), (None, rows[2][1])]
    df = vectors(spark, rows).withColumn("cluster", F.lit("clash")).withColumn("lead", F.lit(0))
    out, cents = centroids.cluster(df, dims=dims, k=k, leading=leading)
    want, plain = plain_clusters(rows, dims, k, 3)
    assert cents.tolist() == plain
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in out.collect()) == want
    rich = centroids.with_inertia(out, cents).collect()
    for r in rich:
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster) and r.inertia == sum(d for _, _, d in want)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, plain[r.cluster])).encode()).hexdigest()
    assert len(rich) == len(want)


def test_clusters_of_equal_huge_and_few_vectors(spark):
    huge = [(1, [1e300, -1e300]), (2, [1e7, 0.0]), (3, [0.0, 0.0]), (3, [0.0, 0.0]), (4, [-1e-9, 1e-9])]
    for rows in (huge, [(i, [1.0, 2.0]) for i in range(50)], [(1, [0.5, 0.5])]):
        out, cents = centroids.cluster(vectors(spark, rows), dims=2, k=3)
        want, plain = plain_clusters(rows, 2, 3, 3)
        assert cents.tolist() == plain and sorted((str(r.vec_id), r.cluster, r.distance) for r in out.collect()) == want
    none = vectors(spark, [(1, None)])
    assert centroids.with_inertia(*centroids.cluster(none)).count() == 0 and centroids.with_inertia(*centroids.cluster(none.limit(0))).count() == 0


def test_bounds_never_exceed_distances():
    rng = np.random.default_rng(2)
    for scale in (1.0, 1e3, 1e7):
        ints = np.floor(rng.normal(0, scale, (200, 12)) + rng.normal(0, 5 * scale, 12)).astype(np.int64)
        q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
        rotation = centroids.Rotation(ints.mean(axis=0), q, 4)
        own = centroids.Centroids.of(ints[:9], rotation)
        exact = ((ints[:, None] - ints[:9][None]) ** 2).sum(axis=2)
        assert (own.bounds(*rotation.apply(ints)) <= exact).all()
        best, distance = own.nearest(ints, *rotation.apply(ints))
        assert (best == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()


# ------------------------------------------------------------------ 12 byte-level BPE
@pytest.fixture(scope="module")
def reference():
    ranks = byte_bpe.read_ranks(public_tokenizer("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", "Hello's we'll  go\n\n  there ", "  \t x y", "é漢字\U0001f600 1234 ٣½", "a" * 5000, "  " * 3000, "<|endoftext|> \x00\x01 ▁Āǿ", "<unk> <s>",
         "".join(chr(c) for c in range(0x20, 0x3000)), " ".join(chr(c) + "b" + chr(c) for c in range(0x500, 0x1000, 3)), "it's IT'S 'sx ſ's"]


def test_bpe_ids_of_tiktoken_and_round_trip(spark, reference):
    rng = random.Random(6)
    alphabet = [chr(c) for c in (*range(32, 127), 10, 9, 0xe9, 0xdf, 0x416, 0x6f22, 0x558, 0x88f, 0x11de5, 0x1f600, 0x2003, 0x85, 0x1c)]
    texts = TEXTS + ["".join(rng.choices(alphabet, k=rng.randrange(1, 400))) for _ in range(150)]
    rows = AWKWARD + [(100 + i, t) for i, t in enumerate(texts)]
    path = public_tokenizer("byte_bpe_50k.tiktoken")
    coded = byte_bpe.encode(docs(spark, rows).withColumn("ids", F.lit("clash")), path, PATTERN, decoded=True)
    key = lambda i, ids: (str(i), tuple(ids))
    want = sorted((*key(i, reference.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)
    assert sorted((*key(r.doc_id, r.ids), bytes(r.decoded)) for r in coded.collect()) == want
    back = byte_bpe.decode(coded, path, PATTERN).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in back) == sorted((i, b) for i, _, b in want)
    assert byte_bpe.encode(docs(spark, []), path, PATTERN).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [50256]), (3, [None]), (4, []), (5, [-1])], "doc_id long, ids array<int>")
    assert [r.decoded for r in byte_bpe.decode(odd, path, PATTERN).orderBy("doc_id").collect()] == [None, None, None, b"", None]


def test_bpe_class_stand_ins_cover_every_character(reference):
    """Each character between letters, digits and spaces is cut as the library cuts it."""
    path = public_tokenizer("byte_bpe_50k.tiktoken")
    coder = byte_bpe.Codec(path, PATTERN, byte_bpe.stand_ins())
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(every), 40_000):
        text = "".join(f"a{c}a 1{c}1  {c}" for c in every[at:at + 40_000])
        assert coder.encode(text).tolist() == reference.encode_ordinary(text)


def test_bpe_long_texts_in_blocks_and_forgetting(reference, monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choices("abc  \n'stew1é՘", k=30_000))
    path = public_tokenizer("byte_bpe_50k.tiktoken")
    want = reference.encode_ordinary(text)
    for name, value in (("LONG", 100), ("BLOCK", 7), ("REMEMBERED", 500)):
        monkeypatch.setattr(byte_bpe, name, value)
        coder = byte_bpe.Codec(path, PATTERN, byte_bpe.stand_ins())
        assert coder.encode(text).tolist() == want
        assert coder.decode(want) == text.encode()


def test_bpe_model_with_sparse_ranks():
    ranks = {bytes([b]): 3 * b for b in range(256)} | {b"ab": 1000, b"bc": 900, b"abc": 2000, b"  ": 5000}
    ours = byte_bpe.Codec.__new__(byte_bpe.Codec)
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_proto=byte_bpe.serialise(ranks))
    order = sorted(ranks, key=ranks.__getitem__)
    theirs = tiktoken.Encoding("sparse", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    for t in ("abcab", "aabbcc   abc", "bcabc"):
        assert [ranks[order[i]] for i in model.encode(byte_bpe.characters(t.encode()), out_type=int)] == theirs.encode_ordinary(t)
    assert isinstance(ours, byte_bpe.Codec)


# ------------------------------------------------------------------ 13 importance resampling
def plain_resample(rows, targets, ngram, size, min_words, percent, seed):
    def features(t):
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
        runs = [" ".join(w[i:i + n]) for n in range(ngram[0], ngram[1] + 1) for i in range(len(w) - n + 1)]
        return len(w), [zlib.crc32(r.encode()) % size for r in runs]

    each = [features(t) for _, t in rows]
    s, t = np.zeros(size, int), np.zeros(size, int)
    for _, f in each:
        np.add.at(s, f, 1)
    for x in targets:
        np.add.at(t, features(x)[1], 1)
    gain = [math.floor(1000 * math.log((float(b) + 1) * (float(s.sum()) + size) / ((float(a) + 1) * (float(t.sum()) + size)))) for a, b in zip(s, t)]
    out = []
    for (i, _), (n, f) in zip(rows, each):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, r in enumerate(able[:percent * len(able) // 100], 1):
        r[5] = rank
    return sorted(tuple(map(str, (r[0], *r[2:]))) for r in out)


@pytest.mark.parametrize("ngram,size,percent,min_words", [((1, 1), 10_000, 10, 20), ((1, 3), 50, 60, 2), ((2, 2), 64, 100, 0), ((1, 2), 1, 35, 1)])
def test_resampling_against_plain_sums(spark, ngram, size, percent, min_words):
    rng = random.Random(size)
    pool = ["the", "River", "STONE", "café", "漢字", "x1", "don't", "a-b", "İß"]
    rows = [(i, " ".join(rng.choices(pool, k=rng.randrange(0, 60)))) for i in range(300)] + [(1000 + i, t) for i, t in AWKWARD[:7]] + [AWKWARD[8], AWKWARD[9]]
    targets = [" ".join(rng.choices(pool[:4], k=50)) for _ in range(5)] + [None, ""]
    target = spark.createDataFrame([(t, 1) for t in targets], "text string, score int")
    df = docs(spark, rows).withColumn("rank", F.lit("clash")).repartition(7)
    got = importance.resample(df, target, ngram=ngram, size=size, percent=percent, min_words=min_words).collect()
    assert sorted(tuple(map(str, (r.doc_id, r.n_features, r.weight, r.score, r["rank"]))) for r in got) == plain_resample(rows, targets, ngram, size, min_words, percent, "2024:")


def test_resampling_awkward_rows_and_empty_tables(spark):
    target = spark.createDataFrame([("a b",)], "text string")
    rows = AWKWARD + [(8, AWKWARD[8][1])] * 30
    got = importance.resample(docs(spark, rows), target, min_words=3, percent=50).collect()
    drawn = sorted(r["rank"] for r in got if r["rank"] is not None)
    able = sum(len(re.findall("[0-9a-z]+|[\u0080-\U0010ffff]+", t or "")) >= 3 for _, t in rows)
    assert len(got) == len(rows) and drawn == list(range(1, able // 2 + 1))
    assert importance.resample(docs(spark, []), target).count() == 0
    assert {r.weight for r in importance.resample(docs(spark, AWKWARD[:2]), target.limit(0)).collect()} == {0}


def test_bit_sliced_totals_are_exact():
    rng = np.random.default_rng(5)
    for size in (1, 63, 64, 65, 1000):
        gain = rng.integers(-30_000, 30_000, size)
        counts = rng.integers(0, 4, (6, size))
        counts[2, 0], counts[3] = 1 << 40, 0
        planes, worth = importance.gain_planes(gain)
        assert importance.totals(counts, planes, worth).tolist() == [sum(int(c) * int(g) for c, g in zip(row, gain)) for row in counts]
    planes, worth = importance.gain_planes(np.zeros(5, np.int64))
    assert importance.totals(np.ones((2, 5), np.int64), planes, worth).tolist() == [0, 0]


def test_new_queries_on_the_given_tables(spark, reference):
    import __spark_entry__ as E

    rows = [(r.doc_id, r.text) for r in load_table(spark, SF001, "documents").collect()]
    got = {r.doc_id: r for r in E.queries()["op12_byte_bpe"](spark, SF001).collect()}
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    targets = [r.text for r in load_table(spark, SF001, "benchmark").collect()]
    want = plain_resample(rows, targets, (1, 1), 10_000, 20, 10, "2024:")
    got = E.queries()["op13_importance_resampling"](spark, SF001).collect()
    assert sorted(tuple(map(str, (r.doc_id, r.n_features, r.weight, r.score, r["rank"]))) for r in got) == want
    rows = [(r.vec_id, r.embedding) for r in load_table(spark, SF001, "embeddings").collect()]
    got = E.queries()["op11_centroid_clustering"](spark, SF001).collect()
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in got) == plain_clusters(rows, 64, 16, 3)[0]
