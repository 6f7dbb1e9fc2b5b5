"""Each training-data operator against a plain version of itself, and on awkward tables: nulls, empty and long texts,
ties, repeated rows, empty tables, and extra columns with clashing names."""

import base64
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from eventide.llm import (decontaminate, packing, quality, secret_scan, simhash, substring, suffix_array, toxicity,
                          url_filter, warc)
from eventide.llm.base import load_table, prepare
from eventide.llm.queries import public_tokenizer

SF001 = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = "doc_id long, text string, lang string, source string, _id long, _text string, fp long, kept string, score double, host string"


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


def docs(spark, texts, schema="doc_id long, text string"):
    return spark.createDataFrame([(i, t) for i, t in texts], schema)


def sha(b):
    return hashlib.sha256(b).hexdigest()


def words(t):
    return (t or "").encode().split()


AWKWARD = [(1, None), (2, ""), (3, "one"), (4, " \n\t"), (5, "a b c d e"), (6, "a b c d e"), (7, "x" * 70_000),
           (8, " ".join(f"w{i}" for i in range(3000))), (9, "é ü 漢字 \u00a0 \x1c z"), (None, "no id here at all")]


# ------------------------------------------------------------------ 1 URL filters
def test_url_parts_and_rules(spark):
    urls = ["http://A.Example.NET/en/x?q#f", "https://example.com/de/", "http://notexample.com/de/", "ftp://sub.net/", "http://net", "x://org/fr/a",
            None, "nothing", "http://", "a://b://c/d", "http://example.net/EN/", "http://H\u0130.com/\n/x?y"]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    rows = {r.page_id: r for r in url_filter.filter_urls(df).collect()}
    got = [(rows[i].host, rows[i].path, rows[i].rule) for i in range(len(urls))]
    assert got == [("a.example.net", "/en/x", "example.net/en/"), ("example.com", "/de/", "example.com/de/"), ("notexample.com", "/de/", None),
                   ("sub.net", "/", "net/"), ("net", "", None), ("org", "/fr/a", "org/fr/"), ("", "", None), ("", "", None), ("", "", None),
                   ("b:", "//c/d", None), ("example.net", "/EN/", "net/"), ("h\u0130.com", "/\n/x", None)]
    assert [rows[i].verdict for i in (0, 1, 3, 5, 6, 7)] == ["allow", "block", "block", "allow", "allow", "allow"]


def test_url_model_counts_like_a_plain_loop(spark):
    texts = ["ab/aba", "casino.x/0", "ab/aba", "bets/0"]
    labelled = spark.createDataFrame([(t, i != 1) for i, t in enumerate(texts)], "text string, accepted boolean")
    counted = (labelled.groupBy("text").agg(F.count(F.when(F.col("accepted"), 1)).alias("n_accepted"), F.count(F.when(~F.col("accepted"), 1)).alias("n_rejected")))
    got = {r.gram: (r.n_accepted, r.n_rejected) for r in url_filter.gram_counts(counted, 3).collect()}
    want = {}
    for i, t in enumerate(texts):
        s = url_filter.START + t + url_filter.END
        for e in range(1, len(s) + 1):
            for k in range(min(3, e) + 1):
                c = want.setdefault(s[e - k:e], [0, 0])
                c[i == 1] += 1
    assert got == {k: tuple(v) for k, v in want.items()}


def test_url_scores_read_every_gram_at_any_size(spark):
    good = [f"http://site{c}.example.com/article/{c}" for c in "abcdefghijklmnop"]
    bad = [f"http://casino-{c}.example.com/xyzzy/{c}" for c in "abcdefghijklmnop"]
    asked = ["http://kasino.example.com/xyzzy/q", "http://siteq.example.com/article/q"]
    times = {u: 5000 if u in good else 5 for u in good + bad} | dict.fromkeys(asked, 1)
    few = spark.createDataFrame(list(times.items()), "url string, n int")
    df = few.select(F.explode(F.sequence(F.lit(1), "n")).alias("page_id"), "url")
    got = {r.url: (r.score, r.verdict) for r in url_filter.filter_urls(df).distinct().drop("page_id").distinct().collect()}
    text = {u: u[len("http://"):] for u in times}
    grams = {}
    for u, n in times.items():
        if zlib.crc32(text[u].encode()) % 10:
            s = url_filter.START + text[u] + url_filter.END
            for e in range(1, len(s) + 1):
                for k in range(min(5, e) + 1):
                    grams.setdefault(s[e - k:e], [0, 0])[u in bad] += n
    for u in times:
        assert got[u][0] == pytest.approx(url_filter.ratio(text[u], grams, 5, 2.0), abs=1e-9), u
    assert got[asked[0]][0] < 0 < got[asked[1]][0] and all(got[u][0] < 0 for u in bad)
    each = spark.createDataFrame([(t, 1, 0) for t in text.values()], "text string, n_accepted long, n_rejected long")
    counts = spark.createDataFrame([(g, *c) for g, c in grams.items()], "gram string, n_accepted long, n_rejected long")
    chunked = {r.text: r.score for r in url_filter.text_scores(each, counts, 5, 2.0, chunk=3).collect()}
    assert {t: pytest.approx(got[u][0], abs=1e-9) for u, t in text.items()} == chunked


def test_url_model_separates_unseen_urls(spark):
    good = [f"http://news{i}.example.com/article/{i}" for i in range(300)]
    bad = [f"http://casino-{i}.example.com/win/{i}" for i in range(300)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(good + bad + ["http://kasino-casinos.example.com/win/7", "http://newspaper.example.com/article/x"])],
                               "page_id long, url string")
    v = {r.url: r.verdict for r in url_filter.filter_urls(df).collect()}
    assert sum(v[u] == "block" for u in bad) >= 290 and sum(v[u] == "allow" for u in good) >= 290
    assert v["http://kasino-casinos.example.com/win/7"] == "block" and v["http://newspaper.example.com/article/x"] == "allow"


def test_url_filter_empty_table_and_one_class(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.filter_urls(none).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/x"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in url_filter.filter_urls(one).collect()} == {"allow"}


# ------------------------------------------------------------------ 2 toxicity
def test_toxicity_held_out_and_misspellings(spark):
    rng = random.Random(5)
    stem = ["the", "house", "river", "green", "walk", "stone", "light", "paper", "north", "table"]
    rows = []
    for i in range(600):
        ws = [rng.choice(stem) + rng.choice(["", "s", "ly", "ing"]) for _ in range(rng.randrange(20, 200))]
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                ws[rng.randrange(len(ws))] = rng.choice(["idiot", "moron", "worthless"]) + rng.choice(["", "s", "ic"])
        rows.append((i, " ".join(ws), int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df.select("doc_id", "text"), df.filter("doc_id < 400").select("doc_id", "toxic"))
    scored = df.filter("doc_id >= 400").select("toxic", toxicity.score_column(model, F.col("text")).alias("s")).collect()
    assert np.mean([(r.s >= 0.7) == bool(r.toxic) for r in scored]) > 0.95
    base = " ".join(["the river walks greenly"] * 8)
    tests = spark.createDataFrame([(base + " you worthlesss idiiot",), (base,), ("",), (None,)], "text string")
    s = [r.s for r in tests.select(toxicity.score_column(model, F.col("text")).alias("s")).collect()]
    assert s[0] >= 0.7 > s[1] and s[2] == s[3] and 0 <= s[2] < 0.7


def test_toxicity_sample_is_bounded_by_rows(spark, monkeypatch):
    rows = [(1, f"copy {i:03d}") for i in range(300)] + [(2, "two"), (3, "three"), (4, "four"), (3, None)]
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 0), (4, 1)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, toxic, **args: seen.extend(zip(texts, toxic.tolist())))
    toxicity.fit(docs(spark, rows), labels, per_class=2)
    assert sorted(seen) == [("copy 000", False), ("four", True), ("three", False), ("two", True)]


def plain_toxic_margin(text, vector, bias):
    """Log of the mean exponential of the passages' margins; ``vector``: bucket -> number."""
    ws = [w for w in (x.strip(".,;:!?\"'()[]{}*#%&$|<>-_/") for x in text.lower().split()) if w]
    if not ws:
        return None
    def word(w):
        b = "<" + w + ">"
        grams = {(i, n) for n in (3, 4, 5) for i in range(len(b)) if i + n <= len(b) and n < len(b)} | {(0, len(b))}
        return np.mean([vector[zlib.crc32(b[i:i + n].encode("utf-8", "replace")) % toxicity.BUCKETS] for i, n in grams])
    each = [bias + np.mean([word(w) for w in ws[k:k + 16]]) for k in range(0, len(ws), 16)]
    return np.log(np.mean(np.exp(each)))


TOXIC_TEXTS = ["one", "Some Words here", " ".join(f"w{i % 7}" for i in range(100)), "\u00c9t\u00e9 \u6f22\u5b57 x.", "a" * 300, "(no) -- no, no!"]


def test_toxicity_margin_against_a_plain_loop():
    model = toxicity.ToxicModel(np.random.default_rng(3).normal(size=toxicity.BUCKETS), 0.25, empty=-1.5)
    got = model.margin(["", *TOXIC_TEXTS, " . "], {})
    assert got[0] == got[-1] == -1.5
    np.testing.assert_allclose(got[1:-1], [plain_toxic_margin(t, model.weight, 0.25) for t in TOXIC_TEXTS], rtol=1e-9)


def test_toxicity_gradient_against_finite_differences():
    rng = np.random.default_rng(4)
    data, docs_ = toxicity.Sample(TOXIC_TEXTS), np.array([0, 1, 2, 3, 5])
    y, balance = np.array([0.0, 1, 1, 0, 1, 0]), np.array([2.0, 0.5, 1, 1, 3, 1])
    emb, top, bias = rng.normal(size=(toxicity.BUCKETS, 3)), rng.normal(size=(3, 2)), rng.normal(size=2)
    at = lambda: toxicity.gradients(data, docs_, y, balance, emb, top, bias)
    loss, used, _, g_emb, g_top, g_bias = at()
    side = top[:, 1] - top[:, 0]
    margins = [plain_toxic_margin(TOXIC_TEXTS[d], emb @ side, bias[1] - bias[0]) for d in docs_]
    assert loss == pytest.approx(np.mean([balance[d] * (np.log1p(np.exp(m)) - y[d] * m) for d, m in zip(docs_, margins)]))
    for array, places, grad in ((emb, [(int(u), j) for u in used[::9] for j in range(3)], lambda k: g_emb[np.searchsorted(used, k[0]), k[1]]),
                                (top, [(i, j) for i in range(3) for j in range(2)], lambda k: g_top[k]), (bias, [(0,), (1,)], lambda k: g_bias[k[0]])):
        for k in places:
            old, found = array[k], []
            for step in (1e-5, -1e-5):
                array[k] = old + step
                found.append(at()[0])
            array[k] = old
            assert grad(k) == pytest.approx((found[0] - found[1]) / 2e-5, abs=1e-8, rel=1e-5)


def test_toxicity_one_class_or_nothing(spark):
    d = docs(spark, AWKWARD)
    for y in ([], [(1, 0), (5, 0)]):
        model = toxicity.fit(d, spark.createDataFrame(y, "doc_id long, toxic int"))
        assert {r.s for r in d.select(toxicity.score_column(model, F.col("text")).alias("s")).collect()} == {0.0}


# ------------------------------------------------------------------ 3 packing
def plain_best_fit(lengths, capacity):
    """Bins of best-fit decreasing, one piece after the other."""
    left = []
    for n in sorted(lengths, reverse=True):
        fit = [i for i, x in enumerate(left) if x >= n]
        if fit:
            i = min(fit, key=lambda i: left[i])
        else:
            left.append(capacity)
            i = len(left) - 1
        left[i] -= n
    return len(left), sorted(left)


@pytest.mark.parametrize("seed", range(8))
def test_packing_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 16, 100])
    lengths = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 300))]
    histogram = {n: lengths.count(n) for n in set(lengths)}
    used, places = {}, set()
    runs = packing.plan(histogram, capacity)
    for n, count in histogram.items():
        own = [r for r in runs if r[0] == n]
        for rank in range(count):
            _, first, per, base, offset = max((r for r in own if r[1] <= rank), key=lambda r: r[1])
            b, o = base + (rank - first) // per, offset + (rank - first) % per * n
            used[b] = used.get(b, 0) + n
            span = {(b, x) for x in range(o, o + n)}
            assert not span & places and o + n <= capacity
            places |= span
    assert all({x for c, x in places if c == b} == set(range(used[b])) for b in used)
    assert (len(used), sorted(capacity - u for u in used.values())) == plain_best_fit(lengths, capacity)


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizer())
    rows = AWKWARD + [(6, "a b c d e"), (11, "<|startoftext|>hi<|endoftext|> It's O'Neil's\u2028x e\u0301"), (12, "word " * 300)]
    got = packing.pack_documents(docs(spark, rows), public_tokenizer(), capacity=64).collect()
    want = sorted((-1 if i is None else i, zlib.crc32(p.tobytes()), s, len(p)) for i, t in rows
                  for ids in [np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")]
                  for s in range(0, len(ids), 64) for p in [ids[s:s + 64]])
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.ids_crc32, r.start, r.length) for r in got) == want
    bins = {}
    for r in got:
        assert r.start == 64 * r.piece
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in bins.values():
        end = 0
        for o, n in sorted(spans):
            assert o == end
            end = o + n
        assert end <= 64
    assert len(bins) == plain_best_fit([r.length for r in got], 64)[0]
    assert packing.pack_documents(docs(spark, []), public_tokenizer()).count() == 0


# ------------------------------------------------------------------ 4 WARC
def test_warc_round_trip_and_revisits(spark):
    html = {1: "<p>a</p>", 2: None, 3: "", 4: "<p>a</p>", 5: "WARC/1.0\r\n\r\nx\r\n\r\n", 6: "é漢" * 30_000, 7: "<p>a</p>"}
    df = spark.createDataFrame([(i, None if i == 3 else f"http://x/{i}\nevil: 1", h, "q") for i, h in html.items()],
                               "page_id long, url string, html string, _digest string")
    got = {r.page_id: r for r in warc.archive_round_trip(df).collect()}
    assert set(got) == set(html)
    for i, h in html.items():
        b = (h or "").encode()
        first = min(j for j, o in html.items() if (o or "") == (h or ""))
        assert got[i].payload_bytes == len(b) and got[i].payload_digest == base64.b32encode(hashlib.sha1(b).digest()).decode()
        assert (got[i].record_type, got[i].refers_to) == (("response", None) if i == first else ("revisit", first))
    big = {r.page_id: r.record_type for r in warc.archive_round_trip(df, min_bytes=100).collect()}
    assert set(big.values()) == {"response"}
    assert warc.archive_round_trip(df.limit(0)).count() == 0


def test_warc_reader_pushes_header_filters(spark, tmp_path):
    df = spark.createDataFrame([(i, f"http://x/{i}", "same" if i % 2 else f"page {i}") for i in range(20)], "page_id long, url string, html string")
    path = warc.write_warc(df, f"file://{tmp_path}/w")
    back = warc.read_warc(spark, path, payload=True)
    assert {bytes(r.payload).decode() for r in back.filter("record_type = 'response'").collect()} == {"same"} | {f"page {i}" for i in range(0, 20, 2)}
    assert back.filter("record_type = 'revisit' AND payload_bytes = 4").count() == 9
    reader = warc.WarcReader(path, False)
    from pyspark.sql.datasource import EqualTo, StringContains

    left = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), StringContains(("target_uri",), "x")]))
    assert len(left) == 1 and reader.tests == [("record_type", "eq", "revisit")]
    rows = [x for p in reader.partitions() for x in reader.read(p)]
    assert len(rows) == 9 and all(x[6] is None for x in rows)


# ------------------------------------------------------------------ 5 decontamination
def test_decontamination_finds_substituted_passages(spark):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(5000)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randrange(15, 60)))) for i in range(30)] + [(30, None), (31, "too short"), (32, ""), (33, "seven words in one line like this")]
    rows = []
    for i in range(200):
        ws = rng.choices(vocab, k=rng.randrange(0, 300))
        if i % 4 == 0:
            t = items[i % 30][1].split()
            if i % 8 == 0:  # one word in ten replaced, some punctuation and case changed
                t = [rng.choice(vocab) if k % 10 == 5 else w.upper() + "," if k % 3 == 0 else w for k, w in enumerate(t)]
            at = rng.randrange(len(ws) + 1)
            ws[at:at] = t
        rows.append((i, " ".join(ws)))
    rows += [(500, items[3][1]), (500, items[3][1]), (501, None), (502, "x seven words in one line like this y"), (None, items[4][1])]
    found = decontaminate.find_overlaps(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    pairs = {(r.doc_id, r.item_id) for r in found}
    assert pairs == {(i, i % 30) for i in range(0, 200, 4)} | {(500, 3), (502, 33), (None, 4)}
    assert all(r.n_equal >= 0.8 * r.n_words for r in found) and len(found) == len(pairs)
    left = decontaminate.drop_contaminated(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert left.filter("doc_id IS NULL").count() == 0 and left.filter("doc_id = 500").count() == 0 and left.filter("doc_id % 4 = 0 AND doc_id < 200").count() == 0


def test_masks_miss_no_accepted_pattern():
    for n in range(1, 14):
        most = n - int(np.ceil(0.8 * n - 1e-9))
        masks = decontaminate.masks_of(n, 0.8)
        assert masks == decontaminate.MASKS.get(n, decontaminate.LONG) and max(map(len, masks)) <= n
        for k in range(most + 1):
            assert decontaminate.missed(masks, n, k) == [], (n, k)
    for n, similarity in ((13, 0.6), (10, 0.5), (7, 0.7), (20, 0.8)):
        assert decontaminate.missed(decontaminate.masks_of(n, similarity), n, decontaminate.allowed(n, similarity)) == []


def test_decontamination_against_every_window(spark):
    """Items of 1 to 20 words, every accepted pattern of substitutions and some that are not."""
    rng = random.Random(13)
    items = {n: [f"i{n}w{k}" for k in range(n)] for n in range(1, 21)}
    rows = []
    for n, item in items.items():
        m = min(n, 13)
        for at in {0, n - m}:
            for k in range(4):
                patterns = list(itertools.combinations(range(m), k))
                for p in patterns if k < 3 else rng.sample(patterns, min(5, len(patterns))):
                    part = [f"x{rng.randrange(10**9)}" if j in p else w for j, w in enumerate(item[at:at + m])]
                    rows.append((len(rows), " ".join([f"a{rng.randrange(10**9)}" for _ in range(rng.randrange(4))] + part + ["z"] * rng.randrange(3))))
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    want = set()
    for i, t in rows:
        w = t.split()
        for n, item in items.items():
            m = min(n, 13)
            if any(sum(a == b for a, b in zip(w[x:x + m], item[y:y + m])) >= 0.8 * m - 1e-9 for x in range(len(w) - m + 1) for y in range(n - m + 1)):
                want.add((i, n))
    assert {n for _, n in want} == set(items)
    got = [(r.doc_id, r.item_id) for r in decontaminate.find_overlaps(docs(spark, rows), bench).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_decontamination_empty_sides(spark):
    some, none = docs(spark, AWKWARD), docs(spark, [])
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_overlaps(some, bench).count() == 0
    assert decontaminate.find_overlaps(none, spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")).count() == 0


def test_overlap_against_every_window():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n, m = rng.integers(1, 30), rng.integers(5, 25)
        w, item = rng.integers(0, 3, n), rng.integers(0, 3, m)
        shift, k = int(rng.integers(-m, n)), min(6, int(m))
        eq = {i: w[i] == item[i - shift] for i in range(n) if 0 <= i - shift < m}
        cover = {x for i in range(n) if all(j in eq for j in range(i, i + k)) and sum(eq[j] for j in range(i, i + k)) >= 0.8 * k for x in range(i, i + k)}
        got = decontaminate.overlap(w, item, shift, 6, 0.8)
        assert got == ((len(cover), sum(bool(eq[x]) for x in cover), min(cover)) if cover else None)


# ------------------------------------------------------------------ 6 secret scans
def plain_spans(t, scope=secret_scan.SCOPE):
    found = []
    for kind, (name, pattern) in enumerate(secret_scan.PATTERNS.items()):
        for m in re.finditer(pattern, t):
            if kind or len(m.group(2)) >= 12:
                found.append((m.start(), kind, m.end()))
    near = lambda x, kinds: any(o is not x and o[1] in kinds and o[2] + scope >= x[0] and o[0] - scope <= x[2] for o in found)
    over = lambda x: any(o[1] < 3 and o[2] > x[0] and o[0] < x[2] for o in found)
    keep = {3: lambda x: near(x, (0, 2, 4)), 4: lambda x: near(x, (1, 3)), 5: lambda x: near(x, (0, 2, 4)) and near(x, (1, 3))}
    return sorted(x for x in found if x[1] < 3 or (not over(x) and keep[x[1]](x)))


SECRETS = [None, "", "password = 'abcdefghijkl' x", "token=short token=longenoughvalue1", "token=xsecret: abcdefghijklmnop", "AKIAABCDEFGHIJKLMN AKIASHORT",
           "é漢字 api_key: ABCdef123456/+= 0123456789abcdef0", "user=bob " + "A1b2" * 10 + " https://api.example.com/x", "A1b2" * 10 + " https://lonely.example.com",
           "user=bob " + "z " * 300 + "A1b2" * 10, "PassWord:\"0123456789abcdef0123\"", "AKIA" + "Q" * 16 + " " + "b/C+" * 10 + " s3://bucket.example" ,
           "ſecret=abcdefghijklmnop deadbeefdeadbeefdeadbeef", " ".join(["0123456789abcdef", "token=abcdefghijkl"] * 400)]


def test_secret_scan_against_plain_regex(spark):
    rows = list(enumerate(SECRETS)) + [(2, SECRETS[2])]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, kind int, spans string")
    got = sorted((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in secret_scan.scan(df).collect())
    want = []
    for i, t in rows:
        s = plain_spans(t or "")
        text = lambda xs: ",".join(f"{secret_scan.KINDS[k]}:{a}:{e}" for a, k, e in xs)
        n = [sum(k == j for _, k, _ in s) for j in range(3)]
        want.append((i, *n, sha(text([x for x in s if x[1] < 3]).encode()), text(s)))
    assert got == sorted(want)
    assert secret_scan.scan(df.limit(0)).count() == 0


def test_redaction(spark):
    df = docs(spark, [(i, t) for i, t in enumerate(SECRETS)]).withColumn("spans", F.lit("kept"))
    got = {r.doc_id: (r.text, r.spans) for r in secret_scan.redact(df).collect()}
    for i, t in enumerate(SECRETS):
        out, at = "", 0
        for a, _, e in plain_spans(t or ""):
            if a >= at:
                out += t[at:a] + "[secret]"
            at = max(at, e)
        assert got[i] == (None if t is None else out + t[at:], "kept")


# ------------------------------------------------------------------ 7 SimHash
def plain_fingerprint(t, k=4):
    w = (t or "").encode().lower().split()
    sh = [b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    c = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in sh) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * c[b] > len(sh))


def plain_components(ids, fps, d):
    root = list(range(len(ids)))
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= d:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    return {i: min((x for x in groups[find(k)] if x is not None), default=None) for k, i in enumerate(ids)}


def test_simhash_fingerprints_and_edges(spark):
    rows = AWKWARD + [(6, "a b c d e"), (20, "A B C D E"), (21, "one"), (22, "\u00c9 \u00e9")]
    got = simhash.near_duplicates(docs(spark, rows)).collect()
    want = plain_components([i for i, _ in rows], [plain_fingerprint(t) for _, t in rows], 4)
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == sorted((str(i), f"{plain_fingerprint(t):016x}", want[i]) for i, t in rows)
    kept = simhash.keep_one(docs(spark, rows).withColumn("component_id", F.lit("clash"))).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted({str(want[i]) for i, _ in rows if i is not None} | {"None"})
    assert simhash.near_duplicates(docs(spark, [])).count() == 0 and simhash.keep_one(docs(spark, [])).count() == 0


@pytest.mark.parametrize("distance,most", [(4, 20_000), (4, 3), (2, 3), (5, 4)])
def test_simhash_links_connect_like_all_pairs(spark, distance, most):
    rng = random.Random(distance * 100 + most)
    fps = [0, (1 << 64) - 1]
    for _ in range(60):
        x = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 9)):
            fps.append(x)
            for b in rng.sample(range(64), rng.randrange(0, distance + 2)):
                x ^= 1 << b
    fps = sorted(set(fps))
    frame = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long")
    links = simhash.links(frame, distance, bucket_rows=most).collect()
    want = plain_components(list(range(len(fps))), fps, distance)
    place = {int(np.uint64(x).view(np.int64)): i for i, x in enumerate(fps)}
    root = {i: i for i in range(len(fps))}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for r in links:
        a, b = find(place[r.a]), find(place[r.b])
        root[max(a, b)] = min(a, b)
    assert {i: find(i) for i in root} == want


def test_components_of_a_long_chain(spark):
    from eventide.llm.graph import components

    links = spark.createDataFrame([(i, i + 1) for i in range(1, 200) if i != 100] + [(5, 5), (300, 301), (300, 301)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {i: (1 if i <= 100 else 101) for i in range(2, 201) if i != 101} | {301: 300}
    assert components(links.limit(0)).count() == 0


# ------------------------------------------------------------------ 8 substring dedup
def plain_word_dedup(rows, n):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        w = words(t)
        gone = set()
        for s in range(len(w) - n + 1):
            k = b" ".join(w[s:s + n])
            if k in seen:
                gone |= set(range(s, s + n))
            seen.add(k)
        out.append((str(i), len(w), len(gone), sha(b" ".join(x for j, x in enumerate(w) if j not in gone))))
    return sorted(out)


@pytest.mark.parametrize("n,seed", [(20, 1), (4, 2), (2, 3), (6, 4)])
def test_substring_dedup_against_every_window(spark, n, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choices("abcdefgh", k=rng.randrange(0, 60))) for _ in range(6)]
    rows = [(i, " ".join(rng.choices(pool, k=rng.randrange(0, 4)) + rng.choices("abcdefgh", k=rng.randrange(0, 30)))) for i in range(40)] + AWKWARD_UNIQUE
    got = substring.dedup(docs(spark, rows).withColumn("pos", F.lit("clash")), window=n).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == plain_word_dedup(rows, n)


AWKWARD_UNIQUE = [(100 + i, t) if i is not None else (None, t) for i, t in AWKWARD]


def test_dedups_tell_rows_of_one_id_apart(spark):
    rng = random.Random(8)
    prose = lambda n: " ".join("".join(rng.choices("abcdefghijk", k=7)) for _ in range(n))
    a, b, c, d = prose(120), prose(200), prose(200), prose(120)
    rows = [(None, a), (None, b), ("a", a), ("a", c), ("a", a), ("b", d), ("b", d), ("b", d[8:])]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    took = lambda out, n: sorted((str(r.doc_id), r[n], r.n_removed) for r in out.collect())
    # equal rows and rows of one id do not precede each other
    assert took(substring.dedup(df), "n_words") == sorted([("None", 120, 0), ("None", 200, 0), ("a", 120, 120), ("a", 120, 120), ("a", 200, 0),
                                                           ("b", 120, 0), ("b", 120, 0), ("b", 119, 0)])
    size = len(a)
    assert took(suffix_array.dedup(df), "n_bytes") == sorted([("None", size, size), ("None", 1599, 0), ("a", size, size), ("a", size, size), ("a", 1599, 0),
                                                              ("b", 959, 959), ("b", 959, 959), ("b", 951, 951)])
    twice = prose(30) + " "
    rows = [(1, twice * 2), (2, None), (2, prose(30))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert took(substring.dedup(df), "n_words") == [("1", 60, 30), ("2", 0, 0), ("2", 30, 0)]


def test_substring_dedup_repeated_rows_and_empty(spark):
    t = " ".join(f"w{i}" for i in range(30))
    got = substring.dedup(docs(spark, [(1, t), (1, t), (2, t)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (1, 0), (2, 30)]
    assert substring.dedup(docs(spark, [])).count() == 0
    kept = substring.dedup(docs(spark, [(1, t), (2, "new " + t + " end")]), texts_out=True).collect()
    assert {r.doc_id: r.kept_text for r in kept} == {1: t, 2: "new end"}


# ------------------------------------------------------------------ 9 quality
def plain_statistics(t):
    t = t or ""
    w = [x for x in re.split("[\x20\x09-\x0d]+", t) if x]
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    grams = {}
    for i in range(len(w) - 2):
        grams.setdefault(tuple(w[i:i + 3]), []).append(i)
    cover = {i + j for at in grams.values() if len(at) > 1 for i in at for j in range(3)}
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover)


def test_quality_judges_groups_of_every_size(spark):
    import __spark_entry__ as E

    rng = random.Random(12)
    prose = lambda: " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9))) for _ in range(rng.randrange(80, 300)))
    odd = lambda: " ".join("#" * 30 + str(rng.random()) for _ in range(200))
    rows = [(i, prose(), "en" if i % 3 else None, f"s{i % 40}") for i in range(400)]
    rows += [(1000, odd(), "en", "s1"), (1001, odd(), "en", "alone"), (1002, odd(), None, None), (1003, odd(), "xx", "alone"), (1004, prose(), "xx", "other")]
    rows += [(1005, odd(), "en", "pair"), (1006, odd(), "en", "pair")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.judge(df).collect()}
    assert len(got) == len(rows) and all(r.d2 is not None and not r.base_failed for r in got.values())
    assert not any(got[i].kept for i in (1000, 1001, 1002, 1003, 1005, 1006)) and got[1004].kept
    assert np.mean([got[i].kept for i in range(400)]) > 0.98
    assert quality.judge(df.limit(0)).count() == 0
    judged = E.queries()["op9_quality_rules"](spark, SF001).collect()
    assert judged and all(r.d2 is not None for r in judged) and any(not r.kept and not r.base_failed for r in judged)


def test_quality_statistics(spark):
    rng = random.Random(9)
    rows = AWKWARD + [(30 + i, "".join(rng.choices("ab \n#$", k=200))) for i in range(30)] + [(70, "a b c\na b c\n\na b c \n a")]
    df = spark.createDataFrame([(i, t, "en", None, 0, "y") for i, t in rows], "doc_id long, text string, lang string, source string, n_words long, kept string")
    got = quality.statistics(df).collect()
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == sorted((str(i), *plain_statistics(t)) for i, t in rows)


def plain_mcd(x, groups, steps, share, floor, prior):
    """The same concentration steps in numpy, groups leaning on their parents; quantiles as the smallest value that covers the share.

    ``groups``: (language, source) of each row of ``x``; returns the scaled distance of each row in its group."""
    q = lambda v, s: np.sort(v)[max(0, int(np.ceil(s * len(v))) - 1)]
    rows = {(): np.arange(len(x))}
    for i, (lang, source) in enumerate(groups):
        rows.setdefault((lang,), []).append(i)
        rows.setdefault((lang, source), []).append(i)

    def lean(own):
        out = {}
        for g in sorted(own, key=len):
            if g:
                w = len(rows[g]) / (len(rows[g]) + prior)
                out[g] = tuple(w * a + (1 - w) * b for a, b in zip(own[g], out[g[:-1]]))
            else:
                out[g] = own[g]
        return out

    def dist(model, g):
        m, cov = model[g]
        d = x[rows[g]] - m
        return np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov + np.diag(floor ** 2)), d)

    model = lean({g: (np.array([q(c, 0.5) for c in x[r].T]), np.diag([((q(c, 0.75) - q(c, 0.25)) / 1.349) ** 2 for c in x[r].T])) for g, r in rows.items()})
    for _ in range(steps):
        own = {}
        for g, r in rows.items():
            d = dist(model, g)
            near = x[np.array(r)[d <= q(d, share)]]
            own[g] = near.mean(0), np.cov(near.T, bias=True).reshape(x.shape[1], -1)
        model = lean(own)
    median = lean({g: (np.log(max(q(dist(model, g), 0.5), 1e-6)),) for g in rows})
    out = np.empty(len(x))
    for g, r in rows.items():
        if len(g) == 2:
            out[r] = dist(model, g) * quality.CHI2_MEDIAN_5 / max(np.exp(median[g][0]), 1e-6)
    return out


def test_quality_distances_against_numpy(spark):
    rng = random.Random(11)
    rows = []
    for g, (lang, source) in enumerate([("en", "a"), ("de", None), ("en", "tiny"), (None, "a"), ("en", "alone")]):
        for i in range((400, 400, 10, 30, 1)[g]):
            n = int(np.exp(rng.gauss(5, 0.4)))
            t = " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9))) for _ in range(n))
            rows.append((g * 1000 + i, t, lang, source))
    rows.append((5000, "abc#$% " * 5 + " ".join("#" * 30 + str(i) for i in range(300)), "en", "a"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.judge(df).collect()}
    x = {r.doc_id: r for r in quality.features(quality.statistics(df)).collect()}
    floor = np.array([quality.FLOOR[f] for f in quality.FEATURES])
    want = plain_mcd(np.array([[x[r[0]][f] for f in quality.FEATURES] for r in rows]), [r[2:] for r in rows], 3, 0.75, floor, 50)
    np.testing.assert_allclose([got[r[0]].d2 for r in rows], want, rtol=1e-6)
    assert not got[5000].kept and not got[5000].base_failed
    assert np.mean([r.kept for i, r in got.items() if not r.base_failed]) > 0.98
    assert quality.judge(df.limit(0)).count() == 0


# ------------------------------------------------------------------ 10 suffix arrays
def plain_byte_dedup(rows, n):
    seen = {}
    for _, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - n + 1):
            seen[b[s:s + n]] = seen.get(b[s:s + n], 0) + 1
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - n + 1):
            if seen[b[s:s + n]] > 1:
                gone[s:s + n] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((str(i), len(b), int(gone.sum()), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return sorted(out)


@pytest.mark.parametrize("n,hot", [(12, 4096), (12, 2), (400, 4096), (33, 5)])
def test_suffix_dedup_against_every_string(spark, n, hot):
    rng = random.Random(n + hot)
    pool = ["".join(rng.choices("ab é", k=rng.randrange(n, 3 * n))) for _ in range(5)]
    rows = [(i, "".join(rng.choices(pool, k=rng.randrange(0, 3)) + rng.choices("abcd", k=rng.randrange(0, n)))) for i in range(50)]
    rows += [(200, "a" * (3 * n)), (201, "ab" * (2 * n)), (202, None), (203, ""), (None, pool[0]), (204, "\x00" * (n + 3))]
    got = suffix_array.dedup(docs(spark, rows).withColumn("at", F.lit("clash")), length=n, hot=hot).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == plain_byte_dedup(rows, n)


def test_suffix_dedup_long_text_in_pieces(monkeypatch):
    rng = np.random.default_rng(3)
    text = rng.integers(97, 100, 5000).astype(np.uint8).tobytes()
    whole = suffix_array.anchors(np.frombuffer(text, np.uint8), np.array([len(text)]), 24)
    monkeypatch.setattr(suffix_array, "CHUNK_BYTES", 700)
    parts = suffix_array.text_anchors(text, 24)
    each = lambda a: [h for h, x, y in zip(*a) for _ in range(x, y + 1)]
    assert each(whole) == each(parts) and len(each(whole)) == 5000 - 23


@pytest.mark.parametrize("seed", range(12))
def test_shards_agree_with_counting(seed):
    rng = random.Random(seed)
    n = rng.choice([8, 13, 16, 24])
    base = ["".join(rng.choices("ab", k=200)).encode() for _ in range(3)]
    regions = []
    for _ in range(12):
        a = rng.randrange(150)
        x = bytearray(rng.choice(base)[a:a + rng.randrange(n, 50)])
        if rng.random() < 0.5:
            x[rng.randrange(len(x))] = 99
        regions.append(bytes(x))
    regions = [r for r in dict.fromkeys(regions) if len(r) >= n]
    count = {}
    for r in regions:
        for s in range(len(r) - n + 1):
            count[r[s:s + n]] = count.get(r[s:s + n], 0) + 1
    got = suffix_array.repeated_strings([5] * len(regions), regions, n, shard_bytes=rng.choice([40, 100, 10_000]))
    assert [g.tolist() for g in got] == [[s for s in range(len(r) - n + 1) if count[r[s:s + n]] > 1] for r in regions]


def test_suffix_array_and_prefixes():
    rng = random.Random(1)
    for _ in range(20):
        t = bytes(rng.choices(b"ab", k=rng.randrange(1, 300)))
        sa = suffix_array.suffix_array(np.frombuffer(t, np.uint8))
        assert sa.tolist() == sorted(range(len(t)), key=lambda i: t[i:])
        lcp = suffix_array.common_prefixes(np.frombuffer(t, np.uint8), sa, 50)
        def shared(a, b):
            k = 0
            while k < 50 and max(a, b) + k < len(t) and t[a + k] == t[b + k]:
                k += 1
            return k
        assert lcp.tolist()[1:] == [shared(a, b) for a, b in zip(sa[:-1].tolist(), sa[1:].tolist())]


# ------------------------------------------------------------------ every operator: clashing columns, whole tables
HELPERS = ["_id", "_text", "_key", "_mine", "_listed", "_rows", "_first", "_stays", "_spans", "_spans_of", "_text_key", "_text_sha256", "_y", "_lid", "_t", "_bad",
           "_rule_verdict", "_score", "_row", "_part", "_at", "_drawable", "fp", "pos", "ids", "z", "kept", "score", "component_id", "doc", "item_id", "cluster"]


def clashing(df, keep=()):
    """``df`` with a column of each helper name, its own value in every row."""
    names = [c for c in HELPERS if c not in df.columns and c not in keep]
    return df.select("*", *[F.concat(F.lit(c + ":"), F.coalesce(F.col(df.columns[0]).cast("string"), F.lit("-"))).alias(c) for c in names])


def rows_of(out, columns=None):
    columns = columns or sorted(out.columns)
    return sorted([tuple(str(r[c]) for c in columns) for r in out.collect()])


def test_operators_ignore_clashing_columns(spark):
    from eventide.llm import byte_bpe, centroids, importance
    from public_tokenizers import PATTERN

    plain = spark.createDataFrame([(i, t, "en", "s") for i, t in AWKWARD], "doc_id long, text string, lang string, source string")
    items = load_table(spark, SF001, "benchmark")
    leak = items.filter("length(text) > 200").select(F.lit(77).cast("long").alias("doc_id"), "text", F.lit("en").alias("lang"), F.lit("s").alias("source")).limit(1)
    pages = plain.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("http://a.b/"), "doc_id").alias("url"), F.col("text").alias("html"))
    vectors = spark.createDataFrame([(i, [float(i % 3), float(j), 0.5]) for i in range(6) for j in (0, 1)], "vec_id long, embedding array<double>")
    runs = {
        "url_filters": (pages, lambda d: url_filter.filter_urls(d).select("page_id", "host", "path", "rule", "verdict", "score")),
        "packing": (plain, lambda d: packing.pack_documents(d, public_tokenizer()).select("doc_id", "piece", "start", "length", "ids_crc32")),
        "warc": (pages, lambda d: warc.archive_round_trip(d).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")),
        "decontamination": (plain.unionByName(leak), lambda d: decontaminate.find_overlaps(d, clashing(items, ["item_id"]))),
        "secret_scans": (plain, secret_scan.scan),
        "simhash": (plain, simhash.near_duplicates),
        "substring": (plain, substring.dedup),
        "quality": (plain, lambda d: quality.judge(d).select("doc_id", "n_words", "kept", F.round("d2", 6).alias("d2"))),
        "suffix": (plain, suffix_array.dedup),
        "centroids": (vectors, lambda d: centroids.with_inertia(*centroids.cluster(d, dims=3, k=3))),
        "byte_bpe": (plain, lambda d: byte_bpe.encode(d, public_tokenizer("byte_bpe_50k.tiktoken"), PATTERN, decoded=True)),
        "importance": (plain, lambda d: importance.resample(d, clashing(items, ["item_id"]))),
    }
    for name, (df, run) in runs.items():
        assert rows_of(run(clashing(df))) == rows_of(run(df)), name
    model = toxicity.ToxicModel(np.random.default_rng(1).normal(size=toxicity.BUCKETS))
    assert rows_of(clashing(plain).select(toxicity.score_column(model, F.col("text")).alias("s"))) == rows_of(plain.select(toxicity.score_column(model, F.col("text")).alias("s")))


def test_pipeline_stages_keep_clashing_columns(spark):
    """Every stage decides alike with columns of its helpers' names, and hands each of them on with its values."""
    import corpus_pipeline as P

    leak = load_table(spark, SF001, "benchmark").filter("length(text) > 200").orderBy("item_id").first().text
    rows = [(i, t, "en", "s", len(t or "")) for i, t in AWKWARD] + [(40, "token=abcdefghijklmnop and more", "en", "s", 31), (41, leak, "en", "s", len(leak))]
    df = spark.createDataFrame(rows, DOC)
    full = clashing(df)
    assert url_filter.filter_urls(full.withColumn("url", F.col("text"))).columns == [c for c in full.columns if c != "score"] + ["url", "host", "path", "rule", "verdict", "score"]
    value_of = {tuple(map(str, r[:2])): r for r in full.collect()}
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, full, SF001)
        assert out.columns == full.columns, name
        assert rows_of(out, df.columns) == rows_of(stage(spark, df, SF001), df.columns), name
        for r in out.collect():
            text = r.text if name != "secret_scans" or r.doc_id != 40 else rows[-2][1]
            assert r[5:] == value_of[str(r.doc_id), str(text)][5:], (name, r.doc_id)
    assert rows_of(P.pack_sequences(spark, full, SF001), ["doc_id", "piece", "ids_crc32"]) == rows_of(P.pack_sequences(spark, df, SF001), ["doc_id", "piece", "ids_crc32"])


def test_queries_cover_their_tables(spark):
    import __spark_entry__ as E

    tables = {"op1": "pages", "op4": "pages", "op11": "embeddings"}
    for name, q in E.queries().items():
        m = re.match(r"op(\d+)_", name)
        if m and m[1] not in ("3", "5"):
            out = q(spark, SF001)
            assert out.count() == load_table(spark, SF001, tables.get(f"op{m[1]}", "documents")).count(), name


def test_decontamination_query_against_brute_force(spark):
    import __spark_entry__ as E

    norm = lambda t: [w.decode("utf-8", "replace").lower().encode().strip(decontaminate.PUNCTUATION) for w in words(t)]
    items = [(r.item_id, norm(r.text)) for r in load_table(spark, SF001, "benchmark").collect()]
    index = {}
    for i, w in items:
        for k in range(len(w) - 12):
            index.setdefault(tuple(w[k:k + 13]), set()).add(i)
    want = set()
    for r in load_table(spark, SF001, "documents").collect():
        w = norm(r.text)
        for k in range(len(w) - 12):
            want |= {(r.doc_id, i) for i in index.get(tuple(w[k:k + 13]), ())}
    got = {(r.doc_id, r.item_id) for r in E.queries()["op5_benchmark_decontamination"](spark, SF001).collect()}
    assert want and want <= got


def test_pipeline_stages_on_an_awkward_table(spark):
    import corpus_pipeline as P

    rows = [(i, t, None if i == 3 else "en", None if i == 5 else "s", None if t is None else len(t), 1, "x") for i, t in AWKWARD]
    rows += [rows[5], (40, "token=abcdefghijklmnop and more", "en", "s", 31, 1, "x")]
    df = spark.createDataFrame(rows, DOC + ", _id long, component_id string")
    for part in (df, df.limit(0)):
        now = part
        for name, stage in P.STAGES:
            out = stage(spark, now, SF001)
            got = out.collect()
            if name != P.STAGES[-1][0]:
                assert out.columns == df.columns, name
                now = spark.createDataFrame(got, out.schema)
        ids = [r.doc_id for r in now.collect()]
        if part is df:  # 1, 2 and 4 have no words, 5 and 6 are copies, the row of 6 is there twice
            assert sorted(str(i) for i in ids) == sorted(["1", "3", "40", "5", "7", "8", "9", "None"])
            assert [r.text for r in now.collect() if r.doc_id == 40] == ["[secret] and more"] and len(got) >= len(ids)
        else:
            assert ids == [] and got == []


def test_pipeline_stages_decide_by_row(spark):
    """Null and repeated ids: copies go, unique and clean rows stay whole, contaminated rows go."""
    import corpus_pipeline as P

    rng = random.Random(33)
    prose = lambda: " ".join("".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(60))
    a, b, c, d, e = (prose() for _ in range(5))
    leak = load_table(spark, SF001, "benchmark").filter("length(text) > 200").orderBy("item_id").first().text
    row = lambda i, t: (i, t, "en", "s", len(t), 1, "x")
    make = lambda rows: spark.createDataFrame([row(*r) for r in rows], DOC + ", _id long, _text string")
    stages = dict(P.STAGES)
    texts_of = lambda out: sorted((str(r.doc_id), r.text) for r in out.collect())
    # a: null ids only; b: id 7 copies id 1, whose other row c is unique; d: null and an id; e: equal rows
    rows = [(None, a), (None, a), (1, b), (7, b), (7, c), (None, d), (9, d), (5, e), (5, e), (5, e.upper()), (None, e)]
    kept = texts_of(stages["simhash_near_dedup"](spark, make(rows), SF001))
    assert [(i, t.lower()) for i, t in kept] == sorted([("None", a), ("1", b), ("7", c), ("9", d), ("5", e)])
    rows = [(None, leak), (None, a), (7, b), (7, leak + " " + b), (8, c)]
    assert texts_of(stages["benchmark_decontamination"](spark, make(rows), SF001)) == sorted([("None", a), ("7", b), ("8", c)])
    secret = "token=abcdefghijklmnop"
    rows = [(None, a), (None, secret + " " + b), (None, c + " " + secret), (7, d), (7, secret + e), (7, secret + e)]
    masked = [(None, a), (None, P.MASK + " " + b), (None, c + " " + P.MASK), (7, d)]
    got = texts_of(stages["secret_scans"](spark, make(rows), SF001))
    assert set(got) >= {(str(i), t) for i, t in masked} and len(got) == len(rows) and not any("token" in t for _, t in got)


def test_pipeline_against_its_parts(spark):
    import corpus_pipeline as P
    from eventide.llm.queries import fold

    documents = load_table(spark, SF001, "documents")
    model = toxicity.fit(documents, load_table(spark, SF001, "labels").filter(fold() != 1))
    rows = sorted(documents.collect())
    clean = [r for r, s in zip(rows, model.score([r.text or "" for r in rows], {})) if s < 0.7]
    first = plain_components([r.doc_id for r in clean], [plain_fingerprint(r.text) for r in clean], 4)
    clean = [r for r in clean if first[r.doc_id] == r.doc_id]
    bad = {r.doc_id for r in decontaminate.find_overlaps(documents, load_table(spark, SF001, "benchmark")).collect()}
    clean = [r for r in clean if r.doc_id not in bad]
    from tokenizers import Tokenizer

    tok, want = Tokenizer.from_file(public_tokenizer()), []
    for r in clean:
        out, at = "", 0
        for a, _, e in plain_spans(r.text or ""):
            if a >= at:
                out += r.text[at:a] + P.MASK
            at = max(at, e)
        ids = np.array(tok.encode(out + (r.text or "")[at:], add_special_tokens=False).ids + [1], "<u4")
        want += [(r.doc_id, s, zlib.crc32(ids[s:s + 4096].tobytes())) for s in range(0, len(ids), 4096)]
    got = P.run(spark, SF001).collect()
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in got) == sorted(want)
    assert len(clean) < len(rows)
