"""URL filters: host/path rules first, then a character language-model ratio.

Two smoothed variable-order Markov models, one of accepted and one of rejected
URLs, are counted over all labelled URLs.  Every gram that occurs is in the model,
which is a Spark table and grows with the input: each distinct text is scored once,
in chunks of texts that fetch the counts of their own distinct grams by an equality
join, so a gram that all URLs share is one row a chunk.  A URL's score is the
length-normalised log-likelihood difference (accepted minus rejected); the
threshold is calibrated on a held-out tenth of the labelled URLs so that at most
``false_reject`` of the accepted ones fall below it, and is never above zero.

Edge cases: null URL, URL without ``://`` -> empty host and path, no rule, score 0,
allowed.  With no example of either class the model rejects nothing.  Repeated
URLs count as often as they occur.  Only the URL column is read.
"""

from __future__ import annotations

import math
import string

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.base import by_value, fresh, materialize

# Verdict, host, path; a rule's name is host + path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
# Words of a host that mark a URL as an example of the rejected class.
REJECT_TERMS = ("ad", "ads", "bet", "bets", "casino", "casinos", "pill", "pills", "porn", "xxx")

START, END = "\x02", "\x03"
ALPHABET = 256
CHUNK = 2000  # distinct texts that are scored together


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty where it is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), "^[^?#]*", 0)
    return F.translate(raw, string.ascii_uppercase, string.ascii_lowercase), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(name, verdict) of the longest fitting rule, else nulls."""
    name = verdict = None
    for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    return name, verdict


def model_text(host: Column, path: Column) -> Column:
    """What the models read: host and path in lower case, each run of digits as one ``0``."""
    return F.regexp_replace(F.lower(F.concat(host, path)), "[0-9]+", "0")


def ratio(text: str, grams: dict[str, tuple[int, int]], order: int, alpha: float) -> float:
    """(log P(accepted) - log P(rejected)) / predicted characters, each order interpolated with the shorter one;
    ``grams`` has the (accepted, rejected) counts of all grams of the text that occur in the model."""
    if not text or not grams:
        return 0.0
    s, get = START + text + END, grams.get
    total = 0.0
    for i in range(1, len(s)):
        pa = pr = 1.0 / ALPHABET
        for k in range(min(order, i + 1)):
            ctx = get(s[i - k:i]) if k else get("")
            if ctx is None:
                break
            na, nr = get(s[i - k:i + 1], (0, 0))
            pa = (na + alpha * pa) / (ctx[0] + alpha)
            pr = (nr + alpha * pr) / (ctx[1] + alpha)
        total += math.log(pa) - math.log(pr)
    return total / (len(s) - 1)


def gram_spans(text: Column, order: int) -> Column:
    """Every gram of 0..order characters of a text between its marks, with repetitions."""
    s = F.concat(F.lit(START), text, F.lit(END))
    return F.flatten(F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.transform(
        F.sequence(F.lit(0), F.least(F.lit(order), i)), lambda k: F.substr(s, i - k + 1, k))))


def gram_counts(labelled: DataFrame, order: int) -> DataFrame:
    """(gram, n_accepted, n_rejected) of every gram of 0..order characters over (text, n_accepted, n_rejected).

    Texts are distinct with their multiplicity, so copies cost nothing, and each
    map task sums its grams before they are shuffled."""
    return (labelled.select(F.explode(gram_spans(F.col("text"), order)).alias("gram"), "n_accepted", "n_rejected")
            .groupBy("gram").agg(F.sum("n_accepted").alias("n_accepted"), F.sum("n_rejected").alias("n_rejected")))


def text_scores(texts: DataFrame, counts: DataFrame, order: int, alpha: float, chunk: int = CHUNK) -> DataFrame:
    """(text, score) of distinct texts by a table of gram counts.

    A task holds the grams of one chunk of about ``chunk`` texts; the join sees each distinct gram of a chunk once."""
    n = math.ceil(texts.count() / chunk) or 1
    dealt = texts.select("text", F.pmod(F.xxhash64("text"), F.lit(n)).alias("chunk"))
    asked = (dealt.repartition("chunk").select("chunk", F.explode(F.array_distinct(gram_spans(F.col("text"), order))).alias("gram"))
             .distinct())
    known = asked.join(counts, "gram").select(F.col("chunk").alias("of"), "gram", "n_accepted", "n_rejected")

    def score(part: pd.DataFrame, grams: pd.DataFrame) -> pd.DataFrame:
        model = dict(zip(grams["gram"], zip(grams["n_accepted"].tolist(), grams["n_rejected"].tolist())))
        return pd.DataFrame({"text": part["text"], "score": [ratio(t, model, order, alpha) for t in part["text"]]})

    return dealt.groupBy("chunk").cogroup(known.groupBy("of")).applyInPandas(score, "text string, score double")


def fit_scores(labelled: DataFrame, *, order: int = 5, alpha: float = 2.0, false_reject: float = 0.01) -> tuple[DataFrame | None, float]:
    """((text, score) of every distinct text, threshold) of the models of ``labelled`` (text, accepted boolean): one fold
    in ten, by crc32 of the text, calibrates the threshold.  (None, -inf) where a class has no example.

    Driver data: three sums and one threshold."""
    rows = materialize(labelled.filter(F.col("text") != "").groupBy("text")
                       .agg(F.count(F.when(F.col("accepted"), 1)).alias("n_accepted"),
                            F.count(F.when(~F.col("accepted"), 1)).alias("n_rejected")))
    held = F.pmod(F.crc32(F.col("text").cast("binary")), F.lit(10)) == 0
    train = rows.filter(~held)
    size = train.agg(F.sum("n_accepted").alias("a"), F.sum("n_rejected").alias("r")).first()
    if not size["a"] or not size["r"]:
        return None, -math.inf
    scores = materialize(text_scores(rows, gram_counts(train, order), order, alpha))
    cut = (scores.join(rows.filter(held & (F.col("n_accepted") > 0)).select("text"), "text", "left_semi")
           .agg(F.expr(f"percentile_approx(score, {false_reject}, 10000)").alias("q")).first()["q"])
    return scores, min(0.0, cut) if cut is not None else 0.0


def filter_urls(urls: DataFrame, url_col: str = "url", rules=RULES, reject_terms=REJECT_TERMS, **fit_args) -> DataFrame:
    """All columns of ``urls`` and host, path, rule, verdict, score (an input column of one of these names is replaced).

    Examples for the models: rejected is what a rule blocks or whose host has a
    word of ``reject_terms``; accepted is what remains.  The digits of paths and
    the query string are not read."""
    host, path = url_parts(F.col(url_col))
    cols = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict", "score")]
    ruled, text, of, found = fresh(urls, "_rule_verdict", "_text", "_key", "_score")
    parts = urls.select(*cols, host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = parts.select("*", name.alias("rule"), verdict.alias(ruled),
                          model_text(F.col("host"), F.col("path")).alias(text))
    spam = F.arrays_overlap(F.split("host", "[.-]"), F.array(*[F.lit(t) for t in reject_terms]))
    blocked = F.coalesce(F.col(ruled) == "block", spam)
    allowed = F.coalesce(F.col(ruled) == "allow", F.lit(False))
    scores, threshold = fit_scores(judged.select(F.col(text).alias("text"), (allowed | ~blocked).alias("accepted")), **fit_args)
    if scores is None:
        scored = judged.withColumn("score", F.lit(0.0))
    else:
        named = scores.select(F.col("text").alias(of), F.col("score").alias(found))
        scored = judged.join(named, F.col(text) == F.col(of), "left").withColumn("score", F.coalesce(found, F.lit(0.0)))
    by_model = F.when(F.col("score") < threshold, "block").otherwise("allow")
    return scored.select(*cols, "host", "path", "rule", F.coalesce(ruled, by_model).alias("verdict"), "score")


by_value(__name__)
