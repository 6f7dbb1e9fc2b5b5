"""Quality rules with robust multivariate outliers, with DataFrame functions only.

Each document's transformed statistics (log length, mean word length, symbol,
repeated-line and repeated-word shares) are held against a minimum-covariance-
determinant estimate of its language and source: starting from medians and
quartile ranges, concentration steps re-estimate centre and covariance from the
three quarters of the group that lie nearest, and squared Mahalanobis distances
are scaled so that their median is that of chi-square.  A group is only ever seen
through sums and percentile sketches that map tasks build before shuffling, so a
source with a third of all rows costs no task more than another.

The same estimate is made of every language and of all rows too,
and each one counts as ``prior_rows`` rows in the estimates below it: a source of n documents
has n / (n + prior_rows) of its own centre, covariance and (logarithmic) median distance
and the rest of its language's, whose own share is found alike.  So no group is too small
to be judged, and nothing switches at a size.

Edge cases: null text is empty; null language or source is a group of its own;
rows with equal ids are separate documents; ties at the quantile
stay in the subset; an empty table gives an empty result.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.base import SPACE, materialize

SYMBOLS = "#*$%&|<>"
FEATURES = ("f_words", "f_length", "f_symbols", "f_lines", "f_repeats")
# Smallest spread that a feature is taken to have, in its own (transformed) units.
FLOOR = {"f_words": 0.25, "f_length": 0.25, "f_symbols": 0.05, "f_lines": 0.08, "f_repeats": 0.08}
CHI2_MEDIAN_5 = 4.3515
GROUP = ("_level", "_lang", "_source")  # level 0 is all rows, 1 a language, 2 a language and source


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
               source_col: str = "source") -> DataFrame:
    """doc_id, _lang, _source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of every whole text.

    Repeated three-word windows are found by sorting their 64-bit hashes within the
    document (only in documents that have an equal pair), so a text costs n log n."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("_lang"),
                    F.col(source_col).cast("string").alias("_source"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: F.length(F.translate(x, " \t\x0b\x0c\r", "")) > 0)
    d = d.select("doc_id", "_lang", "_source", F.filter(F.split("_text", SPACE, -1), lambda x: x != "").alias("_w"), lines.alias("_lines"),
                 F.length(F.translate("_text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
                 (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"))
    w, n = F.col("_w"), F.size("_w")
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])))
    d = d.select("doc_id", "_lang", "_source", "word_chars", "n_symbols", n.cast("long").alias("n_words"),
                 (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"), windows.alias("_h"))
    some = F.size("_h") > F.size(F.array_distinct("_h"))
    d = d.withColumn("_s", F.when(some, F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("_s")
    equal = lambda j, k: F.coalesce(F.get(s, j)["h"] == F.get(s, k)["h"], F.lit(False))
    twice = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: equal(j, j - 1) | equal(j, j + 1))
    cover = F.flatten(F.transform(twice, lambda j: F.array(s[j]["i"], s[j]["i"] + 1, s[j]["i"] + 2)))
    return d.select("doc_id", "_lang", "_source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    F.when(s.isNotNull(), F.size(F.array_distinct(cover))).otherwise(0).cast("long").alias("n_repeat_words"))


def features(stats: DataFrame) -> DataFrame:
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return stats.withColumns({
        "f_words": F.log1p("n_words"), "f_length": F.col("word_chars") / words,
        "f_symbols": F.sqrt(F.col("n_symbols") / chars),
        "f_lines": F.sqrt(F.least(F.lit(1.0), F.col("n_dup_lines") / words)),
        "f_repeats": F.sqrt(F.col("n_repeat_words") / words)})


def _levels(rows: DataFrame) -> DataFrame:
    """``rows`` each once for all rows, its language, and language and source."""
    none = F.lit(None).cast("string")
    group = lambda level, lang, source: F.struct(F.lit(level).alias("_level"), lang.alias("_lang"), source.alias("_source"))
    each = F.explode(F.array(group(0, none, none), group(1, F.col("_lang"), none), group(2, F.col("_lang"), F.col("_source"))))
    return rows.select(*FEATURES, each.alias("_g")).select("_g.*", *FEATURES)


def _with_group(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with the columns of their group in ``groups``; null languages and sources are groups like any other."""
    named = groups.withColumnsRenamed({"_level": "_gv", "_lang": "_gl", "_source": "_gs"})
    return rows.join(named, (rows["_level"] == F.col("_gv")) & rows["_lang"].eqNullSafe(F.col("_gl"))
                     & rows["_source"].eqNullSafe(F.col("_gs")), "left").drop("_gv", "_gl", "_gs")


def _toward_parents(groups: DataFrame, values: list[str], prior_rows: int) -> DataFrame:
    """``groups`` with ``values`` mixed with those of the level above, which count as ``prior_rows`` rows."""
    groups = materialize(groups)
    own = F.col("n") / (F.col("n") + prior_rows)
    out = above = groups.filter("_level = 0")
    for level in (1, 2):
        part = groups.filter(F.col("_level") == level)
        named = above.select(F.col("_lang").alias("_pl"), *[F.col(v).alias(f"up_{v}") for v in values])
        joined = part.join(named, part["_lang"].eqNullSafe(F.col("_pl"))) if level == 2 else part.crossJoin(named)
        mixed = {v: own * F.col(v) + (1 - own) * F.col(f"up_{v}") for v in values}
        above = joined.select(*[mixed[c].alias(c) if c in mixed else c for c in groups.columns])
        out = out.unionByName(above)
    return out


def _distance(model: DataFrame, rows: DataFrame, *keep: str) -> DataFrame:
    """``rows`` with ``keep`` of the model and d2, the squared Mahalanobis distance (null where the group has no
    model): L z = x - m by forward substitution, d2 = |z|^2."""
    out = _with_group(rows, model)
    for i, f in enumerate(FEATURES):
        known = [F.col(f"l{i}{j}") * F.col(f"z{j}") for j in range(i)]
        out = out.withColumn(f"z{i}", reduce(operator.sub, known, F.col(f) - F.col(f"m{i}")) / F.col(f"l{i}{i}"))
    d2 = reduce(operator.add, [F.col(f"z{i}") * F.col(f"z{i}") for i in range(len(FEATURES))])
    return out.select(*rows.columns, *keep, d2.alias("d2"))


def _cholesky(moments: DataFrame) -> DataFrame:
    """(m, c) columns of a group -> (m, l): lower factor of the covariance, its diagonal raised by the floors."""
    p, out = len(FEATURES), moments
    for j in range(p):
        rest = lambda i: reduce(operator.sub, [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)], F.col(f"c{j}{i}"))  # noqa: E731, B023
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(rest(j) + F.lit(FLOOR[FEATURES[j]] ** 2), F.lit(1e-12))))
        for i in range(j + 1, p):
            out = out.withColumn(f"l{i}{j}", rest(i) / F.col(f"l{j}{j}"))
    return out.select(*GROUP, "n", *[f"m{i}" for i in range(p)], *[f"l{i}{j}" for i in range(p) for j in range(i + 1)])


def fit(rows: DataFrame, *, steps: int = 3, share: float = 0.75, prior_rows: int = 50) -> DataFrame:
    """One row per group: n, centre, factor and the scale of d2; each step is two aggregates over all rows."""
    p = len(FEATURES)
    rows = _levels(rows)
    moments = [f"m{i}" for i in range(p)] + [f"c{j}{i}" for j in range(p) for i in range(j, p)]
    first = rows.groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n"), *[F.percentile_approx(f, [0.25, 0.5, 0.75], 2000).alias(f"q{i}") for i, f in enumerate(FEATURES)])
    model = materialize(_cholesky(_toward_parents(first.select(
        *GROUP, "n", *[F.col(f"q{i}")[1].alias(f"m{i}") for i in range(p)],
        *[(((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349) ** 2 if i == j else F.lit(0.0)).alias(f"c{j}{i}")
          for j in range(p) for i in range(j, p)]), moments, prior_rows)))
    def sketch(model: DataFrame, at: float, name: str) -> DataFrame:
        """The model with each group's quantile of d2 as a further column."""
        cuts = (_distance(model, rows).filter(F.col("d2").isNotNull()).groupBy(*GROUP)
                .agg(F.percentile_approx("d2", at, 2000).alias(name)))
        return materialize(_with_group(model, cuts))

    for _ in range(steps):
        inside = _distance(sketch(model, share, "cut"), rows, "n", "cut").filter(F.col("d2") <= F.col("cut"))
        model = materialize(_cholesky(_toward_parents(inside.groupBy(*GROUP).agg(
            F.first("n").alias("n"), *[F.avg(f).alias(f"m{i}") for i, f in enumerate(FEATURES)],
            *[F.covar_pop(FEATURES[j], FEATURES[i]).alias(f"c{j}{i}") for j in range(p) for i in range(j, p)]), moments, prior_rows)))
    scaled = sketch(model, 0.5, "median")
    logs = _toward_parents(scaled.withColumn("median", F.log(F.greatest("median", F.lit(1e-6)))), ["median"], prior_rows)
    return materialize(logs.withColumn("median", F.exp("median")))


def judge(docs: DataFrame, *, cutoff: float = 100.0, steps: int = 3, share: float = 0.75, prior_rows: int = 50,
          **columns: str) -> DataFrame:
    """Statistics, base_failed, d2 (scaled; null without an estimate) and kept, one row per document.

    The text is parsed once: the narrow statistics are written to the shared folder and every
    later step reads those.  ``cutoff`` is a squared distance; it lies far beyond the
    chi-square quantiles because the statistics of clean prose have heavy tails (figures in
    the README)."""
    rows = materialize(features(statistics(docs, **columns)))
    model = fit(rows, steps=steps, share=share, prior_rows=prior_rows)
    d2 = F.col("d2") * CHI2_MEDIAN_5 / F.greatest("median", F.lit(1e-6))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (_distance(model, rows.withColumn("_level", F.lit(2)), "median").withColumn("d2", d2).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("d2") <= cutoff, F.lit(True)))
            .withColumnsRenamed({"_lang": "lang", "_source": "source"}).drop("median", "_level"))
