"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word's vector is the mean of the vectors of its character 3- to 5-grams (with
word boundaries) and of itself, all hashed into ``BUCKETS`` rows; a passage of
``PASSAGE`` words is the mean of its words; a linear softmax on top is trained
together with the vectors, so a misspelling that was never seen shares most of its
grams with known forms.  A document is as toxic as its worst passages (the log of
the mean exponential of their margins), so one insult weighs the same in a long
text as in a short one.  A second, validation part of the sample sets the offset and
scale that turn the margin into a score, so that 0.7 is the cut that served it best.

Since everything below the pooling is a mean, a trained model scores with one
number per bucket: the fitted model is two arrays of fixed size whatever the corpus,
and scoring is one pass over the text with no shuffle.

Training reads at most ``per_class`` labelled documents of each class (smallest hash
of the id first) of at most ``train_chars`` characters; scoring reads every whole text.

Edge cases: null and empty texts, and texts without a word, score as the median harmless text; with no example of
one class every score is 0; rows with equal ids are scored each for itself.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.base import by_value

BUCKETS = 1 << 17
STRIP = ".,;:!?\"'()[]{}*#%&$|<>-_/"
PASSAGE = 16
KNOWN_WORDS = 300_000  # words whose number a worker remembers before it starts afresh


def subwords(word: str) -> list[int]:
    """Buckets of a word: itself and its 3- to 5-grams between boundary marks."""
    b = f"<{word}>"
    grams = [b] + [b[i:i + n] for n in (3, 4, 5) for i in range(len(b) - n + 1) if n < len(b)]
    return [zlib.crc32(g.encode("utf-8", "replace")) % BUCKETS for g in grams]


def words_of(text: str) -> list[str]:
    return [w for x in text.lower().split() if (w := x.strip(STRIP))]


@dataclass
class ToxicModel:
    weight: np.ndarray  # one number per bucket
    bias: float = 0.0
    scale: float = 1.0
    offset: float = 0.0
    trained: bool = True
    empty: float = 0.0  # margin of a text without words

    def margin(self, texts: list[str], known: dict[str, float]) -> np.ndarray:
        out = np.full(len(texts), self.empty)
        weight = self.weight
        for k, t in enumerate(texts):
            ws = words_of(t)
            if len(known) > KNOWN_WORDS:
                known.clear()
            for w in ws:
                if w not in known:
                    ids = subwords(w)
                    known[w] = float(weight[ids].sum()) / len(ids)
            if ws:
                vals = np.fromiter(map(known.__getitem__, ws), np.float64, len(ws))
                cuts = np.arange(0, len(ws), PASSAGE)
                each = np.add.reduceat(vals, cuts) / np.diff(np.append(cuts, len(ws)))
                top = each.max()
                out[k] = self.bias + top + np.log(np.exp(each - top).mean())
        return out

    def score(self, texts: list[str], known: dict[str, float]) -> np.ndarray:
        if not self.trained:
            return np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(self.scale * (self.margin(texts, known) - self.offset), -30, 30)))


class Sample:
    """Texts as word numbers: passages of documents, words of passages, buckets of words, each as run starts."""

    def __init__(self, texts: list[str]):
        number: dict[str, int] = {}
        docs, passages, words = [0], [0], []
        for t in texts:
            own = [number.setdefault(w, len(number)) for w in words_of(t)]
            words.append(np.array(own, dtype=np.int32))
            base = passages[-1]
            passages += [base + min(at + PASSAGE, len(own)) for at in range(0, len(own), PASSAGE)]
            docs.append(len(passages) - 1)
        self.docs, self.passages = np.array(docs), np.array(passages)
        self.words = np.concatenate(words) if words else np.zeros(0, np.int32)
        flat, starts = array("i"), array("q", [0])
        for w in number:
            flat.extend(subwords(w))
            starts.append(len(flat))
        self.starts, self.buckets = np.array(starts, dtype=np.int64), np.array(flat, dtype=np.int32)


def spread(starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the entries of ``rows`` in a run-length layout, and for each the row's place in ``rows``."""
    n = starts[rows + 1] - starts[rows]
    at = np.repeat(starts[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return at, np.repeat(np.arange(len(rows)), n)


def gradients(data: Sample, docs: np.ndarray, y: np.ndarray, balance: np.ndarray, emb: np.ndarray, top: np.ndarray, bias: np.ndarray) -> tuple:
    """(loss, buckets, their vectors, gradients of these, of the classifier and of its bias) of the balanced cross-entropy of
    ``docs``: softmax of the document's margin, the log-mean-exp of its passages' margins."""
    passages, doc_of = spread(data.docs, docs)
    at, row = spread(data.passages, passages)
    size = np.bincount(row, minlength=len(passages))
    words, word_of = np.unique(data.words[at], return_inverse=True)
    at, sub_of = spread(data.starts, words)
    grams = (data.starts[words + 1] - data.starts[words]).astype(np.float64)
    u, inv = np.unique(data.buckets[at], return_inverse=True)
    grid, dim = emb[u], emb.shape[1]
    vectors = np.stack([np.bincount(sub_of, grid[inv, j], len(words)) for j in range(dim)], 1) / grams[:, None]
    x = np.stack([np.bincount(row, vectors[word_of, j], len(passages)) for j in range(dim)], 1) / size[:, None]
    z = x @ top + bias
    m = z[:, 1] - z[:, 0]
    peak = np.full(len(docs), -np.inf)
    np.maximum.at(peak, doc_of, m)
    e = np.exp(m - peak[doc_of])
    total = np.bincount(doc_of, e, len(docs))
    margin = np.clip(peak + np.log(total / np.bincount(doc_of, minlength=len(docs))), -30, 30)
    p = 1 / (1 + np.exp(-margin))
    loss = float((balance[docs] * (np.logaddexp(0, margin) - y[docs] * margin)).sum() / len(docs))
    gm = ((p - y[docs]) * balance[docs] / len(docs))[doc_of] * e / total[doc_of]
    g = np.stack([-gm, gm], 1)
    gx = (g @ top.T) / size[:, None]
    gw = np.stack([np.bincount(word_of, gx[row, j], len(words)) for j in range(dim)], 1) / grams[:, None]
    gu = np.stack([np.bincount(inv, gw[sub_of, j], len(u)) for j in range(dim)], 1)
    return loss, u, grid, gu, x.T @ g, g.sum(0)


def train(texts: list[str], toxic: np.ndarray, *, prevalence: float | None = None, dim: int = 8, visits: int = 40_000, batch: int = 128, rate: float = 0.02,
          decay: float = 1e-5, seed: int = 7) -> ToxicModel:
    """Adam on softmax cross-entropy, vectors and classifier together, over about ``visits`` documents (30 rounds at
    most, 40 steps a round at least where there are texts for them); a fifth of the sample is kept for validation."""
    if not len(texts) or not toxic.any() or toxic.all():
        return ToxicModel(np.zeros(BUCKETS), trained=False)
    rng = np.random.default_rng(seed)
    data = Sample(texts)
    order = rng.permutation(len(texts))
    valid, fit = order[:len(order) // 5], order[len(order) // 5:]
    emb = rng.normal(0, 0.1, (BUCKETS, dim))
    top, bias = rng.normal(0, 0.5, (dim, 2)), np.zeros(2)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (emb, top, bias)]
    y = toxic.astype(np.float64)
    balance = np.where(toxic, 0.5 / toxic.mean(), 0.5 / (1 - toxic.mean()))
    tick = 0
    fit = fit[data.docs[fit + 1] > data.docs[fit]]
    batch = max(16, min(batch, len(fit) // 40))
    for _ in range(min(30, max(1, round(visits / max(1, len(fit)))))):
        for docs in np.array_split(rng.permutation(fit), max(1, len(fit) // batch)):
            _, u, grid, gu, gt, gb = gradients(data, docs, y, balance, emb, top, bias)
            tick += 1
            for p_, (m1, m2), grad, part in ((emb, state[0], gu + decay * grid, u), (top, state[1], gt, slice(None)),
                                             (bias, state[2], gb, slice(None))):
                m1[part] = 0.9 * m1[part] + 0.1 * grad
                m2[part] = 0.99 * m2[part] + 0.01 * grad * grad
                p_[part] -= rate * (m1[part] / (1 - 0.9 ** tick)) / (np.sqrt(m2[part] / (1 - 0.99 ** tick)) + 1e-8)
    side = top[:, 1] - top[:, 0]
    model = ToxicModel(emb @ side, float(bias[1] - bias[0]))
    known: dict[str, float] = {}
    return calibrate(model, model.margin([texts[i] for i in valid], known), toxic[valid], prevalence)


def calibrate(model: ToxicModel, margins: np.ndarray, toxic: np.ndarray, prevalence: float | None) -> ToxicModel:
    """Put score 0.7 at the margin with the best F1 on the validation part (midway to the next lower one), each class
    weighted to its share of all labels: the sample holds more toxic texts than the corpus."""
    if not toxic.any() or toxic.all():
        return model
    share = toxic.mean() if prevalence is None else prevalence
    weight = np.where(toxic, share / toxic.mean(), (1 - share) / (1 - toxic.mean()))
    order = np.argsort(-margins)
    hit = np.cumsum((weight * toxic)[order])
    f1 = 2 * hit / (np.cumsum(weight[order]) + (weight * toxic).sum())
    best = int(f1.argmax())
    ranked = margins[order]
    cut = (ranked[best] + ranked[min(best + 1, len(ranked) - 1)]) / 2
    model.empty = float(np.median(margins[~toxic]))
    model.scale = 4.0 / max(float(np.std(margins)), 1e-6)
    model.offset = float(cut) - np.log(0.7 / 0.3) / model.scale
    return model


def score_column(model: ToxicModel, text: Column) -> Column:
    """Score of a text column (null: empty), from 0 to 1."""
    shared = SparkSession.active().sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, float] = {}
        for s in batches:
            yield pd.Series(shared.value.score(s.fillna("").tolist(), known))

    return score(text)


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        per_class: int = 3000, train_chars: int = 20_000, **train_args) -> ToxicModel:
    """Train on a bounded sample of ``labels`` (id, 0/1).  The ids are picked first (two top-k lists of ``per_class``),
    so the corpus is scanned once and never shuffled; of the rows of a picked id the smallest text is taken, so the
    driver holds at most 2 * ``per_class`` texts.  Null ids, null texts and labels other than 0 and 1 are not learnt from; further
    columns are not read."""
    docs = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    eligible = labels.select(F.col(id_col).alias("_lid"), F.col(label_col).cast("int").alias("_y")).filter("_lid IS NOT NULL")
    total = {r[0]: r[1] for r in eligible.filter("_y IN (0, 1)").groupBy("_y").count().collect()}
    picked = [eligible.filter(F.col("_y") == y).dropDuplicates(["_lid"]).orderBy(F.xxhash64("_lid"), "_lid").limit(per_class) for y in (0, 1)]
    sample = (docs.filter(F.length("_text") <= train_chars)
              .join(F.broadcast(picked[0].unionByName(picked[1])), F.col("_id") == F.col("_lid"))
              .groupBy("_lid", "_y").agg(F.min("_text").alias("_t")).select("_lid", "_t", "_y"))
    rows = sorted(sample.collect())
    prevalence = total.get(1, 0) / max(1, sum(total.values()))
    return train([r[1] for r in rows], np.array([r[2] for r in rows], dtype=bool), prevalence=prevalence, **train_args)


by_value(__name__)
