"""Quality classifier: an additive model with pairwise interactions.

Every text becomes a few numbers (``FEATURES``), computed over the whole text
in Arrow batches. Cyclic boosting fits the model on labelled rows: in each
round every feature in turn gets a shallow tree on its bins, fitted to the
current gradients, whose leaves are added to the feature's lookup table; then
the strongest pairs of features get tables the same way. A score is the
intercept plus one table entry per feature and pair: array lookups by bin.

The fit runs on at most about ``SAMPLE`` labelled rows (a hash sample of
those with a label in the training fold; all of them when there are fewer),
whose features the driver gathers: SAMPLE x len(FEATURES) numbers. Scoring
covers all rows and shuffles nothing. Labels, language, source and id are
not inputs of a score.

Results on odd input: null and empty texts score like any text (all features
0); a document with several labels has their mean, rounded (0.5 to 1); rows
without label, or whose label is null, are only scored; repeated rows are
scored each; with no usable label every score is 0.5; with one class the score
tends to that class; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import crc_mod

SAMPLE = 40_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 120
RATE = 0.15
SHRINK = 1.0
LEAST_ROWS = 10
FEATURES = ["log_chars", "log_words", "word_length", "distinct_words", "distinct_bigrams", "top_word",
            "adjacent_same", "upper", "digits", "symbols", "bare_symbols", "symbol_ends", "capitalised",
            "sentence_ends", "distinct_lines", "words_per_line"]

_CLASS = np.zeros(256, np.int64)  # 1 upper, 2 digit, 3 symbol, 0 other
_CLASS[65:91], _CLASS[48:58] = 1, 2
for _a, _b in ((33, 48), (58, 65), (91, 97), (123, 127)):
    _CLASS[_a:_b] = 3


def features(text: str) -> list[float]:
    """The numbers of one text, in the order of FEATURES."""
    words = text.split()
    n = len(words)
    if not n:
        return [math.log1p(len(text))] + [0.0] * (len(FEATURES) - 1)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    kinds = np.bincount(_CLASS[raw], minlength=4)
    lines = [x for x in text.split("\n") if x]
    ends = [w[-1] for w in words]
    return [math.log1p(len(text)), math.log1p(n), len(text) / n, len(set(words)) / n,
            len(set(zip(words, words[1:], strict=False))) / n, max(Counter(words).values()) / n,
            sum(map(eq, words, words[1:])) / n, kinds[1] / len(raw), kinds[2] / len(raw), kinds[3] / len(raw),
            sum(not w[0].isalnum() and not w[-1].isalnum() for w in words) / n,
            sum(e in "!#$%&*|~^" for e in ends) / n, sum(w[0].isupper() for w in words) / n,
            sum(e in ".?!" for e in ends) / n, len(set(lines)) / len(lines), n / len(lines)]


def feature_matrix(texts: pd.Series) -> np.ndarray:
    return np.array([features(t or "") for t in texts], np.float64).reshape(-1, len(FEATURES))


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int) -> np.ndarray:
    """Leaf value per bin of a shallow tree over ordered bins (sums of gradient, curvature, rows)."""
    leaf = np.full(len(g), -g.sum() / (h.sum() + SHRINK))
    if depth == 0 or len(g) < 2:
        return leaf
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gr, hr, nr = g.sum() - gl, h.sum() - hl, n.sum() - nl
    gain = gl ** 2 / (hl + SHRINK) + gr ** 2 / (hr + SHRINK) - g.sum() ** 2 / (h.sum() + SHRINK)
    gain[(nl < LEAST_ROWS) | (nr < LEAST_ROWS)] = -1
    at = int(gain.argmax())
    if gain[at] <= 1e-9:
        return leaf
    return np.r_[_tree(g[:at + 1], h[:at + 1], n[:at + 1], depth - 1),
                 _tree(g[at + 1:], h[at + 1:], n[at + 1:], depth - 1)]


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Values of a two-level tree on a grid: one split of the rows, one of the columns on each side."""
    best, out = -1.0, np.full(g.shape, -g.sum() / (h.sum() + SHRINK))
    for turned in (False, True):
        a, b, c = (x.T if turned else x for x in (g, h, n))
        for cut in range(1, len(a)):
            value = np.empty(a.shape)
            for part in (slice(0, cut), slice(cut, None)):
                value[part] = _tree(a[part].sum(0), b[part].sum(0), c[part].sum(0), 1)[None, :]
            gain = -(a * value + 0.5 * (b + SHRINK / a.size) * value ** 2).sum()
            if gain > best + 1e-12:
                best, out = gain, (value.T if turned else value).copy()
    return out


class AdditiveModel:
    """Intercept, bin edges, one table per feature, and tables for some pairs."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) if len(c) else np.zeros(0)
                      for c in x.T]
        self.coarse = [np.unique(np.quantile(c, np.linspace(0, 1, PAIR_BINS + 1)[1:-1])) if len(c) else np.zeros(0)
                       for c in x.T]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        rate = (y.sum() + 0.5) / (len(y) + 1)
        self.intercept = math.log(rate / (1 - rate))
        if len(y):
            self._fit(x, y)

    @staticmethod
    def bins(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, c, "right") for e, c in zip(edges, x.T, strict=True)]

    def _fit(self, x, y):
        bins, total = self.bins(x, self.edges), np.full(len(y), self.intercept)

        def slopes():
            p = 1 / (1 + np.exp(-total))
            return p - y, p * (1 - p)

        for _ in range(ROUNDS):
            for f, b in enumerate(bins):
                g, h = slopes()
                size = len(self.tables[f])
                step = RATE * _tree(np.bincount(b, g, size), np.bincount(b, h, size),
                                    np.bincount(b, minlength=size), 2)
                self.tables[f] += step
                total += step[b]
        grid = self.bins(x, self.coarse)

        def sums(i, j):
            g, h = slopes()
            shape = (len(self.coarse[i]) + 1, len(self.coarse[j]) + 1)
            at = grid[i] * shape[1] + grid[j]
            return at, [np.bincount(at, w, shape[0] * shape[1]).reshape(shape) for w in (g, h, np.ones(len(y)))]

        gains = []
        for i in range(len(grid)):
            for j in range(i):
                _, (g, h, n) = sums(i, j)
                v = _pair_tree(g, h, n)
                gains.append((float((g * v + 0.5 * h * v * v).sum()), i, j))
        self.pairs = [(i, j, np.zeros((len(self.coarse[i]) + 1, len(self.coarse[j]) + 1)))
                      for _, i, j in sorted(gains)[:PAIRS]]
        for _ in range(ROUNDS // 4):
            for i, j, table in self.pairs:
                at, (g, h, n) = sums(i, j)
                step = RATE * _pair_tree(g, h, n)
                table += step
                total += step.ravel()[at]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1: additions of table entries by bin."""
        total = np.full(len(x), self.intercept)
        for b, table in zip(self.bins(x, self.edges), self.tables, strict=True):
            total += table[b]
        grid = self.bins(x, self.coarse)
        for i, j, table in self.pairs:
            total += table[grid[i], grid[j]]
        return 1 / (1 + np.exp(-total))


def _featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"y": pdf["y"], "x": list(feature_matrix(pdf["text"]))})


def training_sample(docs: DataFrame, labels: DataFrame, train: Column, label: str = "quality", key: str = "doc_id",
                    text: str = "text", sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a hash sample of the labelled documents; ``train`` is a condition on the id."""
    known = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & train)
             .groupBy(F.col(key).alias("id")).agg((F.avg(F.col(label)) >= 0.5).cast("int").alias("y")))
    u = F.pmod(F.xxhash64("id", F.lit("quality")), F.lit(1 << 30))
    n, share = known.count(), 1.0
    while n > sample:  # the bound of what is broadcast and gathered, checked by a count
        share *= 0.98 * sample / n
        n = known.where(u < int(share * (1 << 30))).count()
    known = known.where(u < int(share * (1 << 30)))
    rows = (docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(known), "id")
            .select("y", "text").mapInPandas(_featurise, "y int, x array<double>").toArrow())
    x = np.array(rows["x"].to_pylist(), np.float64).reshape(-1, len(FEATURES))
    return x, rows["y"].to_numpy().astype(np.float64)


def scorer(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
           folds: int = 5, held: int = 0) -> Column:
    """A column: the score of the text of a row, by a model learned outside the held-out fold of ``docs``."""
    x, y = training_sample(docs, labels, crc_mod(key, folds) != held, label, key, text)
    model = AdditiveModel(x, y) if len(y) else None

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(np.full(len(texts), 0.5) if model is None else model.score(feature_matrix(texts)))

    return score(F.coalesce(F.col(text), F.lit("")))


def quality_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", threshold: float = 0.3, folds: int = 5,
                   held: int = 0, **names) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``."""
    score = scorer(docs, labels, key, folds=folds, held=held, **names)
    out = docs.select(F.col(key).alias("doc_id"), (crc_mod(key, folds) == held).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **names) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``."""
    return docs.where(scorer(docs, labels, **names) >= threshold)
