"""Quality scores by a generalised additive model with pairwise interactions.

Spark measures every whole text with its own expressions; only numbers go to
Python. The model is fitted on a bounded sample of labelled rows
(``max_train``): rounds of cyclic boosting fit one depth-two tree per feature
to the gradient over that feature's bins and add it, shrunk, to the feature's
lookup table; then the pairs of features that lower the loss most get tables
of their own, boosted the same way. A score is the logistic of a sum of table
entries, read for whole columns at once.

Defined results: a null or empty text has features 0 and a score like any
other; labels that are null are left out; a document labelled several times
counts each time; without labels of both kinds every score is the share of
label 1 (0.5 if there are none); ids may be null and rows repeated; an empty
table gives an empty result; other columns, lang, source and id never enter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import materialise

FEATURES = ("log_chars", "upper", "digit", "symbol", "bang", "punct", "word_length", "distinct_words", "distinct_lines", "letters")
MAX_TRAIN = 40_000  # labelled rows that the model is fitted on
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.15


def features(text: Column) -> list[Column]:
    text = F.coalesce(text, F.lit(""))
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    share = lambda pattern: F.regexp_count(text, F.lit(pattern)) / n
    words = F.split(F.lower(F.trim(text)), r"[\x20\x09-\x0D]+")
    lines = F.split(text, "\n")
    distinct = lambda xs: F.size(F.array_distinct(xs)) / F.size(xs)
    cols = (
        F.log2(F.length(text) + F.lit(1.0)),
        share(r"\p{Lu}"),
        share(r"\p{Nd}"),
        share(r"[\p{S}*%#&@|_/\\]"),
        share(r"!"),
        share(r"[.,;:?]"),
        n / F.size(words),
        distinct(words),
        distinct(lines),
        share(r"\p{Ll}"),
    )
    return [c.cast("double").alias(k) for k, c in zip(FEATURES, cols, strict=True)]


class AdditiveModel:
    """Lookup tables per feature and per pair of features."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        d = x.shape[1] if x.size else len(FEATURES)
        p = min(max(y.mean(), 1e-3), 1 - 1e-3) if len(y) else 0.5
        self.base = float(np.log(p / (1 - p)))
        self.edges = [np.zeros(0)] * d
        self.tables = [np.zeros(1)] * d
        self.pairs: list[tuple[int, int, np.ndarray]] = []
        self.coarse: list[np.ndarray] = [np.zeros(0)] * d
        if len(y) and 0 < y.mean() < 1:
            self.fit(x, y)

    def bins(self, x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(edges)]

    @staticmethod
    def cuts(v: np.ndarray, bins: int) -> np.ndarray:
        """Borders between bins at quantiles of the distinct values, so that rare values are told apart too."""
        u = np.unique(v)
        half = np.concatenate([np.quantile(v, np.linspace(0, 1, bins // 2 + 1)[1:-1]), np.quantile(u, np.linspace(0, 1, bins // 2 + 1)[1:-1])])
        half = np.unique(half)
        nxt = u[np.minimum(np.searchsorted(u, half, side="right"), len(u) - 1)]
        return np.unique((half + nxt) / 2)

    @staticmethod
    def tree(g: np.ndarray, h: np.ndarray, depth: int = 2, least: float = 2.0) -> np.ndarray:
        """A shallow regression tree on a histogram of gradients and curvatures: a value per bin."""
        best, at = 0.0, None
        if depth and len(g) > 1:
            gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
            gr, hr = g.sum() - gl, h.sum() - hl
            gain = np.where((hl > least) & (hr > least), gl**2 / (hl + 1) + gr**2 / (hr + 1) - g.sum() ** 2 / (h.sum() + 1), 0)
            at = int(gain.argmax())
            best = gain[at]
        if best <= 1e-9:
            return np.full(len(g), g.sum() / (h.sum() + 1))
        return np.concatenate([AdditiveModel.tree(g[: at + 1], h[: at + 1], depth - 1), AdditiveModel.tree(g[at + 1 :], h[at + 1 :], depth - 1)])

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        d = x.shape[1]
        self.edges = [self.cuts(x[:, k], BINS) for k in range(d)]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        at, f = self.bins(x, self.edges), np.full(len(y), self.base)
        for _ in range(ROUNDS):
            for k in range(d):  # one tree per feature in turn
                p = 1 / (1 + np.exp(-f))
                g = np.bincount(at[k], y - p, len(self.tables[k]))
                h = np.bincount(at[k], p * (1 - p), len(self.tables[k]))
                step = RATE * self.tree(g, h)
                self.tables[k] += step
                f += step[at[k]]
        self.coarse = [self.cuts(x[:, k], PAIR_BINS) for k in range(d)]
        low = self.bins(x, self.coarse)
        width = [len(e) + 1 for e in self.coarse]
        p = 1 / (1 + np.exp(-f))
        gains = []
        for i in range(d):
            for j in range(i + 1, d):
                cell, n = low[i] * width[j] + low[j], width[i] * width[j]
                g, h = np.bincount(cell, y - p, n), np.bincount(cell, p * (1 - p), n)
                gains.append(((g**2 / (h + 1)).sum(), i, j))
        chosen = [(i, j) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
        self.pairs = [(i, j, np.zeros((width[i], width[j]))) for i, j in chosen]
        for _ in range(PAIR_ROUNDS):
            for i, j, table in self.pairs:
                p = 1 / (1 + np.exp(-f))
                cell, n = low[i] * width[j] + low[j], width[i] * width[j]
                g = np.bincount(cell, y - p, n).reshape(table.shape)
                h = np.bincount(cell, p * (1 - p), n).reshape(table.shape)
                # a cut along i, then one along j in each half
                gi, hi = g.sum(1), h.sum(1)
                half = self.tree(gi, hi, 1)
                cut = int(np.flatnonzero(np.diff(half))[0]) + 1 if np.any(np.diff(half)) else len(half)
                step = np.zeros_like(table)
                for rows in (slice(0, cut), slice(cut, None)):
                    if g[rows].size:
                        step[rows] = RATE * self.tree(g[rows].sum(0), h[rows].sum(0), 1)
                table += step
                f += step[low[i], low[j]]

    def score(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.base)
        for k, b in enumerate(self.bins(x, self.edges)):
            f += self.tables[k][b]
        if self.pairs:
            low = self.bins(x, self.coarse)
            for i, j, table in self.pairs:
                f += table[low[i], low[j]]
        return 1 / (1 + np.exp(-f))


def held_out(id_: Column, folds: int, fold: int) -> Column:
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % folds == fold


def train(measured: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> AdditiveModel:
    """Fit on at most ``max_train`` labelled rows, chosen by a hash of their id and features."""
    known = labels.where("quality is not null").select(F.col("doc_id").alias("l_id"), "quality")
    rows = measured.where(~F.col("held_out")).join(known, F.col("doc_id") == F.col("l_id"))
    total = rows.count()
    if total > max_train:
        u = F.pmod(F.xxhash64("doc_id", *FEATURES), F.lit(1 << 30))  # rows without an id, or with one id, differ by their features
        near = rows.where(u < F.lit(min(1 << 30, int((1 << 30) * 1.2 * max_train / total))))
        rows = near.orderBy(u, "doc_id", *FEATURES, "quality").limit(max_train)
    got = rows.select("doc_id", "quality", *FEATURES).toPandas().sort_values(["doc_id", *FEATURES, "quality"])
    return AdditiveModel(got[list(FEATURES)].to_numpy(float), got["quality"].to_numpy(float))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_train: int = MAX_TRAIN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    measured = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col), 5, 0).alias("held_out"), *features(F.col(text_col)))
    measured = materialise(measured, "quality-features")
    model = train(measured, labels, max_train)
    out = measured.select("doc_id", "held_out").schema.add("score", "double")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            x = np.column_stack([b.column(2 + k).to_numpy(zero_copy_only=False) for k in range(len(FEATURES))])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(model.score(x))], names=["doc_id", "held_out", "score"])

    scored = measured.select("doc_id", "held_out", *FEATURES).mapInArrow(run, out)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
