"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature has a look-up table over its quantile bins, and a few pairs of
features have one over coarser bins. Training is cyclic gradient boosting of
shallow trees on the logistic loss: round after round each feature in turn
gets one tree of at most three leaves, fitted to the gradient's histogram and
added, scaled down, to its table; then the pairs that explain most of what is
left are boosted the same way with trees of one cut an axis. A held-back part
of the training rows ends the rounds. A score is the sum of one table entry a
feature and pair, through the logistic function: bin look-ups and additions
over whole columns.

The features come from the whole text alone (never labels, language, source or
id) and are computed in the row, without shuffle. Training uses at most
``max_rows`` labelled rows, chosen by key hash, so the fit and what
reaches the driver are bounded; scoring covers every row.

Defined cases: null and empty texts have zero features and get a score like
any other; repeated rows score alike, each on its own; labels that are null or
belong to no document are unused; with no usable labels, or one class only,
every score is the training share of class 1 (0.5 without rows); an empty
table gives an empty result; clashing columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlab.llm.common import bounded_sample, table, written
from basketlab.llm.quality_rules import text_counts

MAX_ROWS = 50_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
RATE, ROUNDS, PATIENCE, SMOOTH = 0.15, 400, 12, 5.0
THRESHOLD = 0.7


def _share(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)


def features() -> dict[str, Column]:
    """The model's inputs, from the counts of a text."""
    return {
        "log_words": F.log1p("n_words"),
        "word_length": _share("word_chars", "n_words"),
        "symbols": _share("n_symbols", "n_words"),
        "copied_lines": _share("n_dup_lines", "n_lines"),
        "repetition": _share("n_repeat_words", "n_words"),
        "upper": _share("n_upper", "word_chars"),
        "loud": _share("n_loud", "n_words"),
        "digits": _share("n_digits", "word_chars"),
        "distinct": _share("n_distinct", "n_words"),
        "ended": _share("n_ended", "n_lines"),
        "line_words": _share("n_words", "n_lines"),
    }


NAMES = tuple(("log_words", "word_length", "symbols", "copied_lines", "repetition", "upper", "loud", "digits", "distinct", "ended", "line_words"))


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Newton steps by bin of the best tree of up to three leaves over ordered bins."""

    def cut(a: int, b: int) -> tuple[float, int]:
        gs, hs = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
        if not len(gs):
            return 0.0, a
        gt, ht = g[a:b].sum(), h[a:b].sum()
        gain = gs**2 / (hs + SMOOTH) + (gt - gs) ** 2 / (ht - hs + SMOOTH) - gt**2 / (ht + SMOOTH)
        k = int(gain.argmax())
        return float(gain[k]), a + k + 1

    n = len(g)
    _, first = cut(0, n)
    (left, at_left), (right, at_right) = cut(0, first), cut(first, n)
    ends = sorted({0, first, at_left if left >= right else at_right, n})
    out = np.zeros(n)
    for a, b in zip(ends, ends[1:], strict=False):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + SMOOTH)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Newton steps by cell of the best tree with one cut on either axis, and its gain."""
    gc, hc = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    parts = []
    for c in (gc, hc):
        a = c[:-1, :-1]
        top, side, whole = c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        parts.append((a, top - a, side - a, whole - top - side + a))
    gain = sum(x**2 / (y + SMOOTH) for x, y in zip(*parts, strict=True)) - gc[-1, -1] ** 2 / (hc[-1, -1] + SMOOTH)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.empty_like(g)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for cols in (slice(0, j + 1), slice(j + 1, None)):
            out[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + SMOOTH)
    return out, float(gain[i, j])


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))


@dataclass
class Gam:
    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        s = np.full(len(x), self.intercept)
        for j, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            s += t[np.searchsorted(e, x[:, j], side="right")]
        if self.pairs:
            coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.pair_edges)]
            for i, j, t in self.pairs:
                s += t[coarse[i], coarse[j]]
        return s

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _loss(s: np.ndarray, y: np.ndarray) -> float:
    return float(np.logaddexp(0, np.where(y > 0, -s, s)).mean())


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """``x``: rows by features; ``y``: 0 or 1. Every eighth row is held back to end the rounds."""
    n = len(y)
    if n == 0 or y.min() == y.max():
        share = float((y.sum() + 1) / (n + 2))
        return Gam(float(np.log(share / (1 - share))), [np.zeros(0)] * x.shape[1], [np.zeros(1)] * x.shape[1])
    back = np.arange(n) % 8 == 7
    back &= n >= 64
    base = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
    model = Gam(float(np.log(base / (1 - base))))
    model.edges = [_edges(x[:, j], BINS) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    model.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    fine = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.pair_edges)]
    w = (~back).astype(float)
    s = np.full(n, model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-s))
        return w * (y - p), w * p * (1 - p)

    def boost(parts: list[tuple[np.ndarray, np.ndarray, tuple[int, ...]]], grow) -> None:
        """Cyclic rounds over (cell of each row, table, shape); the best round's tables stay."""
        nonlocal s
        watch = back if back.any() else ~back
        best, best_tables, since = _loss(s[watch], y[watch]), [t.copy() for _, t, _ in parts], 0
        for _ in range(ROUNDS):
            for cell, t, shape in parts:
                g, h = slopes()
                size = int(np.prod(shape))
                step = RATE * grow(np.bincount(cell, g, size).reshape(shape), np.bincount(cell, h, size).reshape(shape))
                t += step
                s = s + step.ravel()[cell]
            now = _loss(s[watch], y[watch])
            if now < best - 1e-6:
                best, best_tables, since = now, [t.copy() for _, t, _ in parts], 0
            else:
                since += 1
                if since >= PATIENCE:
                    break
        for (cell, t, _), kept in zip(parts, best_tables, strict=True):
            s = s + (kept - t).ravel()[cell]
            t[...] = kept

    boost([(fine[j], t, t.shape) for j, t in enumerate(model.tables) if len(t) > 1], _tree)
    g, h = slopes()
    found = []
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            shape = (len(model.pair_edges[i]) + 1, len(model.pair_edges[j]) + 1)
            if min(shape) > 1:
                cell = coarse[i] * shape[1] + coarse[j]
                size = shape[0] * shape[1]
                gain = _pair_tree(np.bincount(cell, g, size).reshape(shape), np.bincount(cell, h, size).reshape(shape))[1]
                found.append((gain, i, j, cell, shape))
    found.sort(key=lambda f: -f[0])
    parts = [(cell, np.zeros(shape), shape) for _, _, _, cell, shape in found[:PAIRS]]
    if parts:
        boost(parts, lambda g, h: _pair_tree(g, h)[0])
        model.pairs = [(i, j, t) for (_, i, j, _, _), (_, t, _) in zip(found, parts, strict=False)]
    return model


def train(featured: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", max_rows: int = MAX_ROWS) -> Gam:
    """Fits on at most ``max_rows`` rows of ``featured`` that ``labels`` (key, label) marks."""
    marked = labels.where(F.col(label).isin(0, 1)).select(F.col(key), F.col(label).alias("_y"))
    rows = featured.join(marked, key).select(*NAMES, "_y", F.xxhash64(F.col(key)).alias("_o"))
    x = bounded_sample(rows, max_rows, "_o", "_y", *NAMES).drop("_o").toPandas()
    return fit(x[list(NAMES)].to_numpy(float), x["_y"].to_numpy(float))


def scored(featured: DataFrame, model: Gam) -> DataFrame:
    """``featured`` with ``score``."""

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            yield pd.Series(model.score(np.column_stack([c.to_numpy(float) for c in columns])))

    return featured.withColumn("score", score(*NAMES))


def with_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    return text_counts(docs, text_col).withColumns({k: v.cast("double") for k, v in features().items()})


def held_out(key: str = "doc_id") -> Column:
    """Rows kept from training: crc32 of the key as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


# -- registered query -------------------------------------------------------
def op7_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    featured = written(with_features(docs).select("doc_id", held_out().alias("held_out"), *NAMES), "features")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = train(featured.where(~F.col("held_out")), labels)
    out = scored(featured, model)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
