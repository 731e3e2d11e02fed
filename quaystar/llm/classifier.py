"""Quality classifier: a generalised additive model with pairwise interactions.

The score is the logistic function of a sum of table lookups: one table for each feature and one for each of a few pairs
of features. The tables are learned on the driver from a bounded sample of labelled rows: shallow trees, one feature
after the other in cycles with a small step, each tree added to its feature's table; then the pairs in the same way.
Documents are scored by adding up the entries of their bins, a whole batch at a time.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from quaystar.llm.common import Batches, stored, with_text_columns
from quaystar.llm.quality_rules import CLASSES, COMMON_WORDS, _forms, measure

FEATURES = (
    "log_words", "word_length", "symbols", "upper", "digits", "marks", "beyond_ascii", "common_words", "repeat_lines",
    "repeat_words", "distinct_words", "lone_signs", "line_words",
)
COMMON = frozenset(_forms([word for words in COMMON_WORDS.values() for word in words]))


@dataclass(frozen=True)
class Fit:
    sample_rows: int = 20_000  # labelled rows the tables are learned from, at most
    bins: int = 32
    pair_bins: int = 8
    rounds: int = 150
    pair_rounds: int = 50
    pairs: int = 6
    step: float = 0.1
    smoothing: float = 5.0  # added to the curvature of each leaf


@dataclass
class Model:
    cuts: list[np.ndarray]
    pair_cuts: list[np.ndarray]
    intercept: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for k, entries in enumerate(self.tables):
            total += entries[np.searchsorted(self.cuts[k], x[:, k], "right")]
        for (i, j), entries in zip(self.pairs, self.pair_tables, strict=True):
            total += entries[
                np.searchsorted(self.pair_cuts[i], x[:, i], "right"), np.searchsorted(self.pair_cuts[j], x[:, j], "right")
            ]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def features(text: bytes) -> list[float]:
    base, classes, seen, ids = measure(text)
    n_words, chars, _, dup_lines, repeats = base
    n, letters = max(n_words, 1), max(sum(classes), 1)
    share = dict(zip(CLASSES, (c / letters for c in classes), strict=True))
    counts = np.bincount(ids, minlength=1)
    common = sum(int(counts[seen[form]]) for form in COMMON if form in seen)
    lone = sum(int(counts[k]) for word, k in seen.items() if len(word) == 1 and not word.isalnum())
    lines = sum(1 for line in text.split(b"\n") if line.strip()) or 1
    return [
        float(np.log1p(n_words)), chars / n, share["symbol"], share["upper"], share["digit"], share["mark"], share["beyond_ascii"],
        common / n, dup_lines / lines, repeats / n, len(seen) / n, lone / n, n_words / lines,
    ]


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _halves(gradient: np.ndarray, curvature: np.ndarray, smoothing: float) -> int:
    """Where a cut of a row of bins gains most; 0 where no cut gains."""
    g, h = np.cumsum(gradient), np.cumsum(curvature)
    left, right = g[:-1] ** 2 / (h[:-1] + smoothing), (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + smoothing)
    gain = left + right - g[-1] ** 2 / (h[-1] + smoothing)
    return int(np.argmax(gain)) + 1 if len(gain) and gain.max() > 1e-12 else 0


def _tree(gradient: np.ndarray, curvature: np.ndarray, smoothing: float, depth: int = 2) -> np.ndarray:
    """Leaf values of a tree over a row of bins."""
    cut = _halves(gradient, curvature, smoothing) if depth else 0
    if not cut:
        return np.full(len(gradient), gradient.sum() / (curvature.sum() + smoothing))
    return np.concatenate([_tree(gradient[s], curvature[s], smoothing, depth - 1) for s in (slice(None, cut), slice(cut, None))])


def _pair_tree(gradient: np.ndarray, curvature: np.ndarray, smoothing: float) -> np.ndarray:
    """A cut along the first feature, and in each part a cut along the second."""
    cut = _halves(gradient.sum(1), curvature.sum(1), smoothing) or len(gradient)
    out = np.empty_like(gradient)
    for part in (slice(None, cut), slice(cut, None)):
        out[part] = _tree(gradient[part].sum(0), curvature[part].sum(0), smoothing, 1)
    return out


def fit(x: np.ndarray, y: np.ndarray, how: Fit = Fit()) -> Model:
    """Learns from the rows x (features) with labels y (0 or 1). Without rows every score is one half."""
    if not len(x):
        empty = [np.empty(0)] * len(FEATURES)
        return Model(empty, empty)
    count = x.shape[1]
    cuts, pair_cuts = ([_cuts(x[:, k], bins) for k in range(count)] for bins in (how.bins, how.pair_bins))
    rate = (y.sum() + 0.5) / (len(y) + 1)
    model = Model(cuts, pair_cuts, float(np.log(rate / (1 - rate))), [np.zeros(len(c) + 1) for c in cuts])
    binned = [np.searchsorted(cuts[k], x[:, k], "right") for k in range(count)]
    coarse = [np.searchsorted(pair_cuts[k], x[:, k], "right") for k in range(count)]
    total = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(how.rounds):
        for k in range(count):
            g, h = slopes()
            size = len(model.tables[k])
            change = how.step * _tree(np.bincount(binned[k], g, size), np.bincount(binned[k], h, size), how.smoothing)
            model.tables[k] += change
            total += change[binned[k]]

    def grids(i: int, j: int, g: np.ndarray, h: np.ndarray) -> list[np.ndarray]:
        shape = len(pair_cuts[i]) + 1, len(pair_cuts[j]) + 1
        at = coarse[i] * shape[1] + coarse[j]
        return [np.bincount(at, values, shape[0] * shape[1]).reshape(shape) for values in (g, h)]

    def strength(pair: tuple[int, int]) -> float:
        g, h = grids(*pair, *slopes())
        leaf = _pair_tree(g, h, how.smoothing)
        return float((g * leaf - h * leaf**2 / 2).sum())

    model.pairs = sorted(combinations(range(count), 2), key=strength, reverse=True)[: how.pairs]
    model.pair_tables = [np.zeros((len(pair_cuts[i]) + 1, len(pair_cuts[j]) + 1)) for i, j in model.pairs]
    for _ in range(how.pair_rounds):
        for entries, (i, j) in zip(model.pair_tables, model.pairs, strict=True):
            change = how.step * _pair_tree(*grids(i, j, *slopes()), how.smoothing)
            entries += change
            total += change[coarse[i], coarse[j]]
    return model


def training_rows(measured: DataFrame, labels: DataFrame, label: str, how: Fit) -> tuple[np.ndarray, np.ndarray]:
    """The labelled rows outside the held-out third, how.sample_rows of them at most, by a hash of their id.

    A document with several labels has the more frequent one, and the smaller one of two that are as frequent.
    """
    votes = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg(label).alias("vote"))
    known = stored(measured.where(~F.col("held_out")).join(votes, "doc_id").dropDuplicates(["doc_id"]), "labelled_rows")
    # The smallest hashes; those that are too large for that never leave their tasks.
    share, hashed = min(1.0, 2 * how.sample_rows / max(known.count(), 1)), F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31))
    small = known.where(hashed < int(share * (1 << 31)))
    rows = small.orderBy(hashed, "doc_id").limit(how.sample_rows).select("features", "vote").collect()
    x = np.array([row.features for row in rows], float).reshape(len(rows), len(FEATURES))
    return x, np.array([float(row.vote > 0.5) for row in rows])


def scored(docs: DataFrame, labels: DataFrame, label: str = "quality", how: Fit = Fit()) -> DataFrame:
    """doc_id, held_out, score, predicted for each document.

    held_out: crc32(doc_id as text) mod 3 is 1; such rows teach nothing. Only the text makes the score. A null text is
    empty; an empty text has a score like any other. A null doc_id is not held out and has no label. Repeated rows are
    scored alike, and teach once. Without labels every score is 0.5. An empty table gives an empty result.
    """
    added = StructType([StructField("features", ArrayType(DoubleType()))])
    slim = docs.select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    measured = with_text_columns(slim, "text", added, lambda texts: [[features(text) for text in texts]])
    measured = stored(measured.select("doc_id", held_out.alias("held_out"), "features"), "quality_features")
    model = fit(*training_rows(measured, labels.select("doc_id", label), label, how), how)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            values = batch.column(2)
            x = values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), len(FEATURES))
            score = model.score(x)
            columns = [*batch.columns[:2], pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted"])

    kind = measured.schema["doc_id"].dataType.simpleString()
    return measured.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
