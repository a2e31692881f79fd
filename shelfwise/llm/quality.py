"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into quantile bins.  Shallow trees over one feature are
boosted in turn, feature after feature with a small step, and summed into one
lookup table per feature; then the strongest pairs get small two-dimensional
tables the same way.  A text's score is the logistic of a sum of table entries:
bin its features, look up, add.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = ("bytes", "words", "letters", "upper", "digits", "marks", "odd_marks", "non_ascii", "word_mean", "word_sd",
            "distinct_words", "top_word", "same_as_previous", "line_mean", "distinct_lines", "ended_lines", "bars",
            "exclamations", "words_without_letters", "distinct_pairs")

_BYTE = np.arange(256)
_ASCII_LETTER = ((_BYTE >= 65) & (_BYTE <= 90)) | ((_BYTE >= 97) & (_BYTE <= 122))
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_HIGH = _BYTE >= 128
_MARK = (_BYTE > 32) & (_BYTE < 127) & ~_ASCII_LETTER & ~_DIGIT
_ODD = np.isin(_BYTE, list(b"#*%&$|@<>{}[]\\^~`=+_"))
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))


def features(text: str | None) -> list[float]:
    """Shape and repetition of the whole text; all 0 without text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return [float(np.log1p(len(data)))] + [0.0] * (len(FEATURES) - 1)
    n = len(data)
    bytes_ = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    letters = int(bytes_[_ASCII_LETTER].sum())
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    seen = Counter(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    following = words[1:]
    return [float(np.log1p(n)), float(np.log1p(len(words))),
            (letters + int(bytes_[_HIGH].sum())) / n, int(bytes_[_UPPER].sum()) / max(1, letters),
            int(bytes_[_DIGIT].sum()) / n, int(bytes_[_MARK].sum()) / n, int(bytes_[_ODD].sum()) / n,
            int(bytes_[_HIGH].sum()) / n, float(sizes.mean()), float(sizes.std()), len(seen) / len(words),
            max(seen.values()) / len(words), sum(map(eq, words, following)) / len(words),
            float(np.log1p(n / len(lines))), len(set(lines)) / len(lines),
            sum(line.rstrip()[-1:] in b".!?" for line in lines) / len(lines), int(bytes_[124]) / len(words),
            int(bytes_[33]) / len(words),
            sum(not w.translate(None, _LETTERS) != w for w in seen) / len(seen),
            len(set(zip(words, following, strict=False))) / max(1, len(following))]


def _bins(edges: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.searchsorted(edges, values, side="right")


def _tree(grad: np.ndarray, hess: np.ndarray, leaves: int) -> np.ndarray:
    """Leaf values per bin of a greedy tree on one ordered feature."""
    cuts, ridge = [0, len(grad)], 1.0
    g, h = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])

    def worth(a, b):
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + ridge)

    while len(cuts) - 1 < leaves:
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a > 1:
                at = np.arange(a + 1, b)
                gain = worth(a, at) + worth(at, b) - worth(a, b)
                k = int(gain.argmax())
                best = max(best, (float(gain[k]), int(at[k])), key=lambda x: x[0])
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(grad))
    for a, b in zip(cuts, cuts[1:], strict=False):
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + ridge)
    return out


def _tree_2d(grad: np.ndarray, hess: np.ndarray) -> tuple[np.ndarray, float]:
    """Leaf values of a two-level tree over two features: one cut of the first,
    a cut of the second in either half; and the gain."""
    best, out = 0.0, np.zeros_like(grad)
    for flip in (False, True):
        g, h = (grad.T, hess.T) if flip else (grad, hess)
        for cut in range(1, g.shape[0]):
            value, total = np.zeros_like(g), 0.0
            for rows in (slice(0, cut), slice(cut, None)):
                gg, hh = g[rows].sum(0), h[rows].sum(0)
                leaf = _tree(gg, hh, 2)
                value[rows] = leaf
                total += float((leaf * gg).sum())
            if total > best:
                best, out = total, value.T.copy() if flip else value
    return out, best


@dataclass
class AdditiveModel:
    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for k, (edges, table_) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table_[_bins(edges, x[:, k])]
        for i, j, table_ in self.pairs:
            total += table_[_bins(self.coarse[i], x[:, i]), _bins(self.coarse[j], x[:, j])]
        return 1 / (1 + np.exp(-total))


def _quantiles(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 150, step: float = 0.15, leaves: int = 4,
        n_pairs: int = 6, pair_bins: int = 8) -> AdditiveModel:
    """Cyclic boosting on log loss.  With one class or no rows: its smoothed share."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(float(np.log(share / (1 - share))))
    if len(y) == 0 or y.min() == y.max():
        return model
    model.edges = [_quantiles(x[:, k], bins) for k in range(x.shape[1])]
    model.coarse = [_quantiles(x[:, k], pair_bins) for k in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    binned = [_bins(e, x[:, k]) for k, e in enumerate(model.edges)]
    total = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for k, table_ in enumerate(model.tables):
            grad, hess = slopes()
            change = step * _tree(np.bincount(binned[k], grad, len(table_)), np.bincount(binned[k], hess, len(table_)),
                                  leaves)
            table_ += change
            total += change[binned[k]]

    small = [_bins(e, x[:, k]) for k, e in enumerate(model.coarse)]
    shape = [len(e) + 1 for e in model.coarse]

    def sums(i, j):
        cell, size = small[i] * shape[j] + small[j], shape[i] * shape[j]
        grad, hess = slopes()
        return [np.bincount(cell, v, size).reshape(shape[i], shape[j]) for v in (grad, hess)]

    ranked = sorted(((_tree_2d(*sums(i, j))[1], i, j) for i in range(len(shape)) for j in range(i)), reverse=True)
    model.pairs = [(i, j, np.zeros((shape[i], shape[j]))) for gain, i, j in ranked[:n_pairs] if gain > 0]
    for _ in range(rounds // 5):
        for i, j, table_ in model.pairs:
            change = step * _tree_2d(*sums(i, j))[0]
            table_ += change
            total += change[small[i], small[j]]
    return model


def _features_of(batches):
    for batch in batches:
        rows = [features(batch.column(1)[r].as_py()) for r in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["key", "x"])


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = 20_000, folds: int = 5,
          **options) -> AdditiveModel:
    """Fit on labelled documents outside the held-out fold (crc32 of the id as
    text, modulo ``folds``, is 0), at most ``max_rows`` of them: those with the
    smallest hash of the id.  An id that is labelled repeatedly counts once,
    with its smallest label; null ids and labels teach nothing."""
    order = F.xxhash64(F.col("doc_id"), F.lit(10))
    sample = (labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1))
              .where(~held_out(folds)).groupBy("doc_id").agg(F.min(label_col).cast("int").alias("__y"))
              .orderBy(order, "doc_id").limit(max_rows))
    rows = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
            .select(F.struct("doc_id", "__y").alias("key"), "text")
            .mapInArrow(_features_of, "key struct<doc_id:long,__y:int>, x array<double>")
            .select(F.col("key.doc_id").alias("doc_id"), F.col("key.__y").alias("y"), "x")
            .orderBy(order, "doc_id", "x").limit(max_rows).collect())
    x = np.array([r["x"] for r in rows], dtype=float).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r["y"] for r in rows], dtype=float), **options)


def held_out(folds: int = 5):
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))


def score(docs: DataFrame, model: AdditiveModel, keep=("doc_id",), threshold: float = 0.3) -> DataFrame:
    """The ``keep`` columns, score (0 to 1) and predicted of every row; null and
    empty texts have the features of no text, repeated rows repeat."""
    data = docs.select(*keep, F.col("text").alias("__text"))
    schema = ", ".join(f"`{c}` {data.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            x = np.array([features(texts[r].as_py()) for r in range(batch.num_rows)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(model.score(x))], [*keep, "score"])

    return (data.mapInArrow(run, f"{schema}, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, threshold: float = 0.3, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every document row.

    Only the text is an input of a score.  Ids may be null or repeat; other
    columns are ignored; without usable labels every score is one half.
    """
    model = learn(docs, labels, folds=folds, **options)
    return score(docs, model, threshold=threshold).withColumn("held_out", held_out(folds)).select(
        "doc_id", "held_out", "score", "predicted")
