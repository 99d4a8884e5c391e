"""Toxicity as ordinal severity: cumulative-link regression on sparse word features.

Grades are ordered. One weight per word is shared by all thresholds:
``P(grade >= j) = sigmoid(score - threshold_j)`` with thresholds in ascending order, where the score
is the sum of the weights of the distinct words and word beginnings of the text. Weights are fitted by accelerated
proximal gradient with an L1 penalty, so that only words that separate grades keep one. The
expected severity is the sum of the probabilities over all thresholds.

The model is fitted on a bounded sample of labelled documents (about ``MAX_LABELLED``, taken by a
hash of the id); scoring covers every document and whole texts, without a shuffle.

Cases: a null or empty text has no words and gets the prior of a clean text; labels that are null or
without document are not used, of repeated labels the worst counts; without labelled documents, or
with one grade only, severity is null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import stored

MAX_LABELLED = 12_000
MIN_DOCUMENTS = 5
#: Penalty on squared weights in the second fit.
RIDGE = 0.3
#: Word beginnings of these lengths are features too, so that inflected forms share a weight.
PREFIXES = (5, 7)
_DENSE = 1024
_WORD = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> set[str]:
    """The distinct words of a text and, marked by a hyphen, the first letters of longer ones."""
    found = set(_WORD.findall(text.lower())) if text else set()
    starts = {w[:k] + "-" for w in found if len(w) > 4 for k in PREFIXES if len(w) >= k}
    return found | starts


@dataclass
class SeverityModel:
    weights: dict[str, float]
    thresholds: list[float]

    def expected(self, text: str | None) -> tuple[float, float, int]:
        """Expected severity, probability of any severity, most likely grade."""
        score = sum(self.weights[w] for w in sorted(self.weights.keys() & features(text)))
        above = 1 / (1 + np.exp(np.clip(np.array(self.thresholds) - score, -500, 500)))
        grades = np.append(1, above) - np.append(above, 0)
        return float(above.sum()), float(above[0]), int(grades.argmax())


def severity_grades(rows: np.ndarray, cols: np.ndarray, d: int, toxic: np.ndarray) -> np.ndarray:
    """Grades 0 (clean), 1 and 2 from binary labels; document ``rows[i]`` has feature ``cols[i]`` of ``d``.

    A feature is typical if it occurs in ``MIN_DOCUMENTS`` toxic documents or more and is at least
    twenty times as frequent there as in clean ones. Toxic documents with more typical features than
    the median of those that have any are graded 2, the others 1.
    """
    in_toxic = toxic[rows] > 0
    bad, good = np.bincount(cols[in_toxic], minlength=d), np.bincount(cols[~in_toxic], minlength=d)
    n_bad, n_good = max(1, int((toxic > 0).sum())), max(1, int((toxic == 0).sum()))
    typical = (bad >= MIN_DOCUMENTS) & (bad / n_bad >= 20 * good / n_good)
    counts = np.bincount(rows[typical[cols] & in_toxic], minlength=len(toxic)).astype(float)
    middle = float(np.median(counts[counts > 0])) if (counts > 0).any() else 0.0
    return np.where(toxic > 0, 1 + (counts > middle), 0)


def _descend(rows, cols, n: int, d: int, grades: np.ndarray, penalty: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by accelerated proximal gradient; columns are scaled to equal spread."""
    n_levels = int(grades.max())
    shares = np.clip([(grades >= j).mean() for j in range(1, n_levels + 1)], 1e-6, 1 - 1e-6)
    thresholds = -np.log(shares / (1 - shares))
    scale = 1 / np.sqrt(np.maximum(1, np.bincount(cols, minlength=d)) / n)
    values = scale[cols]

    def times(v):
        return np.bincount(rows, values * v[cols], minlength=n)

    def transposed(u):
        return np.bincount(cols, values * u[rows], minlength=d)

    v = np.ones(d)
    for _ in range(20):  # largest eigenvalue, for the step
        v = transposed(times(v / np.linalg.norm(v)))
    step = 4 * n / (n_levels * np.linalg.norm(v))
    w = z = np.zeros(d)
    momentum = 1.0
    for _ in range(steps):
        score = times(z)
        slope, shift = np.zeros(n), np.zeros(n_levels)
        for j in range(n_levels):
            error = 1 / (1 + np.exp(np.clip(thresholds[j] - score, -500, 500))) - (grades > j)
            slope += error
            shift[j] = error.mean()
        moved = z - step * transposed(slope) / n
        new = np.maximum(moved - step * penalty, 0)
        thresholds = np.maximum.accumulate(thresholds + 2 * shift)
        after = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        z = new + (momentum - 1) / after * (new - w)
        w, momentum = new, after
    return w * scale, thresholds


def _refit(rows, cols, n: int, d: int, grades: np.ndarray, thresholds: np.ndarray, steps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Weights of few features by Newton steps with a small ridge; only ``_DENSE`` documents are dense at a time."""
    order = np.argsort(rows, kind="stable")
    rows, cols = rows[order], cols[order]
    w, thresholds = np.zeros(d), thresholds.copy()
    edges = np.arange(0, n + _DENSE, _DENSE)
    cuts = np.searchsorted(rows, edges)
    for _ in range(steps):
        gradient, hessian = np.zeros(d + len(thresholds)), np.zeros((d + len(thresholds),) * 2)
        for at, lo, hi in zip(edges[:-1], cuts[:-1], cuts[1:], strict=True):
            x = np.zeros((min(_DENSE, n - at), d))
            x[rows[lo:hi] - at, cols[lo:hi]] = 1
            score, above = x @ w, grades[at : at + _DENSE]
            for j, threshold in enumerate(thresholds):
                p = 1 / (1 + np.exp(np.clip(threshold - score, -500, 500)))
                error, bend = p - (above > j), p * (1 - p)
                gradient[:d] += x.T @ error
                gradient[d + j] -= error.sum()
                hessian[:d, :d] += x.T @ (x * bend[:, None])
                hessian[:d, d + j] -= x.T @ bend
                hessian[d + j, d + j] += bend.sum()
        hessian[d:, :d] = hessian[:d, d:].T
        gradient[:d] += RIDGE * w
        hessian += np.diag(np.append(np.full(d, RIDGE), np.full(len(thresholds), 1e-6)))
        change = np.linalg.solve(hessian, gradient)
        change = np.clip(change, -1, 1)
        w, thresholds = w - change[:d], np.maximum.accumulate(thresholds - change[d:])
        if np.abs(change).max() < 1e-6:
            break
    return w, thresholds


def fit_cells(rows: np.ndarray, cols: np.ndarray, vocabulary: list[str], grades: np.ndarray, steps: int = 200) -> SeverityModel | None:
    """Fit on documents ``rows[i]`` with features ``cols[i]`` and their grades; None if there is nothing to tell apart.

    A strong penalty selects features: it lies above what chance gives the best of ``d`` features
    in ``n`` documents. Newton steps then fit the weights of the few that were selected. Weights are
    never negative: no word makes a text less severe.
    """
    if len(grades) == 0 or len(np.unique(grades)) < 2:
        return None
    n, share = len(grades), float((grades > 0).mean())
    penalty = (2 * share * (1 - share) * np.log(max(2, len(vocabulary))) / n) ** 0.5
    weights, thresholds = _descend(rows, cols, n, len(vocabulary), grades, penalty, steps)
    selected = np.flatnonzero(weights)
    weights = np.array([-1.0])
    while (weights < 0).any():
        place = np.full(len(vocabulary), -1)
        place[selected] = np.arange(len(selected))
        kept = place[cols] >= 0
        weights, thresholds = _refit(rows[kept], place[cols[kept]], n, len(selected), grades, thresholds)
        selected = selected[weights >= 0]
    weights = weights[weights >= 0]
    return SeverityModel({vocabulary[i]: float(w) for i, w in zip(selected, weights, strict=True)}, [float(t) for t in thresholds])


def fit_ordinal(docs: list[list[str]], grades: np.ndarray, steps: int = 200) -> SeverityModel | None:
    """:func:`fit_cells` on lists of features."""
    seen = Counter(f for doc in docs for f in doc)
    vocabulary = sorted(f for f, count in seen.items() if count >= MIN_DOCUMENTS)
    place = {f: i for i, f in enumerate(vocabulary)}
    pairs = np.array([(r, place[f]) for r, doc in enumerate(docs) for f in doc if f in place], np.int64).reshape(-1, 2)
    return fit_cells(pairs[:, 0], pairs[:, 1], vocabulary, np.asarray(grades), steps)


def fit_severity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_labelled: int = MAX_LABELLED
) -> SeverityModel | None:
    """Fit on the documents of about ``max_labelled`` labels (``id_col``, ``label_col``).

    Features are counted and numbered by Spark; those of fewer than ``MIN_DOCUMENTS`` documents stay there, and
    the others reach the driver as 32-bit numbers. Labels may be grades already; labels 0 and 1
    are graded by :func:`severity_grades`.
    """
    marked = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("int").alias("grade")).dropna()
    marked = marked.groupBy("doc_id").agg(F.max("grade").alias("grade"))
    n = max(1, marked.count())
    sample = marked.filter(F.pmod(F.xxhash64("doc_id"), F.lit(n)) < max_labelled)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))

    @F.pandas_udf("array<string>")
    def distinct_features(column):
        return column.map(lambda t: sorted(features(t)))

    # The sample has about max_labelled rows whatever the table: it may be broadcast.
    table = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "grade", distinct_features("text").alias("words"))
    table = stored(table.withColumn("place", F.monotonically_increasing_id()), "graded")
    words = table.select("place", F.explode("words").alias("word"))
    often = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_DOCUMENTS)
    # As large as the sample's vocabulary, not the corpus's.
    numbered = stored(often.select("word", (F.row_number().over(Window.orderBy("word")) - 1).alias("id")), "features")
    vocabulary = [r["word"] for r in numbered.select("word").orderBy("id").collect()]
    ids = words.join(F.broadcast(numbered), "word").groupBy("place").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    cells = table.select("place", "doc_id", "grade").join(ids, "place", "left").orderBy("doc_id", "place").select("grade", "ids").toArrow()
    grades = cells["grade"].to_numpy().astype(int)
    lists = cells["ids"].combine_chunks()
    lengths = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy()
    rows, cols = np.repeat(np.arange(len(grades), dtype=np.int32), lengths), lists.flatten().to_numpy()
    if grades.max(initial=0) == 1:
        grades = severity_grades(rows, cols, len(vocabulary), grades)
    return fit_cells(rows, cols, vocabulary, grades)


def score_severity(docs: DataFrame, model: SeverityModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, severity, p_toxic, grade, toxic`` of every document."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    if model is None:
        return rows.selectExpr("doc_id", "cast(null as double) severity", "cast(null as double) p_toxic", "cast(null as int) grade", "cast(null as boolean) toxic")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.expected(t) for t in batch.column(1).to_pylist()]
            severity, p, grade = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(severity, pa.float64()), pa.array(p, pa.float64()), pa.array(grade, pa.int32()), pa.array([x >= 0.5 for x in p], pa.bool_())],
                ["doc_id", "severity", "p_toxic", "grade", "toxic"],
            )

    return rows.mapInArrow(score, "doc_id long, severity double, p_toxic double, grade int, toxic boolean")
