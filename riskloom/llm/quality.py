"""Quality classifier: regularised quadratic discriminant.

Every text becomes a short vector of transformed statistics.  Each class is a Gaussian
whose covariance is shrunk towards the pooled covariance and its diagonal; the score is the
logistic of the difference of Mahalanobis log-densities, computed from Cholesky factors
that are made once and shipped with the model.
"""

from __future__ import annotations

import math
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Scratch, held_out, pieces, text_bytes, with_fields

#: Shrinkage of a class covariance towards the pooled one, and of the result towards its diagonal.
TO_POOLED, TO_DIAGONAL = 0.1, 0.05
#: Least variance of a standardised statistic within a class.
LEAST_VARIANCE = 1e-3
THRESHOLD = 0.7
UPPER, LOWER = bytes(range(65, 91)), bytes(range(97, 123))
DIGITS, SENTENCE = bytes(range(48, 58)), b".,;:!?'\"-()"
SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in SENTENCE)
STATISTICS = ("words", "word_length", "word_length_spread", "distinct_words", "commonest_word", "repeats",
              "upper", "digits", "sentence_marks", "symbols", "bare_marks", "exclamations", "line_length", "repeated_lines")


def statistics(text: bytes | None) -> list[float]:
    """Transformed statistics of a text (UTF-8); null and blank texts have words 0 and neutral shares."""
    text = text or b""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    count = lambda chars: len(text) - len(text.translate(None, chars))
    share = lambda k, of: math.asin(math.sqrt(min(1.0, k / of))) if of else 0.0  # noqa: E731  variance-stabilising
    lengths = np.fromiter(map(len, words), np.int64, n)
    solid = int(lengths.sum())
    upper, lower = count(UPPER), count(LOWER)
    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return [
        math.log1p(n), math.log(lengths.mean()), math.log1p(lengths.std()),
        share(len(counts), n) * math.sqrt(math.log1p(n)), share(max(counts.values()) - 1, n),
        share(sum(map(eq, words, words[1:])), n),
        share(upper, upper + lower), share(count(DIGITS), solid), share(count(SENTENCE), solid), share(count(SYMBOLS), solid),
        share(counts[b"|"] + counts[b"-"] + counts[b"*"], n), share(text.count(b"!"), n),
        math.log1p(solid / len(lines)), share(len(lines) - len(set(lines)), len(lines)),
    ]


def document_statistics(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with an array column ``x`` in place of the text."""
    keep = [f.name for f in docs.schema.fields if f.name != text_col]
    schema = with_fields(docs.select(*keep).schema, "x array<double>")

    def measure(batches):
        for batch in pieces(batches):
            x = pa.array([statistics(t) for t in text_bytes(batch.column(text_col))], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], x], names=[*keep, "x"])

    return docs.mapInArrow(measure, schema)


class Discriminant:
    """Class means, inverse Cholesky factors, log-determinants and log priors over standardised statistics."""

    def __init__(self, moments: dict[int, tuple[float, np.ndarray, np.ndarray]]):
        """moments: by class the number of rows, the sum of x and the sum of x xT."""
        self.classes = {}
        total = sum(n for n, _, _ in moments.values())
        self.prior = moments.get(1, (0, 0, 0))[0] / total if total else 0.5
        if len(moments) < 2:
            return
        mean = sum(s for _, s, _ in moments.values()) / total
        spread = np.sqrt(np.maximum(np.diag(sum(q for _, _, q in moments.values())) / total - mean ** 2, 0))
        self.mean, self.scale = mean, np.where(spread > 1e-9, spread, 1.0)
        inside, means = {}, {}
        for c, (n, s, q) in moments.items():
            m = s / n
            means[c] = (m - mean) / self.scale
            inside[c] = (q / n - np.outer(m, m)) / np.outer(self.scale, self.scale)
        pooled = sum(moments[c][0] * inside[c] for c in moments) / total
        for c, (n, _, _) in moments.items():
            cov = (1 - TO_POOLED) * inside[c] + TO_POOLED * pooled
            cov = (1 - TO_DIAGONAL) * cov + TO_DIAGONAL * np.diag(np.diag(cov)) + LEAST_VARIANCE * np.eye(len(mean))
            factor = np.linalg.cholesky(cov)
            self.classes[c] = (means[c], np.linalg.inv(factor), -np.log(np.diag(factor)).sum() + math.log(n / total))

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1; the prior if only one class (or none) was seen."""
        if not self.classes:
            return np.full(len(x), self.prior)
        z = (x - self.mean) / self.scale
        log = {c: k - 0.5 * np.square((z - m) @ inverse.T).sum(axis=1) for c, (m, inverse, k) in self.classes.items()}
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def fit_discriminant(labelled: DataFrame) -> Discriminant:
    """From all rows (label 0 or 1, x): only sums by class and pair of statistics reach the driver."""
    def sums(batches):
        held = {}
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False)
            x = np.array(batch.column("x").to_pylist(), float).reshape(batch.num_rows, -1)
            for c in np.unique(label):
                own = np.hstack([np.ones(((label == c).sum(), 1)), x[label == c]])
                held[int(c)] = held.get(int(c), 0) + own.T @ own
        for c, q in held.items():
            i, j = np.indices(q.shape)
            yield pa.RecordBatch.from_arrays([pa.array([c] * q.size, pa.int32()), pa.array(i.ravel(), pa.int32()),
                                              pa.array(j.ravel(), pa.int32()), pa.array(q.ravel())], names=["c", "i", "j", "q"])

    got = labelled.mapInArrow(sums, "c int, i int, j int, q double").groupBy("c", "i", "j").agg(F.sum("q").alias("q")).toPandas()
    moments = {}
    for c, part in got.groupby("c"):
        d = int(part["i"].max()) + 1
        q = np.zeros((d, d))
        q[part["i"], part["j"]] = part["q"]
        moments[int(c)] = (q[0, 0], q[0, 1:], q[1:, 1:])
    return Discriminant(moments)


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, held_out, score, predicted.

    Learns from every labelled row that is not held out (labels other than 0 and 1 and null ids
    are not used).  Null and blank texts are scored from neutral statistics; with one class, or
    none, the score is the share of label 1 (0.5 without labels).  An empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held_out(F.col(id_col)).alias("held_out"))
    rows = scratch.table(document_statistics(rows, "text"), "statistics")
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("label in (0, 1)")
    model = spark.sparkContext.broadcast(fit_discriminant(rows.filter(~F.col("held_out")).join(known, "id").select("label", "x")))

    def score(batches):
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), float).reshape(batch.num_rows, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), pa.array(model.value.scores(x))],
                                             names=["id", "held_out", "score"])

    scored = rows.mapInArrow(score, with_fields(rows.select("id", "held_out").schema, "score double"))
    return scored.select(F.col("id").alias(id_col), "held_out", "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
