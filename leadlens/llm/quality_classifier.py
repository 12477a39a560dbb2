"""Quality scores by regularised quadratic discriminant analysis.

Texts become short vectors of transformed statistics (lengths, shares of character and word kinds, repetition,
entropy). Each class is a normal density whose covariance is shrunk towards the pooled one and then towards a
multiple of the identity. The score is the posterior of class 1 from the difference of the log densities, whose
Mahalanobis terms use the inverses of the Cholesky factors, computed once. Sums for the fit are made by Spark over
all labelled rows; only they reach the driver.

Rows: a NULL or empty text has a vector of its own and gets a score like any other. A document that is labelled several
times counts once for each label. Labels other than 0 and 1 are ignored, and so are rows without an id when learning.
With only one class to learn from, scores are its share, 0 or 1; with none they are 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.llm.common import bound_batches, checkpointed, in_parts, remainder, utf8, word_bounds, word_hashes

KINDS = {
    "lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58), "space": (32, 9, 10, 11, 12, 13), "line": (10,),
    "symbol": b"#*$%&|<>", "stop": b".,;:", "shout": b"!?", "bar": b"|", "other": range(128, 256),
}
NAMES = ["words", "word_length", *KINDS, "distinct_words", "same_as_before", "longest_word", "words_per_line", "entropy"]
THRESHOLD = 0.3
_TABLES = np.zeros((len(KINDS), 256), np.uint8)
for _i, _bytes in enumerate(KINDS.values()):
    _TABLES[_i, list(_bytes)] = 1


def features(column: pa.Array) -> np.ndarray:
    """[text, statistic], in order of NAMES."""
    data, offsets = utf8(column)
    n = len(offsets) - 1
    size = np.diff(offsets)
    full = np.flatnonzero(size)
    counts = np.zeros((n, len(KINDS)))
    entropy = np.zeros(n)
    if len(full):
        for i, table in enumerate(_TABLES):
            counts[full, i] = np.add.reduceat(table[data], offsets[full], dtype=np.int64)
        for i in full:
            share = np.bincount(data[offsets[i] : offsets[i + 1]]) / size[i]
            share = share[share > 0]
            entropy[i] = -(share * np.log2(share)).sum()
    starts, ends, first = word_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends)
    words = np.diff(first)
    lengths = ends - starts
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    distinct, repeats, longest = np.zeros(n), np.zeros(n), np.zeros(n)
    for i in np.flatnonzero(words):
        a, b = first[i], first[i + 1]
        distinct[i] = len(np.unique(hashes[a:b]))
        repeats[i] = same[a + 1 : b].sum()
        longest[i] = lengths[a:b].max()
    chars, any_words = np.maximum(size, 1), np.maximum(words, 1)
    share = np.sqrt(counts / chars[:, None])
    lines = counts[:, list(KINDS).index("line")] + 1
    return np.column_stack((
        np.log1p(words), np.log1p((size - counts[:, list(KINDS).index("space")]) / any_words), share,
        np.log1p(distinct) / np.log1p(any_words), np.sqrt(repeats / any_words), np.log1p(longest), np.log1p(words / lines), entropy,
    ))


def vectors(docs: DataFrame) -> DataFrame:
    """doc_id and x, the statistics of its text."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, "text"):
            x = features(batch.column(1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.astype(np.float32).ravel()))
            yield pa.record_batch([batch.column(0), lists], ["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, x array<float>")


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


@dataclass
class Discriminant:
    """Class means, inverse Cholesky factors of the covariances, and log determinant with prior, for classes 0 and 1."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        logs = np.empty((2, len(x)))
        for k in range(2):
            z = (x - self.means[k]) @ self.factors[k].T
            logs[k] = self.constants[k] - 0.5 * (z * z).sum(axis=1)
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def class_sums(rows: DataFrame, width: int) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Weight, sum and sum of outer products of x for each class of (x, n0, n1); summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + width + width * width))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(0))
            for k in (0, 1):
                n = batch.column(1 + k).to_numpy(zero_copy_only=False).astype(float)
                total[k] += np.concatenate(([n.sum()], n @ x, ((x * n[:, None]).T @ x).ravel()))
        k, at = np.divmod(np.arange(total.size), total.shape[1])
        yield pa.record_batch([pa.array(k), pa.array(at), pa.array(total.ravel())], ["k", "at", "v"])

    found = rows.mapInArrow(run, "k long, at long, v double").groupBy("k", "at").agg(F.sum("v").alias("v")).collect()
    table = np.zeros((2, 1 + width + width * width))
    for r in found:
        table[r["k"], r["at"]] = r["v"]
    return {k: (t[0], t[1 : 1 + width], t[1 + width :].reshape(width, width)) for k, t in enumerate(table)}


def fit(rows: DataFrame, to_pooled: float = 0.2, to_identity: float = 0.01) -> Discriminant | float:
    """The model from (x, n0, n1), n0 and n1 being how often the row is labelled 0 and 1; a plain number where a class
    is missing. ``to_pooled`` and ``to_identity`` are the weights of the shrinkage targets."""
    width = len(NAMES)
    sums = class_sums(rows, width)
    n = np.array([sums[k][0] for k in (0, 1)])
    if not n.all():
        return float(n[1] / n.sum()) if n.sum() else 0.5
    means = np.stack([sums[k][1] / n[k] for k in (0, 1)])
    covariances = np.stack([sums[k][2] / n[k] - np.outer(means[k], means[k]) for k in (0, 1)])
    pooled = np.tensordot(n / n.sum(), covariances, 1)
    factors, constants = np.empty_like(covariances), np.empty(2)
    for k in (0, 1):
        shrunk = (1 - to_pooled) * covariances[k] + to_pooled * pooled
        shrunk = (1 - to_identity) * shrunk + to_identity * (np.trace(shrunk) / width + 1e-9) * np.eye(width)
        lower = np.linalg.cholesky(shrunk)
        factors[k] = np.linalg.inv(lower)
        constants[k] = np.log(n[k] / n.sum()) - np.log(np.diag(lower)).sum()
    return Discriminant(means, factors, constants)


def scored(rows: DataFrame, model: Discriminant | float) -> DataFrame:
    """doc_id and score of (doc_id, x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = np.full(batch.num_rows, model) if isinstance(model, float) else model.score(matrix(batch.column(1)))
                yield pa.record_batch([batch.column(0), pa.array(score)], ["doc_id", "score"])

    return rows.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")


def quality_classifier(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query: held_out, score and predicted of every document. Learned from labels whose crc32(doc_id as text)
    mod 5 is not 0."""
    rows = checkpointed(vectors(docs))
    is_ = lambda k: F.count_if(F.col("quality") == k)
    known = labels.filter(remainder("doc_id", 5) != 0).groupBy(F.col("doc_id").cast("long").alias("id")).agg(is_(0).alias("n0"), is_(1).alias("n1"))
    model = fit(rows.join(known, F.col("doc_id") == F.col("id")).select("x", "n0", "n1"))
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    return scored(rows, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
