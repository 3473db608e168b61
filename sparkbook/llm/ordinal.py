"""Quality classifier: ordinal regression with cumulative links.

Ratings are graded 0 to K; one weight vector over hashed words is shared by all
grades, and K ordered thresholds cut its score: P(grade <= k) =
sigmoid(threshold_k - score). The report gives the expected grade and the tail
probability of the best grade, by which documents are selected.

The grade of a labelled document is the number of checks it passes: quality, and
not being toxic (0 to 2). The fit reads at most ``TRAIN_ROWS`` labelled rows,
drawn by hash; what travels to the tasks are 2^18 weights, whatever the input.
Whole texts are scored where they lie: nothing is shuffled but the sample.

Defined cases: null text counts as empty and is scored by the thresholds alone;
labels with a null are not used; several labels of one document count each;
repeated rows get equal rows; an empty table gives no rows; without labels all
grades are equally likely and nothing is selected; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkbook.llm.common import hash_sample, saved, small_batches

BITS = 18
GRADES = 3
TRAIN_ROWS = 10_000
STEPS = 250
#: A bucket needs so many training documents to get a weight: words seen in fewer tell nothing general.
LEAST_DOCS = 8
#: The least tail probability of a selected document.
LEAST_TAIL = 0.5


def hashed(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text: its words, the shares of word shapes, and how rich and how long it is."""
    raw = (text or "").encode("utf-8", "surrogatepass").split()
    if not raw:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    counts = Counter(w.lower().strip(b".,;:!?") for w in raw)
    shapes = Counter(b"\x00sym" if not w.strip(b".,;:!?\"'()").isalnum() and w.isascii() else b"\x00cap" if w.isupper() else b"\x00low" for w in raw)
    frame = (b"\x00rich%d" % (10 * len(counts) // len(raw)), b"\x00long%d" % len(raw).bit_length())
    mask = (1 << BITS) - 1
    words = [*counts, *frame, *shapes]
    idx = np.fromiter((zlib.crc32(w) & mask for w in words), np.int32, len(words))
    value = np.ones(len(words), np.float32)
    value[len(counts) + len(frame) :] = np.fromiter(shapes.values(), np.float32, len(shapes)) / len(raw)
    return idx, value


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, texts: list[str | None]) -> np.ndarray:
        return np.array([float(self.weights[i] @ v) if len(i) else 0.0 for i, v in map(hashed, texts)])

    def grades(self, texts: list[str | None]) -> np.ndarray:
        """(texts, grades): the probability of each grade."""
        below = sigmoid(self.thresholds[None, :] - self.score(texts)[:, None])
        return np.diff(np.concatenate([np.zeros((len(texts), 1)), below, np.ones((len(texts), 1))], axis=1), axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], grades: int = GRADES, steps: int = STEPS, ridge: float = 1e-3) -> Ordinal:
    """Maximum likelihood by Adam; thresholds stay ordered because their gaps are exponentials."""
    if not rows:
        even = np.arange(1, grades) / grades
        return Ordinal(np.zeros(1 << BITS, np.float32), np.log(even / (1 - even)))
    y = np.array([r[0] for r in rows])
    idx, val = np.concatenate([r[1] for r in rows]), np.concatenate([r[2] for r in rows])
    owner = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    share = np.clip(np.cumsum(np.bincount(y, minlength=grades))[:-1] / len(y), 0.01, 0.99)
    first = np.log(share / (1 - share))
    params = np.concatenate([np.zeros(1 << BITS), first[:1], np.log(np.maximum(np.diff(first), 1e-3))])
    m, v = np.zeros_like(params), np.zeros_like(params)
    d = 1 << BITS
    seen = np.bincount(idx, minlength=d) >= min(LEAST_DOCS, len(rows))
    common = seen[idx]
    idx, val, owner = idx[common], val[common], owner[common]
    for step in range(1, steps + 1):
        w, theta = params[:d], np.cumsum(np.concatenate([params[d : d + 1], np.exp(params[d + 1 :])]))
        s = np.bincount(owner, w[idx] * val, len(rows))
        upper = np.where(y < grades - 1, sigmoid(theta[np.minimum(y, grades - 2)] - s), 1.0)
        lower = np.where(y > 0, sigmoid(theta[np.maximum(y - 1, 0)] - s), 0.0)
        p = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
        g_theta = np.bincount(np.minimum(y, grades - 2), -du * (y < grades - 1), grades - 1) + np.bincount(np.maximum(y - 1, 0), dl * (y > 0), grades - 1)
        grad = np.concatenate([np.bincount(idx, (du - dl)[owner] * val, d) / len(y) + ridge * w, np.zeros(grades - 1)])
        tail = np.cumsum(g_theta[::-1])[::-1] / len(y)
        grad[d], grad[d + 1 :] = tail[0], tail[1:] * np.exp(params[d + 1 :])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        params = params - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Ordinal(params[:d].astype(np.float32), np.cumsum(np.concatenate([params[d : d + 1], np.exp(params[d + 1 :])])))


def held_out():
    """Every fifth document by the checksum of its id; a null id is not held out and not trained on."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Ordinal:
    """Fit on at most ``rows`` labels of documents that are not held out."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [hashed(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([i.tobytes() for i, _ in got], pa.binary()), pa.array([x.tobytes() for _, x in got], pa.binary())], names=["grade", "idx", "value"])

    small_batches(docs.sparkSession)
    graded = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    grade = (F.least(F.greatest("quality", F.lit(0)), F.lit(1)) + F.when(F.col("toxic") > 0, 0).otherwise(1)).cast("int")
    drawn = saved(hash_sample(graded.select(F.col("doc_id").alias("of"), grade.alias("grade")).distinct(), rows, "of", "grade").drop("h"), "drawn")
    sample = drawn.join(docs.select("doc_id", F.col("text").cast("string").alias("text")), F.col("of") == F.col("doc_id"))
    # One text per drawn label, the least: an id on many rows does not lift the bound.
    sample = sample.groupBy("of", "grade").agg(F.min("text").alias("text"))
    got = saved(sample.select("grade", "text").mapInArrow(features, "grade int, idx binary, value binary"), "graded").collect()
    parts = sorted((r["grade"], bytes(r["idx"]), bytes(r["value"])) for r in got)
    return fit([(g, np.frombuffer(i, np.int32), np.frombuffer(x, np.float32)) for g, i, x in parts])


REPORT = "doc_id long, expected_grade double, tail_probability double, selected boolean"


def graded_quality(docs: DataFrame, model: Ordinal, least_tail: float = LEAST_TAIL) -> DataFrame:
    """(doc_id, expected_grade, tail_probability of the best grade, selected)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.grades(batch.column(1).to_pylist())
            tail = p[:, -1]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p @ np.arange(p.shape[1])), pa.array(tail), pa.array(tail >= least_tail)], names=["doc_id", "expected_grade", "tail_probability", "selected"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(of, REPORT)
