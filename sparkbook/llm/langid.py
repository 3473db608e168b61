"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text's subwords (runs of 2 to 4 characters inside a word with its ends) are
hashed into buckets; each bucket has an embedding, a text is the mean of its
subwords' embeddings, and a linear softmax gives the language. Embeddings and
softmax are trained together by stochastic gradient descent in numpy on a
bounded sample of labelled documents; a temperature and the threshold below
which a prediction is rejected are set on the part of the sample not trained on.

Prediction is linear up to the mean, so the model that travels is one score per
bucket and language (2^15 x languages, whatever the size of the input). Texts are
scored whole, in slices of bounded size.

Defined cases: null text or a text without a letter is ``und`` with score 0
and rejected; one-letter words count by their ends; repeated rows get equal
rows and are one candidate for training; a null doc_id is never trained on and
counts as not held out; an empty table gives no rows; a table without labels
predicts ``und`` throughout; columns beside doc_id, text and lang are not read,
whatever their names, and pass through ``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from sparkbook.llm.common import hash_share, row_key, saved, small_batches

BITS, DIM = 15, 12
#: Passes over the training part, more of them where it is small.
EPOCHS, LEAST_STEPS = 8, 16_000
#: Labelled documents per language that training may read; the sample is drawn by hash.
PER_LANGUAGE = 800
#: Code points that are hashed at a time.
SLICE = 1 << 18
#: Of correctly predicted calibration documents, the share that rejection may cost.
MAY_REJECT = 0.002
#: Beyond this probability scores differ by rounding only, so no threshold lies above it.
SATURATED = 0.99

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def subwords(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text number) of every subword, slice by slice. Words keep one space at either end."""
    points = [np.frombuffer(f" {(t or '').lower()} ".encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    chars = np.concatenate(points) if points else np.zeros(0, np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(p) for p in points])
    chars = np.where(letters()[chars], chars, 32).astype(np.uint32)
    keep = np.ones(len(chars), bool)
    keep[1:] = (chars[1:] != 32) | (chars[:-1] != 32) | (owner[1:] != owner[:-1])  # each text has a space at either end
    chars, owner = chars[keep], owner[keep]
    for lo in range(0, len(chars), SLICE):
        c, own = chars[lo : lo + SLICE + 3], owner[lo : lo + SLICE + 3]
        ends = c == 32
        h = c * np.uint32(0x9E3779B1)
        inside = np.ones(len(c), bool)
        n_here = min(SLICE, len(c))
        for n in (2, 3, 4):
            m = len(c) - n + 1
            if m <= 0:
                break
            h = (h[:m] ^ (h[:m] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + c[n - 1 :] * np.uint32(0xC2B2AE35)
            inside = inside[:m] if n == 2 else inside[:m] & ~ends[n - 2 : n - 2 + m]  # no word end between the first and the last
            good = inside & (own[:m] == own[n - 1 :]) & ~(ends[:m] & ends[n - 1 :])
            good[n_here:] = False
            mixed = (h ^ (h >> np.uint32(16))) * np.uint32(0x27D4EB2F)
            yield (mixed >> np.uint32(32 - BITS))[good], own[:m][good]


@dataclass
class Model:
    langs: list[str]
    scores: np.ndarray  # (buckets, languages)
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.5

    def logits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        sums, seen = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        for bucket, own in subwords(texts):
            rows = self.scores[bucket]
            for k in range(len(self.langs)):
                sums[:, k] += np.bincount(own, rows[:, k], minlength=len(texts))
            seen += np.bincount(own, minlength=len(texts))
        return sums / np.maximum(seen, 1)[:, None] + self.bias, seen

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and rejection of each text."""
        if not self.langs or not texts:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        logits, _ = self.logits(texts)
        p = softmax(logits / self.temperature)
        lettered = np.array([t is not None and any(map(str.isalpha, t)) for t in texts])
        best = p.argmax(axis=1)
        score = np.where(lettered, p.max(axis=1), 0.0)
        return [self.langs[b] if ok else "und" for b, ok in zip(best, lettered, strict=True)], score, ~lettered | (score < self.threshold)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 0) -> Model:
    """Train on (language, buckets, shares) rows; every fifth row is kept for temperature and threshold."""
    langs = sorted({r[0] for r in rows})
    if not langs:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0))
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    truth = np.array([langs.index(r[0]) for r in rows])
    order = rng.permutation(len(rows))
    held = order[::5] if len(rows) >= 10 else order
    train = np.setdiff1d(order, held) if len(rows) >= 10 else order
    step, epochs = 0, max(EPOCHS, -(-LEAST_STEPS // len(train)))
    for _ in range(epochs):
        for i in rng.permutation(train):
            rate = np.float32(0.5 * (1 - step / (epochs * len(train))) + 0.001)
            step += 1
            _, idx, share = rows[i]
            hidden = share @ emb[idx]
            err = softmax(hidden @ out + bias)
            err[truth[i]] -= 1
            back = out @ err
            out -= rate * np.outer(hidden, err)
            bias -= rate * err * np.float32(0.1)
            emb[idx] -= (rate * 3) * np.outer(share, back)
    scores = emb @ out
    model = Model(langs, scores.astype(np.float32), bias)
    logits = np.array([rows[i][2] @ scores[rows[i][1]] + bias for i in held])
    heat = [0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0, 5.0]
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(held)), truth[held]], 1e-12)).mean() for t in heat]
    model.temperature = heat[int(np.argmin(loss))]
    p = softmax(logits / model.temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == truth[held]]
    model.threshold = float(min(SATURATED, np.quantile(right, MAY_REJECT))) if len(right) else 0.0
    return model


def fold() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learn from labelled documents outside the held-out fold, at most ``per_language`` of each language."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            idx, share = [], []
            for text in batch.column(1):
                count = np.zeros(1 << BITS, np.int64)
                for bucket, _ in subwords([text.as_py()]):
                    count += np.bincount(bucket, minlength=1 << BITS)
                own = np.flatnonzero(count)
                idx.append(own.astype(np.int32).tobytes())
                share.append((count[own] / max(1, count.sum())).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(idx, pa.binary()), pa.array(share, pa.binary())], names=["lang", "idx", "share"])

    small_batches(docs.sparkSession)
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold() != 2))
    known = known.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), row_key(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("key"))
    # Rows are drawn by their content, so repeated rows are one candidate and the bound holds for them too.
    # Four times what is wanted passes the hash, whatever the size of the language; only those are ranked.
    # Written first, the counts have a size that the planner knows: no document is shuffled by language.
    size = saved(known.groupBy(F.col("lang").alias("of")).agg(F.approx_count_distinct("key.a").alias("size")), "languages")
    draw = known.select("lang", "key.a", "key.b").join(size, F.col("lang") == F.col("of"))
    draw = draw.filter(hash_share(F.xxhash64("a"), per_language, F.col("size"))).select("lang", "a", "b").distinct()
    draw = draw.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("a"), "a", "b"))).filter(F.col("nth") <= per_language)
    draw = saved(draw.select(F.col("lang").alias("of"), "a", "b"), "draw")
    sample = known.join(draw, (F.col("lang") == F.col("of")) & (F.col("key.a") == F.col("a")) & (F.col("key.b") == F.col("b")))
    sample = sample.groupBy("lang", "a", "b").agg(F.min("text").alias("text"))
    got = saved(sample.select("lang", "text").mapInArrow(features, "lang string, idx binary, share binary"), "sample")
    rows = sorted((r["lang"], bytes(r["idx"]), bytes(r["share"])) for r in got.collect())
    return fit([(lang, np.frombuffer(i, np.int32), np.frombuffer(s, np.float32)) for lang, i, s in rows if i])


PREDICTED = "doc_id long, lang_pred string, score double, rejected boolean"


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, rejected); only the text is read."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, rejected = model.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], names=["doc_id", "lang_pred", "score", "rejected"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(of, PREDICTED)


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not rejected, with all their columns."""

    @F.pandas_udf(BooleanType())
    def is_accepted(texts):
        import pandas as pd

        parts = [model.predict(list(texts[i : i + 500]))[2] for i in range(0, len(texts), 500)]
        return pd.Series(~np.concatenate(parts) if parts else np.zeros(0, bool))

    small_batches(docs.sparkSession)
    return docs.filter(is_accepted(F.col("text").cast("string")))
