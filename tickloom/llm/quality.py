"""Quality classifier: hashed word n-gram logistic regression, trained with
follow-the-regularised-leader updates and scored as sparse dot products.

The model is fitted on at most ``MAX_TRAIN`` labelled documents, those with the
smallest id hashes among the labels that may be learnt from; every document is
scored on its whole text. Words are runs of letters, of digits or of marks;
numbers and all-capital words stand for their kind, and a word right after
itself makes the same bigram whatever the word.

Defined results: null and empty texts score by the bias alone. Several labels
of one id count as their majority (ties: 1); labels without a value are
ignored. Repeated documents of one id are learnt from once. Without any usable
label every score is 0.5. An empty table gives an empty result. Extra columns
pass through, but for those the result replaces by name.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tickloom.llm.common import giving_back, replacing, text_of

MAX_TRAIN = 8192        # labelled documents learnt from, at most
BITS = 18               # 2^18 weights
SCALE = 8.0             # a document's n-gram values sum to this
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-3
FOLD = 3                # ids whose crc32 mod FOLD is HELD_OUT are never learnt from
HELD_OUT = 1
_WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_CACHE = 100_000


class Features:
    """Slots of a text's word unigrams and bigrams."""

    def __init__(self, bits: int = BITS):
        self.mask, self.seen = np.uint64((1 << bits) - 1), {}
        self.twice = np.uint64(self.word("="))

    def word(self, w: str) -> int:
        if w.isdigit():
            w = "0"
        elif len(w) > 1 and w.isupper():
            w = "^"
        else:
            w = w.lower()
        return zlib.crc32(w.encode()) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF

    def slots(self, text: str) -> np.ndarray:
        words, seen = _WORD.findall(text), self.seen
        if len(seen) > _CACHE:
            seen.clear()
        for w in set(words).difference(seen):
            seen[w] = self.word(w)
        ids = np.array(list(map(seen.__getitem__, words)), dtype=np.uint64)
        pairs = (ids[:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (ids[1:] + np.uint64(0x165667B19E3779F9))
        pairs = (pairs ^ (pairs >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        pairs[ids[:-1] == ids[1:]] = self.twice
        return ((np.concatenate([ids, pairs]) >> np.uint64(20)) & self.mask).astype(np.int64)


def _sigmoid(z: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(z, -35.0, 35.0))))


def ftrl(examples: list[tuple[np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights, the bias last. Per-coordinate FTRL-proximal updates."""
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(i):
        zi = z[i]
        return np.where(np.abs(zi) <= L1, 0.0, (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    rows = []
    for slots, label in examples:
        i, c = np.unique(slots, return_counts=True)
        x = np.append(c * (SCALE / max(1, len(slots))), 1.0)
        rows.append((np.append(i, size - 1), x, label))
    for _ in range(epochs):
        for i, x, label in rows:
            w = weights(i)
            g = (_sigmoid(float(w @ x)) - label) * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    return weights(np.arange(size)).astype(np.float32)


def held_out(id_col: str = "doc_id") -> Column:
    """True for rows kept out of training (null ids are, too)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLD == HELD_OUT, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id",
          label_col: str = "quality", max_train: int = MAX_TRAIN) -> bytes:
    """Fit on the bounded sample, in one task; returns float32 weights."""
    usable = (labels.where(F.col(label_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).alias("_q_id"))
              .agg((F.avg(label_col) >= 0.5).cast("int").alias("_q_label")))
    sample = usable.withColumn("_q_h", F.xxhash64("_q_id")).orderBy("_q_h", "_q_id").limit(max_train)
    texts = (docs.select(F.col(id_col).alias("_q_id"), text_of(text).alias("_q_text"))
             .join(F.broadcast(sample), "_q_id")          # at most max_train rows
             .groupBy("_q_id", "_q_h", "_q_label").agg(F.max("_q_text").alias("_q_text")))

    def fit(batches):
        feats, examples = Features(), []
        for b in batches:
            cols = b.to_pydict()
            examples += [(feats.slots(t), y) for t, y in zip(cols["_q_text"], cols["_q_label"])]
        yield pa.RecordBatch.from_arrays([pa.array([ftrl(examples).tobytes()], pa.binary())], names=["weights"])

    one = texts.repartition(1).sortWithinPartitions("_q_h", "_q_id").select("_q_text", "_q_label")
    got = one.mapInArrow(giving_back(fit), "weights binary").collect()
    return bytes(got[0][0]) if got else b""


def score(docs: DataFrame, weights: bytes, text: str = "text", score_col: str = "score",
          predicted_col: str = "predicted") -> DataFrame:
    """``docs`` plus the score (0 to 1, higher: better) and the predicted label."""
    docs = replacing(docs, *({score_col, predicted_col} - {text}))
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType()),
                           T.StructField(predicted_col, T.IntegerType())])
    names, at = [f.name for f in schema], docs.columns.index(text)

    def run(batches):
        w = np.frombuffer(weights, dtype=np.float32) if weights else np.zeros((1 << BITS) + 1, np.float32)
        feats = Features()
        for b in batches:
            scores = []
            for t in b.column(at).to_pylist():
                s = feats.slots(t or "")
                scores.append(_sigmoid(float(w[-1]) + (SCALE * float(w[s].mean(dtype=np.float64)) if len(s) else 0.0)))
            s = np.array(scores, dtype=np.float64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=names)

    return docs.mapInArrow(giving_back(run), schema)


def keep_good(docs: DataFrame, weights: bytes, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier accepts."""
    return score(docs, weights, text, "_q_score", "_q_good").where("_q_good = 1").select(*docs.columns)
