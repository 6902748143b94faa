"""Toxicity scores: FTRL-proximal logistic regression over hashed word features.

Features of a text: its words, word stems (the first bytes), adjacent pairs and
skip pairs (one word between), lower-cased and hashed to ``2 ** bits`` slots; a
feature counts once per document.  FTRL keeps a learning rate per coordinate
and its L1 term leaves most weights at zero, so the model is a short list of
(slot, weight), bounded by the number of slots, that every task gets.

Training reads a bounded sample of the labelled rows (at most ``per_class``
toxic and ``negatives * per_class`` other documents, smallest id hash first),
runs FTRL on ``shards`` shares of it in parallel and averages the weights.
Scoring covers every whole text of every row.

Hashing is vectorized: word hashes come from prefix sums over a block of texts,
and a block holds about ``_BLOCK`` bytes (one longer text is a block alone).

Edge cases: null and empty texts have the score of the intercept; without
labelled rows of both kinds every score is 0; a null label is no label, and
the larger one counts if an id has several; repeated rows get equal scores; an
empty table gives an empty result; other columns are kept by ``reject`` and
ignored otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import crc_fold
from docsift.llm.mixing import id_hash

_BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEM = 6
_ROWS = 500
# letters, digits and all bytes of longer UTF-8 sequences belong to words
_IN_WORD = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])


class _Powers:
    """Powers of the hash base and of its inverse modulo 2^64, grown on demand."""

    up = down = np.ones(0, dtype=np.uint64)

    @classmethod
    def get(cls, n: int):
        if len(cls.up) < n:
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            cls.up, cls.down = (np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(n, b, np.uint64))])
                                for b in (_BASE, inverse))
        return cls.up, cls.down


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)


def blocks(texts: list, size: int = _BLOCK) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of consecutive lower-cased texts of about ``size`` bytes: (first index, texts)."""
    lo, part, held = 0, [], 0
    for i, t in enumerate(texts):
        b = (t or "").lower().encode("utf-8", "surrogatepass")
        if part and (held + len(b) > size or len(part) >= 1 << 15):
            yield lo, part
            lo, part, held = i, [], 0
        part.append(b)
        held += len(b)
    if part:
        yield lo, part


def features(texts: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(document number, slot) of every feature occurrence of a block of lower-cased texts."""
    buf = np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8)
    inside = _IN_WORD[buf]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside])))
    start, end = edge[0::2], edge[1::2]
    up, down = _Powers.get(len(buf) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[:len(buf)])])
    piece = lambda a, b: _mix((total[b] - total[a]) * down[a])
    word = piece(start, end)
    stem = piece(start, np.minimum(start + _STEM, end)) + np.uint64(0x632BE59BD9B4E019)
    after = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(after, start, side="right")
    near, far = doc[1:] == doc[:-1], doc[2:] == doc[:-2]
    pair = (word[:-1] * np.uint64(0xE7037ED1A0B428DB) + word[1:])[near]
    skip = (word[:-2] * np.uint64(0x8EBC6AF09C88C6E3) + word[2:])[far]
    slot = np.concatenate([word, _mix(stem), _mix(pair), _mix(skip)]) >> np.uint64(64 - bits)
    return np.concatenate([doc, doc, doc[:-1][near], doc[:-2][far]]), slot.astype(np.int64)


def ftrl(rows: list[tuple[np.ndarray, int]], bits: int, alpha: float, beta: float, l1: float, l2: float, epochs: int):
    """Weights (last one: the intercept) after FTRL-proximal steps over ``rows`` of (distinct slots, label)."""
    z = np.zeros((1 << bits) + 1)
    n = np.zeros((1 << bits) + 1)

    def weights(i):
        w = -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)
        return np.where(np.abs(z[i]) <= l1, 0.0, w)

    for _ in range(epochs):
        for slots, y in rows:
            i = np.append(slots, 1 << bits)
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - y
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    size = (1 << bits) + 1
    return np.concatenate([weights(np.arange(lo, min(size, lo + (1 << 16)))) for lo in range(0, size, 1 << 16)])


def train(docs: DataFrame, labels: DataFrame, bits: int = 22, per_class: int = 4000, negatives: int = 2, shards: int = 1,
          alpha: float = 1.0, beta: float = 1.0, l1: float = 5.0, l2: float = 0.02, epochs: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """(slots, weights) of the non-zero weights; slot ``2 ** bits`` is the intercept.

    ``labels``: (doc_id, label 0 or 1).  The sample's ids (``per_class *
    (1 + negatives)`` at most) are broadcast.
    """
    marked = labels.where("label IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    marked = marked.withColumn("h", id_hash(F.col("doc_id")))
    ids = [marked.where(F.col("label") == y).orderBy("h", "doc_id").limit(n) for y, n in ((1, per_class), (0, negatives * per_class))]
    sample = F.broadcast(ids[0].union(ids[1]))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slots = []
            for at in range(0, b.num_rows, _ROWS):
                for _, part in blocks(b.column("text").slice(at, _ROWS).to_pylist()):
                    doc, slot = features(part, bits)
                    both = np.unique(doc << bits | slot)
                    cut = np.searchsorted(both, np.arange(1, len(part)) << bits)
                    slots += [(x & ((1 << bits) - 1)).astype(np.int32).tobytes() for x in np.split(both, cut)]
            yield pa.RecordBatch.from_arrays([b.column("h"), b.column("label"), pa.array(slots, pa.binary())], names=["h", "label", "slots"])

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "slots"])
        w = ftrl([(np.frombuffer(s, np.int32), int(y)) for s, y in zip(pdf["slots"], pdf["label"])],
                 bits, alpha, beta, l1, l2, epochs)
        i = np.flatnonzero(w)
        return pd.DataFrame({"slot": i, "weight": w[i], "kinds": pdf["label"].nunique()})

    rows = docs.select("doc_id", "text").join(sample, "doc_id").select("h", F.col("label").cast("int").alias("label"), "text")
    rows = rows.mapInArrow(hashed, "h bigint, label int, slots binary")
    per_shard = rows.groupBy(F.pmod(F.xxhash64("h"), F.lit(shards)).alias("shard")).applyInPandas(
        learn, "slot bigint, weight double, kinds int")
    model = per_shard.where("kinds = 2").groupBy("slot").agg((F.sum("weight") / shards).alias("weight")).toPandas()
    model = model.sort_values("slot")
    return model["slot"].to_numpy(np.int64), model["weight"].to_numpy(np.float64)


def _probabilities(texts: list, dense: np.ndarray, bits: int) -> np.ndarray:
    """Score of each text; ``dense``: a weight per slot, then the intercept (NaN: nothing was learned)."""
    if np.isnan(dense[-1]):
        return np.zeros(len(texts))
    out = np.full(len(texts), dense[-1])
    for lo, part in blocks(texts):
        doc, slot = features(part, bits)
        hit = np.flatnonzero(dense[slot])
        once = np.unique(doc[hit] << bits | slot[hit])
        out[lo:lo + len(part)] += np.bincount(once >> bits, dense[once & ((1 << bits) - 1)], minlength=len(part))
    return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def _sliced(texts: pa.Array, dense: np.ndarray, bits: int) -> np.ndarray:
    """Scores of an Arrow column, of which some rows at a time become Python strings."""
    parts = [_probabilities(texts.slice(lo, _ROWS).to_pylist(), dense, bits) for lo in range(0, len(texts), _ROWS)]
    return np.concatenate([np.zeros(0), *parts])


def _dense(model: tuple[np.ndarray, np.ndarray], bits: int) -> np.ndarray:
    slots, weights = model
    dense = np.zeros((1 << bits) + 1)
    dense[slots] = weights
    if not len(slots):
        dense[-1] = np.nan
    return dense


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], bits: int = 22) -> DataFrame:
    """doc_id and score (0 to 1) of every row; the model is broadcast, its size is bounded by the slots."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = _dense(shared.value, bits)
        for b in batches:
            p = _sliced(b.column("text"), dense, bits)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(p, pa.float64())], names=["doc_id", "score"])

    ids = docs.select("doc_id", "text")
    return ids.mapInArrow(run, f"doc_id {ids.schema['doc_id'].dataType.simpleString()}, score double")


THRESHOLD = 0.7


def reject(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], threshold: float = THRESHOLD, bits: int = 22) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is below ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def probability(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        dense = _dense(shared.value, bits)
        for texts in batches:
            yield pa.array(_sliced(texts, dense, bits), pa.float64())

    # only the texts go to Python, and only a number comes back
    return docs.where(probability("text") < threshold)


def fit_labelled(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Model of the ``toxic`` labels outside the held-out fold (crc32 of the id modulo 3 is 1)."""
    seen = labels.where(crc_fold(F.col("doc_id"), 3) != 1).select("doc_id", F.col("toxic").alias("label"))
    return train(docs, seen)


def op7(spark, sf_dir):
    from docsift.llm.common import read

    docs = read(spark, sf_dir, "documents")
    out = score(docs, fit_labelled(docs, read(spark, sf_dir, "labels")))
    return out.select("doc_id", (crc_fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
