"""Language identification by rank-order n-gram profiles.

A profile is the list of the most frequent n-grams (one to three bytes of the
lower-cased text, runs of other ASCII characters than letters as one blank).
A document is compared to each language's profile by the out-of-place distance:
for each of the document's most frequent n-grams, how far its rank is from its
rank in the profile, or the profile's length if it is missing there.  The least
distance wins, ties by the language's name.

Profiles are counted over a bounded sample of the labelled rows (about
``per_lang`` documents of each language, by id hash), pre-aggregated per block
of texts and then by Spark.  They hold ``length`` rows per language and are
broadcast.  Every whole text is compared.

Edge cases: a null text, one without letters, or no labelled rows at all give
``und`` and score 0; null languages are not learned; repeated rows get equal
results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docsift.llm.common import crc_fold, written
from docsift.llm.mixing import HASH_BITS, id_hash
from docsift.llm.toxicity import blocks

LENGTH = 300
LANGUAGES = 4096  # profiles of a broadcast; more languages take several, one after the other
_LETTER = regex.compile(r"\p{L}")
_CLASS = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], dtype=np.uint8)


def ngrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document number, n-gram code, count) of a block of lower-cased texts, by document."""
    buf = _CLASS[np.frombuffer(b" ".join(b" " + t for t in texts) + b" ", dtype=np.uint8)]
    doc = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in texts])
    keep = np.ones(len(buf), dtype=bool)
    keep[1:] = (buf[1:] != 32) | (buf[:-1] != 32) | (doc[1:] != doc[:-1])
    buf, doc = buf[keep].astype(np.int64), doc[keep]
    keys = [(doc << 24 | buf)[buf != 32]]
    two = buf[:-1] | buf[1:] << 8
    keys.append((doc[:-1] << 24 | two)[doc[1:] == doc[:-1]])
    keys.append((doc[:-2] << 24 | two[:-1] | buf[2:] << 16)[doc[2:] == doc[:-2]])
    key = np.sort(np.concatenate(keys))
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(key)))
    return key[first] >> 24, key[first] & 0xFFFFFF, count


def train(docs: DataFrame, length: int = LENGTH, per_lang: int = 5000) -> dict[str, np.ndarray]:
    """Profile of each language of ``docs`` (doc_id, text, lang): its n-gram codes, most frequent first."""
    docs = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    sizes = written(docs.groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("n")), "language-sizes")
    share = F.least(F.lit(1.0), F.lit(float(per_lang)) / F.col("n"))
    sample = docs.join(sizes, F.col("lang") == F.col("of")).where(id_hash(F.col("doc_id")) < share * float(1 << HASH_BITS))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, texts = b.column("lang").to_pylist(), b.column("text").to_pylist()
            for lang in sorted(set(langs)):
                for _, part in blocks([t for x, t in zip(langs, texts) if x == lang]):
                    _, code, n = ngrams(part)
                    code, at = np.unique(code, return_inverse=True)
                    total = np.bincount(at, n, minlength=len(code)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code), pa.string()), pa.array(code, pa.int64()), pa.array(total)],
                                                     names=["lang", "code", "n"])

    counted = sample.select("lang", "text").mapInArrow(count, "lang string, code bigint, n bigint")
    best = Window.partitionBy("lang").orderBy(F.col("n").desc(), "code")
    top = counted.groupBy("lang", "code").agg(F.sum("n").alias("n")).withColumn("r", F.row_number().over(best)).where(F.col("r") <= length)
    rows = top.select("lang", "code", "r").toPandas().sort_values(["lang", "r"])
    return {lang: g["code"].to_numpy(np.int64) for lang, g in rows.groupby("lang")}


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], length: int = LENGTH, languages: int = LANGUAGES) -> DataFrame:
    """doc_id, lang_pred and score of every row (score: one less the distance as a share of the largest possible one)."""
    ids, langs = docs.select("doc_id", "text"), sorted(profiles)
    kind = ids.schema["doc_id"].dataType.simpleString()
    out = ids.select("doc_id", "text", F.lit("und").alias("lang_pred"), F.lit(-1.0).alias("score"))
    for lo in range(0, max(1, len(langs)), languages):  # each step carries the best language so far; the first of equals stays
        out = _step(out, {x: profiles[x] for x in langs[lo:lo + languages]}, length, kind)
    return out.select("doc_id", "lang_pred", F.greatest("score", F.lit(0.0)).alias("score"))


def _step(docs: DataFrame, profiles: dict[str, np.ndarray], length: int, kind: str) -> DataFrame:
    langs = sorted(profiles)
    codes = np.unique(np.concatenate([profiles[x] for x in langs])) if langs else np.zeros(0, np.int64)
    ranks = np.full((len(langs), len(codes) + 1), -1, dtype=np.int64)
    for i, x in enumerate(langs):
        ranks[i, np.searchsorted(codes, profiles[x])] = np.arange(len(profiles[x]))
    shared = docs.sparkSession.sparkContext.broadcast((langs, codes, ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, codes, ranks = shared.value
        for b in batches:
            texts = b.column("text").to_pylist()
            pred, score = b.column("lang_pred").to_pylist(), b.column("score").to_numpy().copy()
            for lo, part in blocks(texts) if langs else ():
                doc, code, n = ngrams(part)
                order = np.lexsort((code, -n, doc))  # by document, frequent first, then by code
                doc, code = doc[order], code[order]
                rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
                top = rank < length
                doc, code, rank = doc[top], code[top], rank[top]
                at = np.searchsorted(codes, code)
                at[(at == len(codes)) | (codes[np.minimum(at, len(codes) - 1)] != code)] = len(codes)
                least, best = np.full(len(part), np.inf), np.zeros(len(part), np.int64)
                for i in range(len(langs)):
                    r = ranks[i, at]
                    away = np.bincount(doc, np.where(r < 0, length, np.abs(r - rank)), minlength=len(part))
                    better = away < least
                    least[better], best[better] = away[better], i
                most = np.maximum(1, np.bincount(doc, minlength=len(part)) * length)
                for j in range(len(part)):
                    t, s = texts[lo + j], 1 - least[j] / most[j]
                    if t and s > score[lo + j] and _LETTER.search(t):
                        pred[lo + j], score[lo + j] = langs[best[j]], s
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text"), pa.array(pred, pa.string()), pa.array(np.minimum(score, 1))],
                                             names=["doc_id", "text", "lang_pred", "score"])

    return docs.mapInArrow(run, f"doc_id {kind}, text string, lang_pred string, score double")


def op5(spark, sf_dir):
    from docsift.llm.common import read

    docs = read(spark, sf_dir, "documents")
    held_out = crc_fold(F.col("doc_id"), 4) == 2
    out = predict(docs, train(docs.where(~held_out)))
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
