"""The corpus pipeline over ``documents``: toxicity, near duplicates, secrets, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from docsift.llm import bpe, mixing, secret_scan, simhash, toxicity
from docsift.llm.common import discard, read, scratch, written


def reject_toxic(spark, docs, sf_dir):
    """Documents that the classifier does not reject."""
    return toxicity.reject(docs, toxicity.fit_labelled(docs, read(spark, sf_dir, "labels")))


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near duplicates (three-word shingles, two bits)."""
    return simhash.deduplicate(docs)


def mask_secrets(spark, docs, sf_dir):
    """All documents, with their secrets masked."""
    found = docs.withColumn("__spans", secret_scan.secret_spans(F.col("text"), values=True))
    masked = F.when(F.size("__spans") > 0, secret_scan.redact(F.col("text"), F.col("__spans"))).otherwise(F.col("text"))
    found = found.withColumn("text", masked)
    length = F.when(F.size("__spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", length).drop("__spans")


def mix(spark, docs, sf_dir):
    """The documents that the mix takes, as often as it takes them."""
    return mixing.mix_documents(docs)


def encode(spark, docs, sf_dir):
    """doc_id, token ids and their count, and the digests of ids and decoded bytes."""
    import public_tokenizers

    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", reject_toxic), ("near_dedup", near_dedup), ("secrets", mask_secrets), ("mixing", mix), ("bpe", encode)]

# A trained classifier and 64-bit hashes of shingles are not expressible in SQL: tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages; each stage's result is written before the next one reads it, as that reads it more than once.

    What a stage wrote for itself is deleted at its end, its input once its result stands.
    """
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        keep = []
        with scratch(keep=keep):
            keep.append(written(stage(spark, docs, sf_dir), f"pipeline-{name}"))
        if before is not None:
            discard(before)
        docs = before = keep[0]
    return STAGES[-1][1](spark, docs, sf_dir)
