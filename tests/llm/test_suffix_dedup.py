"""Substring deduplication against brute force over every window."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from docsift.llm.suffix_dedup import bwt, remove_repeats, repeats

SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("n_bytes", StringType())])


def brute(rows, length):
    rows = [(2**63 - 1 if i is None else i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in rows:
        for s in range(len(t) - length + 1):
            w = t[s:s + length]
            if w not in first or (i, s) < first[w]:
                first[w] = (i, s)
    out = []
    for i, t in rows:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            if (i, s) > first[t[s:s + length]]:
                gone[s:s + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((None if i == 2**63 - 1 else i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, docs=60):
    rng = random.Random(seed)
    syllables = ["the", "on", "ré", "tion ", " of", "a", "Zu ", "\n", "漢", "th"]
    text = lambda n: "".join(rng.choice(syllables) for _ in range(n))
    passages = [text(60) for _ in range(4)]
    rows = [(None, passages[0]), (None, text(80)), (3, None), (4, ""), (5, "x"), (6, "Zu " * 150), (7, "Zu " * 90)]
    for i in range(10, 10 + docs):
        parts = [text(rng.randint(0, 60)) if rng.random() < 0.5 else rng.choice(passages) for _ in range(rng.randint(1, 5))]
        if rng.random() < 0.4:  # a near copy
            t = list("".join(parts))
            if t:
                t[rng.randrange(len(t))] = "#"
            parts = ["".join(t)]
            passages[rng.randrange(4)] = parts[0]
        rows.append((i, "".join(parts)))
    rows += rows[-5:] + [(1000 + i, t) for i, t in rows[20:30] if i is not None]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, length, options", [
    (1, 100, {}), (2, 100, {"hot": 1}), (3, 40, {"hot": 3, "block_bytes": 2000, "merge_bytes": 500, "shard_bytes": 300}),
    (4, 60, {"block_bytes": 1500}), (5, 20, {"hot": 2, "block_bytes": 3000})])
def test_equals_brute_force(spark, seed, length, options):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA).repartition(3)
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest())
           for r in remove_repeats(docs, length, **options).collect()]
    assert sorted(got, key=str) == brute(rows, length)


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_merged_intervals_equal_those_of_all_windows():
    rng = random.Random(7)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 30))) for _ in range(40)]
    shards, where = [], []
    for lo in range(0, 40, 7):
        part = strings[lo:lo + 7]
        before, leads, string, offset = bwt(part)
        shards.append((before, leads))
        where += [(lo + int(s), int(o)) for s, o in zip(string, offset)]
    rows, group = repeats(shards, 8)
    got = {}
    for r, g in zip(rows.tolist(), group.tolist()):
        got.setdefault(g, set()).add(where[r])
    expected = {}
    for i, s in enumerate(strings):
        for o in range(len(s) - 7):
            expected.setdefault(s[o:o + 8], set()).add((i, o))
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in expected.values() if len(v) > 1)
