"""The corpus pipeline: each stage's contract, and the registered queries."""

import math
import random
import re

import corpus_pipeline
import __spark_entry__ as E
from conftest import SF_SMALL
from docsift.llm import secret_scan
from docsift.llm.queries import QUERIES, SQL
from pyspark.sql import functions as F


def test_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    secret = docs.where("doc_id = 0").selectExpr("5000000 AS doc_id", "'a secret: Zx81Kq92Lm45 here' AS text", "lang", "source", "n_chars")
    docs = docs.unionByName(secret.selectExpr("bigint(doc_id) AS doc_id", "text", "lang", "source", "n_chars"))
    first, columns = docs, docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.columns == columns, name
        kept[name] = docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert 0 < kept["toxicity"].count() <= first.count()
    ids = [r.doc_id for r in kept["near_dedup"].collect()]
    assert len(ids) == len(set(ids)) < kept["toxicity"].count()
    masked = kept["secrets"].select(F.size(secret_scan.secret_spans(F.col("text"))).alias("n"), "text", "n_chars").collect()
    assert all(r.n == 0 for r in masked if "[SECRET]" not in r.text) and len(masked) == len(ids)
    assert any("[SECRET]" in r.text and r.n_chars == len(r.text) for r in masked)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert out.count() == docs.count()


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    rows = lambda d: sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in d.collect())
    assert rows(corpus_pipeline.run(spark, SF_SMALL)) == rows(docs) != []


def test_stages_on_hostile_and_empty_tables(spark):
    schema = spark.read.parquet(f"{SF_SMALL}/documents.parquet").schema
    hostile = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "x", None, "s", 1), (1, "x", None, "s", 1), (None, "y " * 20000, "en", "s", 40000)]
    for rows in ([], hostile):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_SMALL)
            assert name == "bpe" or out.columns == docs.columns
            got = out.collect()
            assert rows or not got, name
            docs = spark.createDataFrame(got, out.schema)


def test_masked_values_behind_names(spark):
    rng = random.Random(2)
    word = lambda n, of: "".join(rng.choice(of) for _ in range(n))
    texts, hidden = [], []
    for name in ("key=", "sha1_", "id-", "/v/", "sample-key=", "example_id-", "dummy/"):
        for _ in range(40):
            value = word(20, "0123456789abcdef")
            found = secret_scan.THRESHOLDS[r"^[0-9a-fA-F]+$"] <= -sum(value.count(c) / 20 * math.log2(value.count(c) / 20) for c in set(value))
            if found and not any(re.search(p, value) for p in secret_scan.ALLOW):
                texts.append(f"the {name}{value} end")
                hidden.append(value)
    texts += ["sample-key=aGVsbG8/d29ybGQ3Nzl_Z3RyZXc5MDg3-NjU0MzIx end", "an example-path/to/some/long/file12 and 550e8400-e29b-41d4-a716-446655440000"]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r for r in corpus_pipeline.mask_secrets(spark, docs, SF_SMALL).collect()}
    assert len(hidden) > 200 and [t for i, t in enumerate(texts[:-2]) if hidden[i] in out[i].text] == []
    assert out[len(texts) - 2].text.endswith("[SECRET] end") and out[len(texts) - 1].text == texts[-1]
    assert all(r.n_chars == len(r.text) for r in out.values())
