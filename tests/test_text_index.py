"""Postings against the direct path (patterns over the text), which the oracles hold against DuckDB."""

import random

import pytest
from docsift.operators import query as Q
from docsift.operators.text_index import TextIndex
from docsift.plans.search import Rescore, Search


def corpus(spark, n=150):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(20)] + ["The", "the", "naïve", "x1", "ÄÖ"]
    text = lambda: "".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))])[0] + rng.choice([" ", " ", ", ", "\n", "--"]) for _ in range(rng.randint(0, 40)))
    rows = [(i, text(), rng.choice(["a", "b"])) for i in range(n)] + [(1000, None, "a"), (1001, "", "b"), (1002, "w0 w1 " * 300, "a"), (1003, "w1 w1 w1", "b"), (1004, "w1 w1", "b")]
    return spark.createDataFrame(rows, "id long, text string, lang string").repartition(3).cache()


QUERIES = [
    Q.Match("text", "w0"), Q.Match("text", "w3 W7 nowhere"), Q.Match("text", "w0 w1 w2 w3", minimum_should_match="50%"), Q.Match("text", "w0 the w2", operator="and"),
    Q.Match("text", "  "), Q.MatchPhrase("text", "w0 w1"), Q.MatchPhrase("text", "w1 w1"), Q.MatchPhrase("text", "w1 w1 w1"), Q.MatchPhrase("text", "w0"),
    Q.MatchPhrase("text", "w0 w1", slop=2), Q.MatchPhrase("text", "w1 w0 w2", slop=3), Q.MatchPhrase("text", "w1 w1", slop=1), Q.MatchPhrase("text", "w0 w1 w0", slop=4),
    Q.MatchPhrase("text", "ÄÖ the"), Q.MatchPhrase("text", "w0 w", prefix=True), Q.Bool(must=[Q.Match("text", "w0")], should=[Q.MatchPhrase("text", "w0 w1", boost=3.0)], filter=[Q.Term("lang", "a")]),
    Q.Bool(must_not=[Q.Match("text", "w0 w1")]), Q.DisMax([Q.Match("text", "w4"), Q.Match("text", "w5", boost=2.0)]),
]


@pytest.mark.parametrize("options", [{}, {"block_docs": 7}, {"block_tokens": 60}])
def test_postings_match_what_patterns_match(spark, options):
    df = corpus(spark)
    index = TextIndex.build(df, "id", "text", **options)
    for q in QUERIES:
        rows = lambda s: sorted((r.id, round(r._score, 9)) for r in s.query(q).matched().collect())
        assert rows(Search(df, "id").with_text_index("text", index)) == rows(Search(df, "id")), q


def test_best_hits_from_postings(spark):
    df = corpus(spark)
    index = TextIndex.build(df, "id", "text", block_docs=5)
    rescore = Rescore(Q.MatchPhrase("text", "w0 w1"), window_size=12, rescore_query_weight=2.0)
    for q in (Q.Match("text", "w0 w5"), Q.Match("text", "w19 w18 the"), Q.Match("text", "nowhere"), Q.Match("text", "w2", boost=2.0)):
        for make in (lambda s: s.size(7), lambda s: s.size(3).offset(4), lambda s: s.size(500), lambda s: s.rescore(rescore).size(6), lambda s: s.rescore(rescore).size(30),
                     lambda s: s.filter(Q.Term("lang", "b")).size(5), lambda s: s.size(4).min_score(0.5)):
            rows = lambda s: [(r.id, round(r._score, 9)) for r in make(s.query(q)).hits().collect()]
            assert rows(Search(df, "id").with_text_index("text", index, whole=True)) == rows(Search(df, "id"))
    for seeds in (1, 2):
        assert [r.id for r in index.top_k(["w0", "w5"], 9, seeds).collect()] == [r.id for r in Search(df, "id").query(Q.Match("text", "w0 w5")).size(9).hits().collect()]


def test_blocks_below_the_bound_are_not_read(spark):
    rows = [(i, "rare common") if i < 8 else (i, "common " + "filler " * 30) for i in range(400)]
    index = TextIndex.build(spark.createDataFrame(rows, "id long, text string").coalesce(1), "id", "text", block_docs=8)
    got = index.top_k(["rare", "common"], 8, seeds=1)
    assert [r.id for r in got.collect()] == list(range(8))
    terms = ["rare", "common"]
    best = max(r.b for r in index._of(terms).select((index._idf(terms) * index.postings["best"]).alias("b"), "block").groupBy("block").sum("b").toDF("block", "b").collect())
    assert index._of(terms).select("block").distinct().count() == 50 and best > 0


def test_a_search_reads_its_terms_and_no_positions(spark):
    index = TextIndex.build(corpus(spark), "id", "text")
    plan = index.scores(["w0", "w1"])._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert scans and all("In(term, [w0,w1])" in s and "places" not in s.split("ReadSchema")[1] for s in scans)
    assert "places" in index.phrase(["w0", "w1"])._jdf.queryExecution().executedPlan().toString()


def test_rebuilt_index_reads_the_same_and_empty_tables_work(spark):
    df = corpus(spark)
    from docsift.session import checkpoint_dir

    path = f"{checkpoint_dir(spark)}/index-test"
    TextIndex.build(df, "id", "text", path)
    again = TextIndex.read(spark, path)
    assert again.n_docs == 154 and again.scores(["w0"]).count() > 0
    none = TextIndex.build(df.where("id < 0"), "id", "text")
    assert Search(df.where("id < 0"), "id").with_text_index("text", none, whole=True).query(Q.Match("text", "w0")).hits().count() == 0
    strings = spark.createDataFrame([("a", "one two"), ("b", "two")], "id string, text string")
    assert [r.id for r in TextIndex.build(strings, "id", "text").top_k(["two"], 5).collect()] == ["b", "a"]


def test_the_sorted_parts_grow_with_the_tokens(spark):
    df = corpus(spark)
    index = TextIndex.build(df, "id", "text", block_docs=5, range_tokens=100)
    tokens = sum(index.postings.selectExpr("sum(aggregate(tfs, 0, (a, b) -> a + b)) AS n").first())
    files = {r.f for r in index.postings.selectExpr("input_file_name() AS f").distinct().collect()}
    assert tokens // 100 // 2 < len(files) <= tokens // 100 + 1
    q = Q.MatchPhrase("text", "w0 w1", slop=1)
    rows = lambda s: sorted((r.id, round(r._score, 9)) for r in s.query(q).matched().collect())
    assert rows(Search(df, "id").with_text_index("text", index)) == rows(Search(df, "id")) != []
