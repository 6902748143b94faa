"""Several searches in one pass give what each gives alone."""

import random

from docsift.operators import query as Q
from docsift.operators import relations as RL
from docsift.plans.search import Rescore, Search, multi_search


def frame(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["red", "green", "blue", "w"], k=6)), rng.choice([1, 2, 3, None]), ("p" if i < 50 else "c", None if i < 50 else rng.randrange(60)))
            for i in range(200)]
    spark.createDataFrame(rows, "id long, text string, x int, join struct<name string, parent long>").write.parquet(str(tmp_path / "t"))
    return spark.read.parquet(str(tmp_path / "t"))


def searches(df):
    s = Search(df, "id")
    return [s.query(Q.Match("text", "red blue")).size(7), s.query(Q.Match("text", "green")).size(3).offset(4), s.filter(Q.Term("x", 2)).sort("-x", "text").size(9),
            s.query(Q.Bool(must=[Q.Match("text", "red")], filter=[Q.Range("x", gte=2)])).post_filter(Q.Term("x", 3)).size(5), s.size(4),
            s.query(RL.HasChild("c", Q.Match("text", "blue"), score_mode="sum")).size(6), s.query(Q.Match("text", "red")).sort("x").track_scores().size(5),
            s.query(Q.Match("text", "red green")).min_score(0.6).size(50)]


def rows_of(found):
    return sorted((r.query_id, r.id, None if r._score is None else round(r._score, 9)) for r in found.collect())


def test_same_rows_as_each_search_alone(spark, tmp_path):
    all_ = searches(frame(spark, tmp_path))
    found = multi_search(all_)
    alone = [(i, r.id, None if r._score is None else round(r._score, 9)) for i, s in enumerate(all_) for r in s.hits().collect()]
    assert rows_of(found) == sorted(alone, key=str) or rows_of(found) == sorted(alone)
    order = [(r.query_id, r.id) for r in found.collect()]
    assert order == [(i, r.id) for i, s in enumerate(all_) for r in s.hits().collect()]


def test_three_searches_scan_once(spark, tmp_path):
    df = frame(spark, tmp_path)
    s = Search(df, "id")
    found = multi_search([s.filter(Q.Term("x", 1)).sort("text").size(2), s.filter(Q.Term("x", 2)).sort("-id").size(3), s.filter(Q.Range("x", gte=3)).size(4)])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "WindowGroupLimit" in plan and "PushedFilters: [Or(" in plan
    assert len(found.collect()) == 9


def test_searches_that_need_their_own_pass(spark, tmp_path):
    df = frame(spark, tmp_path)
    s = Search(df, "id")
    mixed = [s.query(Q.Match("text", "red")).size(None), s.query(Q.Match("text", "red")).size(2), s.query(Q.Match("text", "blue")).size(2),
             s.query(Q.Match("text", "blue")).rescore(Rescore(Q.Match("text", "green"), window_size=5)).size(3), Search(df.where("id > 20"), "id").size(2)]
    got = rows_of(multi_search(mixed))
    assert got == sorted((i, r.id, round(r._score, 9)) for i, m in enumerate(mixed) for r in m.hits().collect())
