"""Relations over the bucketed family layout, and over many rows without a parent."""

from docsift.operators import query as Q
from docsift.operators import relations as RL
from docsift.plans.search import Search


def family(spark):
    rows = [(f"p{i}", ("q", None), i, None) for i in range(30)]
    rows += [(f"c{i}-{k}", ("a", f"p{i}"), None, i + k) for i in range(0, 40, 2) for k in range(i % 5)]  # some parents are missing
    rows += [("stray", ("a", None), None, 7)]
    return spark.createDataFrame(rows, "id string, join struct<name string, parent string>, x int, y int")


QUERIES = [
    RL.HasChild("a", Q.Range("y", gte=5)), RL.HasChild("a", Q.MatchAll(), min_children=2, max_children=3, score_mode="sum"),
    Q.Bool(must=[RL.HasChild("a", Q.Range("y", lt=20), score_mode="avg")], filter=[Q.Range("x", gte=4)]),
    RL.HasParent("q", Q.Range("x", gte=10)), RL.HasParent("q", Q.MatchAll(), score_=True), Q.Bool(must_not=[RL.HasChild("a", Q.MatchAll())]),
    Q.Bool(must_not=[RL.HasParent("q", Q.MatchAll())]), RL.ParentId("a", "p4"),
]


def test_both_layouts_find_the_same(spark):
    plain = family(spark)
    stored = RL.store_families(plain, "id", buckets=4)
    for q in QUERIES:
        rows = lambda df: sorted((r.id, round(r._score, 9)) for r in Search(df, "id").query(q).matched().collect())
        assert rows(stored) == rows(plain), q
        hits = lambda df: sorted(r.id for r in Search(df, "id").query(Q.MatchAll()).post_filter(q).size(None).hits().collect())
        assert hits(stored) == hits(plain) == [i for i, _ in rows(plain)]


def test_post_filters_look_at_the_whole_collection(spark):
    for df in (family(spark), RL.store_families(family(spark), "id", buckets=4)):
        s = Search(df, "id").query(Q.Term("join.name", "q"))
        child = RL.HasChild("a", Q.Range("y", gte=5))
        expected = sorted(r.id for r in s.filter(child).size(None).hits().collect())
        assert sorted(r.id for r in s.post_filter(child).size(None).hits().collect()) == expected != []


def test_stored_families_are_not_shuffled(spark):
    stored = RL.store_families(family(spark), "id", buckets=4)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for q in QUERIES[:5]:
            plan = lambda df: Search(df, "id").query(q).matched()._jdf.queryExecution().executedPlan().toString()
            assert "Join" in plan(stored) and "Exchange" not in plan(stored), q
            assert "Exchange" in plan(family(spark))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_only_the_asked_score_modes_are_computed(spark):
    plan = Search(family(spark), "id").query(RL.HasChild("a", Q.MatchAll(), score_mode="max")).matched()._jdf.queryExecution().optimizedPlan().toString()
    assert "_max" in plan and "_avg" not in plan and "_multiply" not in plan


def test_rows_without_a_parent_are_spread(spark):
    rows = [(f"p{i}", ("q", None), 1) for i in range(4000)] + [(f"c{i}", ("a", f"p{i}"), 2) for i in range(10)]
    df = spark.createDataFrame(rows, "id string, join struct<name string, parent string>, x int")
    for conf in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
        spark.conf.set(conf, {"spark.sql.adaptive.enabled": "false"}.get(conf, "-1"))
    try:
        out = Search(df, "id").query(Q.Bool(should=[RL.HasParent("q", Q.MatchAll()), Q.MatchAll()])).matched()
        sizes = out.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect()
        assert sum(sizes) == 4010 and max(sizes) < 1500
    finally:
        for conf in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
            spark.conf.unset(conf)


def test_larger_collections_take_more_buckets(spark, monkeypatch):
    monkeypatch.setattr(RL, "BUCKET_ROWS", 10)
    n = family(spark).count()
    for least in (2, 64):
        stored = RL.store_families(family(spark), "id", buckets=least)
        files = {r.f for r in stored.selectExpr("input_file_name() AS f").distinct().collect()}
        plan = stored.groupBy(RL.FAMILY).count()._jdf.queryExecution().executedPlan().toString()
        assert f"SelectedBucketsCount: {max(least, -(-n // 10))} out of" in plan and "Exchange" not in plan and len(files) > 1
        assert stored.count() == n
