"""One test per semantic trap."""

import math

import pytest
from pyspark.sql import functions as F

from docsift.operators import aggs as A
from docsift.operators import facets as FC
from docsift.operators import query as Q
from docsift.operators.scoring import FunctionScore
from docsift.plans.search import Search


@pytest.fixture(scope="module")
def bikes(spark):
    rows = [(1, "Giant", ["S", "M"], 900.0, None), (2, "Trek", ["M", "L"], 1200.0, True), (3, "Trek", [], 700.0, False),
            (4, "Scott", None, None, True), (5, "Giant", ["XL"], float("nan"), None)]
    return spark.createDataFrame(rows, "id int, brand string, sizes array<string>, price double, instock boolean")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_multi_valued_term_is_contains(spark, bikes):
    s = Search(bikes, "id")
    assert ids(s.query(Q.Term("sizes", "M")).matched()) == [1, 2]
    assert ids(s.query(Q.field("sizes").ne("M")).matched()) == [3, 4, 5]  # does not contain, missing included


def test_multi_valued_bucket_counts_once_per_distinct_value(spark):
    df = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["a"])], "id int, tags array<string>")
    a = Search(df, "id").aggs(t=A.TermsAgg("tags"), n=A.ValueCount("tags")).aggregations()
    assert [(r.t, r.doc_count) for r in a["t"].collect()] == [("a", 2), ("b", 1)]
    assert a["n"].first().n == 4  # metrics see every value


def test_ne_keeps_missing_and_null_terms(spark, bikes):
    s = Search(bikes, "id")
    assert ids(s.query(Q.field("instock").ne(True)).matched()) == [1, 3, 5]
    assert ids(s.query(Q.field("instock").eq(None)).matched()) == [1, 5]
    assert ids(s.query(Q.field("instock").ne(None)).matched()) == [2, 3, 4]


def test_nan_never_matches_a_range(spark, bikes):
    s = Search(bikes, "id")
    assert ids(s.query(Q.Range("price", gte=-math.inf)).matched()) == [1, 2, 3]
    assert ids(s.query(Q.Range("price", lte=math.inf)).matched()) == [1, 2, 3]


def test_negative_zero_equals_zero(spark):
    df = spark.createDataFrame([(1, -0.0), (2, 0.0), (3, 1.0)], "id int, x double")
    s = Search(df, "id")
    assert ids(s.query(Q.Range("x", lte=0.0)).matched()) == [1, 2]
    assert ids(s.query(Q.Range("x", gte=-0.0, lte=-0.0)).matched()) == [1, 2]


def test_scores_by_context(spark, bikes):
    s = Search(bikes, "id")
    assert {r._score for r in s.query(Q.MatchAll()).hits().collect()} == {1.0}
    assert {r._score for r in s.query(Q.Bool(filter=[Q.Term("brand", "Trek")])).hits().collect()} == {0.0}
    assert {r._score for r in s.query(Q.MatchAll(boost=2.5)).hits().collect()} == {2.5}
    t = s.sort("price").total().first()
    assert t.max_score is None


def test_bool_boost_is_honoured(spark, bikes):
    q = Q.Bool(must=[Q.Term("brand", "Trek")], boost=3.0)
    assert {r._score for r in Search(bikes, "id").query(q).hits().collect()} == {3.0}


def test_lone_should_requires_a_match_and_msm(spark, bikes):
    s = Search(bikes, "id")
    assert ids(s.query(Q.Bool(should=[Q.Term("brand", "Trek")])).matched()) == [2, 3]
    # with must present, should is optional unless minimum_should_match is set
    q = Q.Bool(must=[Q.Exists("brand")], should=[Q.Term("brand", "Trek")])
    assert ids(s.query(q).matched()) == [1, 2, 3, 4, 5]
    q = Q.Bool(must=[Q.Exists("brand")], should=[Q.Term("brand", "Trek"), Q.Term("instock", True)], minimum_should_match=2)
    assert ids(s.query(q).matched()) == [2]


def test_minimum_should_match_resolution():
    M = Q.MinimumShouldMatch.of
    assert M(2).resolve(5) == 2
    assert M(-2).resolve(5) == 3
    assert M("75%").resolve(5) == 3
    assert M("-25%").resolve(5) == 4
    assert M("3<90%").resolve(3) == 3
    assert M("3<90%").resolve(10) == 9
    assert M("2<-25% 9<-3").resolve(12) == 9
    assert M("2<-25% 9<-3").resolve(8) == 6


def test_function_score_without_functions_keeps_query(spark, bikes):
    s = Search(bikes, "id").query(FunctionScore(Q.Term("brand", "Giant")))
    assert ids(s.matched()) == [1, 5]


def test_count_includes_post_filters(spark, bikes):
    s = Search(bikes, "id").filter(Q.Exists("brand")).post_filter(Q.Term("brand", "Trek"))
    assert s.count().first()["count"] == 2
    assert sum(r.doc_count for r in s.aggs(b=A.TermsAgg("brand")).aggregations()["b"].collect()) == 5


def test_facet_intersect_counts_under_own_selection(spark, bikes):
    qf = FC.QueryFilters([FC.FacetFilter("sizes", "sizes", mode=FC.INTERSECT)])
    res = qf.apply(Search(bikes, "id"), {"sizes": ["M"]})
    got = {(r.value, r.doc_count, r.selected) for r in res.facets["sizes"].collect()}
    assert got == {("M", 2, True), ("S", 1, False), ("L", 1, False)}


def test_facet_union_counts_without_own_selection(spark, bikes):
    qf = FC.QueryFilters([FC.FacetFilter("brand", "brand"), FC.FacetFilter("sizes", "sizes")])
    res = qf.apply(Search(bikes, "id"), {"brand": ["Trek", "Nope"], "sizes": ["M"]})
    got = {(r.value, r.doc_count, r.selected) for r in res.facets["brand"].collect()}
    assert got == {("Giant", 1, False), ("Trek", 1, True), ("Nope", 0, True)}
    assert res.total.first().total == 1


def test_unparseable_parameters_dropped_and_last_wins(spark, bikes):
    qf = FC.QueryFilters([FC.FacetRangeFilter("price", "price"), FC.FacetFilter("id", "id")])
    res = qf.apply(Search(bikes, "id"), {("price", "gte"): ["1000", "abc", "800"], "id": ["x", "1", "2.5"]})
    assert res.total.first().total == 1  # price >= 800 (last parseable) and id in (1)


def test_select_attribute_value_ids_must_be_non_negative(spark):
    from docsift.functions import packing as PK
    df = spark.createDataFrame([(1, -1)], "a int, v int")
    with pytest.raises(Exception):
        df.select(PK.encode_attr(F.col("a"), F.col("v"))).collect()


def test_percentiles_of_empty_input_give_no_values(spark):
    df = spark.createDataFrame([(1, None)], "id int, x double")
    r = Search(df, "id").aggs(p=A.Percentiles("x", percents=(50,))).aggregations()["p"].first()
    assert r.p_p50 is None


def test_dates_year_vs_epoch_millis(spark):
    from docsift.functions.dates import parse_date
    df = spark.createDataFrame([("2015",), ("20150",)], "s string")
    got = [r[0] for r in df.select(F.unix_millis(parse_date(F.col("s")))).collect()]
    assert got == [1420070400000, 20150]


def test_template_path_match_uses_full_path(spark):
    from docsift.sources.schema import Template
    t = Template("int", match="user.*")
    assert t.matches("user.id", None) and not t.matches("id", None)


def test_sum_of_empty_bucket_is_zero(spark, bikes):
    a = Search(bikes, "id").filter(Q.Term("brand", "none")).aggs(s=A.Sum("price")).aggregations()["s"].first()
    assert a.s == 0.0


def test_histogram_extended_bounds_clipped_by_hard_bounds(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([12, 13, 27, 41])], "id int, x double")
    a = Search(df, "id").aggs(h=A.Histogram("x", interval=10, min_doc_count=0, extended_bounds=(0, 90), hard_bounds=(10, 50)))
    got = [(r.h, r.doc_count) for r in a.aggregations()["h"].collect()]
    assert got == [(10.0, 2), (20.0, 1), (30.0, 0), (40.0, 1), (50.0, 0)]


def test_hamming_space_on_byte_vectors(spark):
    from docsift.operators.knn import KnnQuery
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 7.0]), (3, [0.0, 0.0, 0.0])], "id int, v array<float>")
    h = Search(df, "id").query(KnnQuery("v", (1, 2, 3), k=3, space="hamming")).size(3).hits().collect()
    # differing bits: id1 0, id2 (3^7=4) 1 bit, id3 1+1+2 = 4 bits
    assert [(r.id, r._score) for r in h] == [(1, 1.0), (2, 0.5), (3, 0.2)]


def test_results_share_one_persisted_base(spark, bikes):
    s = Search(bikes, "id").filter(Q.Exists("brand")).post_filter(Q.Term("brand", "Trek")).aggs(
        b=A.TermsAgg("brand"), p=A.Max("price"))
    r = s.results()
    assert len(r.cached) == 1
    assert sorted(x.id for x in r.hits.collect()) == sorted(x.id for x in s.hits().collect())
    assert r.total.first().total == 2
    assert sorted(map(tuple, r.aggregations["b"].collect())) == sorted(map(tuple, s.aggregations()["b"].collect()))
    r.release()
    assert Search(bikes, "id").aggs(b=A.TermsAgg("brand")).results(with_hits=False).cached == []


def test_range_facet_with_histogram_under_other_selections(spark, bikes):
    qf = FC.QueryFilters([FC.FacetRangeFilter("price", "price", aggs={"h": A.Histogram("price", interval=500, min_doc_count=1),
                                                                      "mn": A.Min("price")}),
                          FC.FacetFilter("brand", "brand")])
    res = qf.apply(Search(bikes, "id"), {("price", "gte"): ["800"], "brand": ["Trek", "Giant"]})
    assert [(r.h, r.doc_count) for r in res.facets["price>h"].collect()] == [(500.0, 2), (1000.0, 1)]
    r = res.facets["price"].first()
    assert (r["count"], r.mn) == (4, 700.0)


def test_templates_match_full_nested_paths(spark):
    from docsift.sources.schema import Template, apply_templates
    df = spark.createDataFrame([(1, ("7", "x"), [("3",), ("4",)])],
                               "id int, user struct<rating string, name string>, items array<struct<qty string>>")
    out = apply_templates(df, [Template("int", match="user.rating"), Template("bigint", match="items.qty"),
                               Template("int", match="rating")])  # a bare last-segment pattern must not match user.rating
    t = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    assert t["user"] == "struct<rating:int,name:string>"
    assert t["items"] == "array<struct<qty:bigint>>"
    r = out.first()
    assert r.user.rating == 7 and [i.qty for i in r["items"]] == [3, 4]
