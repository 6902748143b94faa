"""End-to-end fixtures of the reference's integration tests, rebuilt as small
DataFrames, with the expected values they pin."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.operators import aggs as A
from docsift.operators import facets as FC
from docsift.operators import query as Q
from docsift.operators import relations as RL
from docsift.operators import writes as WR
from docsift.operators.knn import Knn
from docsift.operators.sort import NestedSort, Sort
from docsift.plans.search import Search

ITEM = T.StructType([T.StructField("product_id", T.LongType()), T.StructField("product_name", T.StringType()),
                     T.StructField("product_price", T.FloatType()), T.StructField("quantity", T.IntegerType())])
USER = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                     T.StructField("phone", T.StringType()), T.StructField("rating", T.FloatType())])
ORDER = T.StructType([T.StructField("id", T.StringType()), T.StructField("user", USER), T.StructField("items", T.ArrayType(ITEM)),
                      T.StructField("status", T.IntegerType()), T.StructField("comment", T.StringType()),
                      T.StructField("dateCreated", T.TimestampType())])

KARLSON = (1, "Karlson", "+1", 4.5)
SVANTE = (2, "Svante", "+2", 3.0)


def _orders(spark, with_104=False):
    rows = [
        ("101", KARLSON, [(1, "Jam", 5.0, 3)], 0, "Need more jam", dt.datetime(2019, 4, 30, 12, 29, 35)),
        ("102", KARLSON, [(2, "donut", 0.2, 100)], 0, None, dt.datetime(2020, 12, 23, 8, 47, 8)),
        ("103", KARLSON, [(2, "donut", 0.1, 10)], 1, None, dt.datetime(2020, 12, 31, 23, 59, 59)),
        ("105", SVANTE, [(3, "Collar", 10.0, 2), (4, "Dog food", 1.99, 9), (2, "donut", 0.2, 2)], 0, None,
         dt.datetime(2021, 10, 9, 15, 31, 45)),
    ]
    if with_104:
        rows.insert(3, ("104", KARLSON, [(2, "donut", 0.1, 10)], 1, None, dt.datetime(2020, 12, 31, 0, 0, 0)))
    return spark.createDataFrame(rows, ORDER)


def test_match_all_total_and_max_score(spark):
    t = Search(_orders(spark), "id").query(Q.MatchAll()).total().first()
    assert (t.total, t.max_score) == (4, 1.0)


def test_filter_only_scores_zero_and_term_on_number_scores_one(spark):
    s = Search(_orders(spark), "id")
    h = s.query(Q.Bool(filter=[Q.Term("status", 0)])).hits().collect()
    assert {r._score for r in h} == {0.0}
    h = s.query(Q.Term("status", 0)).hits().collect()
    assert {r._score for r in h} == {1.0}


def test_terms_of_status(spark):
    a = Search(_orders(spark), "id").aggs(status=A.TermsAgg("status")).aggregations()["status"]
    assert [(r.status, r.doc_count) for r in a.collect()] == [(0, 3), (1, 1)]


def test_year_histogram(spark):
    a = Search(_orders(spark), "id").aggs(y=A.DateHistogram("dateCreated", calendar_interval="year")).aggregations()["y"]
    got = [(r.y_as_string[:4], r.doc_count) for r in a.collect()]
    assert got == [("2019", 1), ("2020", 2), ("2021", 1)]


def test_nested_price_histogram(spark):
    a = Search(_orders(spark), "id").aggs(cart=A.NestedAgg(path="items", aggs={
        "price": A.Histogram("items.product_price", interval=1.0, min_doc_count=1)})).aggregations()
    assert a["cart"].first().doc_count == 6
    assert [(r.price, r.doc_count) for r in a["cart>price"].collect()] == [(0.0, 3), (1.0, 1), (5.0, 1), (10.0, 1)]


def test_sort_by_nested_sum_of_quantity(spark):
    s = Search(_orders(spark), "id").sort(Sort("items.quantity", "desc", mode="sum", nested=NestedSort("items")))
    h = s.hits().collect()
    assert [r.id for r in h] == ["102", "105", "103", "101"]
    assert h[0]._score is None  # sorting by a field gives no score


def test_script_sort_by_date_desc(spark):
    s = Search(_orders(spark), "id").sort(Sort(script="unix_millis(dateCreated)", order="desc"))
    assert [r.id for r in s.hits().collect()] == ["105", "103", "102", "101"]


def test_nested_query_same_element(spark):
    o = _orders(spark)
    q = Q.Nested("items", Q.Bool(filter=[Q.Term("items.product_name", "donut"), Q.Range("items.quantity", gte=50)]))
    assert [r.id for r in Search(o, "id").query(q).hits().collect()] == ["102"]
    q2 = Q.Nested("items", Q.Bool(filter=[Q.Term("items.product_name", "Collar"), Q.Range("items.quantity", gte=5)]))
    assert Search(o, "id").query(q2).hits().count() == 0  # Collar x2 and Dog food x9 are different elements


def test_update_by_query_status(spark):
    new, rep = WR.update_by_query(_orders(spark), "id", Q.Term("status", 0), {"status": "1"})
    r = rep.first()
    assert (r.total, r.updated, r.noops) == (3, 3, 0)
    assert new.filter("status = 1").count() == 4


def test_delete_by_query(spark):
    new, rep = WR.delete_by_query(_orders(spark), "id", Q.Term("status", 0))
    assert rep.first().deleted == 3
    assert new.count() == 1


def test_runtime_day_of_week(spark):
    s = Search(_orders(spark, with_104=True).filter("id != '105'"), "id").runtime_field(
        "dow", "date_format(dateCreated, 'EEE')", "string").aggs(dow=A.TermsAgg("dow"))
    got = [(r.dow, r.doc_count) for r in s.aggregations()["dow"].collect()]
    assert got == [("Thu", 2), ("Tue", 1), ("Wed", 1)]


def test_top_hits_per_status(spark):
    a = Search(_orders(spark), "id").aggs(st=A.TermsAgg("status", aggs={
        "top": A.TopHits(size=2, sort=(Sort("dateCreated", "desc"),), source=("id",))})).aggregations()["st>top"]
    got = sorted((r.st, r._rank, r.id) for r in a.collect())
    assert got == [(0, 1, "105"), (0, 2, "102"), (1, 1, "103")]


# ------------------------------------------------------------------ parent / child


def _family(spark):
    rows = [
        ("q~1", ("question", None), 1, "What is the answer to life, the universe, and everything?", None),
        ("a~1", ("answer", "q~1"), 1, "Maybe 50?", None),
        ("a~2", ("answer", "q~1"), 2, "It's 42.", True),
        ("q~2", ("question", None), 2, "I cannot think of a question, so I'll just ask you to guess the number I'm thinking of.", None),
        ("a~3", ("answer", "q~2"), 3, "8", None),
        ("a~4", ("answer", "q~2"), 4, "11", None),
        ("a~5", ("answer", "q~2"), 5, "17", True),
    ]
    return spark.createDataFrame(rows, "_id string, join struct<name string, parent string>, id int, text string, accepted boolean")


def test_has_child_min_max(spark):
    f = _family(spark)
    s = Search(f, "_id")
    ids = lambda q: sorted(r._id for r in s.query(q).size(None).hits().collect())
    assert ids(RL.HasChild("answer", Q.MatchAll(), min_children=1)) == ["q~1", "q~2"]
    assert ids(RL.HasChild("answer", Q.MatchAll(), max_children=2)) == ["q~1"]
    assert ids(RL.HasChild("answer", Q.MatchAll(), min_children=3)) == ["q~2"]
    assert ids(RL.HasChild("answer", Q.Term("accepted", True))) == ["q~1", "q~2"]


def test_has_parent(spark):
    s = Search(_family(spark), "_id").query(RL.HasParent("question", Q.Match("text", "What")))
    assert sorted(r._id for r in s.hits().collect()) == ["a~1", "a~2"]


def test_terms_by_family_parent_counts_itself(spark):
    a = Search(_family(spark), "_id").aggs(fam=A.TermsAgg(script=RL.family_key("_id"))).aggregations()["fam"]
    assert [(r.fam, r.doc_count) for r in a.collect()] == [("q~2", 4), ("q~1", 3)]


def test_filter_by_relation_name(spark):
    s = Search(_family(spark), "_id").filter(Q.Term("join.name", "answer"))
    assert s.count().first()[0] == 5


def test_has_child_score_modes(spark):
    f = _family(spark)
    from docsift.operators.scoring import FieldValueFactor, FunctionScore
    inner = FunctionScore(Q.MatchAll(), [FieldValueFactor("id")], boost_mode="replace")
    got = {}
    for mode in ("sum", "avg", "max", "min", "multiply", "first", "none"):
        h = Search(f, "_id").query(RL.HasChild("answer", inner, score_mode=mode)).size(None).hits().collect()
        got[mode] = {r._id: r._score for r in h}
    assert got["sum"] == {"q~1": 3.0, "q~2": 12.0}
    assert got["avg"] == {"q~1": 1.5, "q~2": 4.0}
    assert got["max"] == {"q~1": 2.0, "q~2": 5.0}
    assert got["min"] == {"q~1": 1.0, "q~2": 3.0}
    assert got["multiply"]["q~2"] == pytest.approx(60.0)
    assert got["first"] == {"q~1": 1.0, "q~2": 3.0}
    assert got["none"] == {"q~1": 0.0, "q~2": 0.0}


# ------------------------------------------------------------------ attribute facets (phones)

# (model, manufacturer, processor, ram, connectivity, display, battery, slot)
PHONES = [
    ("Galaxy Note 10", 0, 2, 8, [0, 2], 6.3, 3500.0, False),
    ("Galaxy Note 20", 0, 2, 8, [0, 1, 2], 6.7, 4300.0, False),
    ("Galaxy S22", 0, 0, 12, [0, 1, 2], 6.1, 3700.0, False),
    ("Edge 20 Pro", 1, 0, 12, [0, 1, 2], 6.7, 4500.0, True),
    ("Pixel 6 Pro", 2, 4, 12, [0, 1, 2], 6.7, 5003.0, False),
    ("Redmi Note 11", 3, 0, 6, [0, 2, 3], 6.43, 5000.0, True),
    ("12X", 3, 0, 8, [0, 1, 2, 3], 6.28, 4500.0, True),
    ("Redmi Note 12 Pro", 3, 1, 8, [0, 1, 2, 3], 6.67, 5000.0, False),
]


def _phones(spark):
    rows = []
    for i, (model, man, proc, ram, conn, disp, batt, slot) in enumerate(PHONES):
        sel = [(1, man), (2, proc), (3, ram)] + [(4, c) for c in conn]
        rows.append((str(i), model, sel, [(5, disp), (6, batt)], [(7, slot)]))
    return spark.createDataFrame(rows, "_id string, model string, attrs array<struct<attr_id int, value int>>, "
                                       "ranges array<struct<attr_id int, value float>>, flags array<struct<attr_id int, value boolean>>")


def _phone_filters():
    return FC.QueryFilters([FC.AttrFacetFilter("selectAttrs", "attrs", param="attr"),
                            FC.AttrRangeFacetFilter("rangeAttrs", "ranges", param="attr"),
                            FC.AttrBoolFacetFilter("boolAttrs", "flags", param="attr")])


def _facet(res, name):
    return res.facets[name].collect()


def test_attr_facets_without_selection(spark):
    res = _phone_filters().apply(Search(_phones(spark), "_id"), {})
    sel = _facet(res, "selectAttrs")
    by = lambda a: [r.doc_count for r in sel if r.attr_id == a]
    assert by(1) == [3, 3, 1, 1]
    assert by(2) == [4, 2, 1, 1]
    assert [(r.value, r.doc_count) for r in sel if r.attr_id == 3] == [(8, 4), (12, 3), (6, 1)]
    rng = {r.attr_id: r for r in _facet(res, "rangeAttrs")}
    assert rng[5].doc_count == 8 and rng[5].min == pytest.approx(6.1) and rng[5].max == pytest.approx(6.7)
    assert rng[6].doc_count == 8 and rng[6].min == 3500.0 and rng[6].max == 5003.0
    assert [(r.value, r.doc_count) for r in _facet(res, "boolAttrs")] == [(False, 5), (True, 3)]


def test_attr_facets_select_manufacturer(spark):
    res = _phone_filters().apply(Search(_phones(spark), "_id"), {("attr", "1", "any"): ["0"]})
    assert res.total.first().total == 3
    sel = _facet(res, "selectAttrs")
    assert [r.doc_count for r in sel if r.attr_id == 1] == [3, 3, 1, 1]  # own selection not applied to itself
    assert [r.selected for r in sel if r.attr_id == 1 and r.value == 0] == [True]
    assert [(r.value, r.doc_count) for r in sel if r.attr_id == 2] == [(2, 2), (0, 1)]
    assert [(r.value, r.doc_count) for r in sel if r.attr_id == 3] == [(8, 2), (12, 1)]


@pytest.mark.parametrize("params,expected", [
    ({("attr", "1", "any"): ["1", "0"]}, 4),
    ({("attr", "7"): ["true"]}, 3),
    ({("attr", "5", "gte"): ["6.7"]}, 3),
    ({("attr", "1", "any"): ["1", "0"], ("attr", "7"): ["false"], ("attr", "5", "gte"): ["6.3"]}, 2),
])
def test_attr_simple_filters(spark, params, expected):
    assert _phone_filters().apply(Search(_phones(spark), "_id"), params).total.first().total == expected


def test_text_match_any_token(spark):
    s = Search(_phones(spark), "_id").query(Q.Match("model", "Galaxy Note 10"))
    assert s.count().first()[0] == 5


# ------------------------------------------------------------------ float edge cases

F32 = np.finfo(np.float32)
MIN_F = float(np.nextafter(np.float32(0), np.float32(1)))
VALUES = [-math.inf, -float(F32.max), -1.1, -MIN_F, -0.0, 0.0, MIN_F, 1.1, float(F32.max), math.inf, math.nan]


def _floats(spark):
    rows = []
    for a in (1, 2, 2147483647, -1, -2147483648):
        for v in VALUES:
            rows.append((str(len(rows)), [(a, v)]))
    return spark.createDataFrame(rows, "_id string, ranges array<struct<attr_id int, value float>>")


def _f(x: float) -> str:
    return repr(float(np.float32(x))) if math.isfinite(x) else ("Infinity" if x > 0 else "-Infinity")


RANGE_CASES = [
    (("gte", -math.inf), 10), (("gte", -float(F32.max)), 9), (("gte", -3.4028233e38), 8), (("gte", -2.0), 8),
    (("gte", -0.0), 6), (("gte", 0.0), 6), (("gte", MIN_F), 4), (("gte", 2.8e-45), 3), (("gte", float(F32.max)), 2),
    (("gte", math.inf), 1),
    (("lte", math.inf), 10), (("lte", float(F32.max)), 9), (("lte", 1.1), 8), (("lte", 1.0999999), 7), (("lte", 0.0), 6),
    (("lte", -0.0), 6), (("lte", -MIN_F), 4), (("lte", -1.1), 3), (("lte", -float(F32.max)), 2), (("lte", -math.inf), 1),
    ((("gte", 0.0), ("lte", -1.0)), 0), ((("lte", 0.0), ("gte", 0.0)), 2), ((("gte", 0.0), ("lte", 1.1)), 4),
    ((("gte", -1.1), ("lte", -0.0)), 4), ((("gte", MIN_F), ("lte", float(F32.max))), 3),
    ((("gte", -float(F32.max)), ("lte", -MIN_F)), 3), ((("gte", -float(F32.max)), ("lte", float(F32.max))), 8),
    ((("gte", -1.1), ("lte", 1.1)), 6),
]


def test_float_range_edge_cases(spark):
    df = _floats(spark).cache()
    assert df.count() == 55
    qf = FC.QueryFilters([FC.AttrRangeSimpleFilter("rangeAttrs", "ranges", param="attr")])
    for spec, expected in RANGE_CASES:
        bounds = spec if isinstance(spec[0], tuple) else (spec,)
        params = {("attr", "2", op): [_f(v)] for op, v in bounds}
        got = qf.apply(Search(df, "_id"), params).total.first().total
        assert got == expected, (spec, got, expected)


# ------------------------------------------------------------------ vectors and pages


def test_knn_hotels(spark):
    df = spark.createDataFrame([(str(i + 1), v) for i, v in enumerate(
        [[5.2, 4.4], [5.2, 3.9], [4.9, 3.4], [4.2, 4.6], [3.3, 4.5]])], "_id string, location array<float>")
    h = Search(df, "_id").knn(Knn("location", (5.0, 4.0), k=3)).hits().collect()
    assert [r._id for r in h] == ["2", "1", "3"]


@pytest.mark.parametrize("params,expected", [
    ({}, (1, 10, 0, 10)),
    ({"page": ["1001"], ("page", "size"): ["10"]}, (1001, 10, 10000, 0)),
    ({"page": ["10000"], ("page", "size"): ["1"]}, (10000, 10, 10000, 0)),
    ({"page": ["x", "3"], ("page", "size"): ["25"]}, (3, 25, 50, 25)),
])
def test_page_filter(spark, params, expected):
    pf = FC.PageFilter("page", available_sizes=(10, 25), default_size=10, max_hits=10000)
    st = pf.prepare(FC.normalize_params(params), None).state
    assert (st["page"], st["per_page"], st["from"], st["size"]) == expected


def test_total_pages_of_empty_result_is_one(spark):
    df = spark.createDataFrame([("1", 1)], "_id string, x int").filter("x > 5")
    res = FC.QueryFilters([FC.PageFilter("page")]).apply(Search(df, "_id"), {})
    assert res.page.first().total_pages == 1


# ------------------------------------------------------------------ dates

DATES = [
    (0, dt.datetime(1970, 1, 1)), (1618249875000, dt.datetime(2021, 4, 12, 17, 51, 15)), (2015, dt.datetime(2015, 1, 1)),
    ("2015", dt.datetime(2015, 1, 1)), ("2015-01", dt.datetime(2015, 1, 1)), ("2015-01-01", dt.datetime(2015, 1, 1)),
    ("2015-01-01T", dt.datetime(2015, 1, 1)), ("2015-01-01T12", dt.datetime(2015, 1, 1, 12)),
    ("2015-01-01T12:10", dt.datetime(2015, 1, 1, 12, 10)), ("2015-01-01T12:10:30", dt.datetime(2015, 1, 1, 12, 10, 30)),
    ("2015-01-01T12:10:30Z", dt.datetime(2015, 1, 1, 12, 10, 30)), ("2015-01-01T12:10:30-02", dt.datetime(2015, 1, 1, 14, 10, 30)),
    ("2015-01-01T12:10:30+0230", dt.datetime(2015, 1, 1, 9, 40, 30)), ("2015-01-01T12:10:30+02:00", dt.datetime(2015, 1, 1, 10, 10, 30)),
    ("2015-01-01T12:10:30.1", dt.datetime(2015, 1, 1, 12, 10, 30, 100000)),
    ("2015-01-01T12:10:30.001234Z", dt.datetime(2015, 1, 1, 12, 10, 30, 1000)),
    ("2015-01-01T12:10:30.001234+00:01", dt.datetime(2015, 1, 1, 12, 9, 30, 1000)),
    ("2015-01-01T12:10:30.001234567Z", dt.datetime(2015, 1, 1, 12, 10, 30, 1000)),
    ("2015-13", None), ("2015-01-01T12:10:301", None), ("2015-01-01T12:10:30.0012345678Z", None),
]


def test_flexible_dates(spark):
    from docsift.functions.dates import parse_date
    df = spark.createDataFrame([(str(v),) for v, _ in DATES], "s string")
    got = [r.t for r in df.select(parse_date(F.col("s")).cast("timestamp_ntz").alias("t")).collect()]
    assert got == [e for _, e in DATES]


# ------------------------------------------------------------------ more search query cases


def _order_with_comment(spark):
    return _orders(spark).withColumn("comment", F.when(F.col("id") == "101", F.lit("Call me later")))


def test_filter_only_search_scores_zero(spark):
    s = Search(_orders(spark), "id").filter(Q.Term("status", 0))
    t = s.total().first()
    assert (t.total, t.max_score) == (3, 0.0)
    t = Search(_orders(spark), "id").filter(Q.Ids(["105", "102"])).total().first()
    assert (t.total, t.max_score) == (2, 0.0)


def test_range_date_filtering(spark):
    s = Search(_orders(spark), "id").filter(Q.Range("dateCreated", lt="2020-01-01"))
    h = s.hits().collect()
    assert [r.id for r in h] == ["101"] and h[0].user.name == "Karlson" and len(h[0]["items"]) == 1


def test_source_exclude_and_disable(spark):
    s = Search(_order_with_comment(spark), "id").filter(Q.Ids(["101"]))
    h = s.source(excludes=["comment"]).hits()
    assert "comment" not in h.columns and h.first().status == 0
    h = s.source(enabled=False).hits()
    assert h.columns == ["id", "_score"]


def test_docvalue_fields_with_format(spark):
    h = Search(_orders(spark), "id").filter(Q.Ids(["101"])).fields("status", ("dateCreated", "yyyy")).hits().first()
    assert h.fields_status == ["0"] and h.fields_dateCreated == ["2019"]


def test_stored_fields(spark):
    s = Search(_order_with_comment(spark), "id").filter(Q.Ids(["101"]))
    h = s.stored_fields("comment").hits().first()
    assert (h.id, h.comment) == ("101", "Call me later")
    h = s._with(stored_fields_=()).hits()
    assert "id" not in h.columns


def test_multi_search_and_count(spark):
    from docsift.plans.search import multi_search
    o = _orders(spark)
    ms = multi_search([Search(o, "id").filter(Q.Term("status", 0)), Search(o, "id").filter(Q.Term("status", 1))]).collect()
    assert sorted((r.query_id, r.id) for r in ms) == [(0, "101"), (0, "102"), (0, "105"), (1, "103")]
    assert Search(o, "id").count().first()["count"] == 4


def test_knn_query_hotels(spark):
    from docsift.operators.knn import KnnQuery
    df = spark.createDataFrame([(str(i + 1), v) for i, v in enumerate(
        [[5.2, 4.4], [5.2, 3.9], [4.9, 3.4], [4.2, 4.6], [3.3, 4.5]])], "_id string, location array<float>")
    s = Search(df, "_id").query(KnnQuery("location", (5.0, 4.0), k=3))
    assert s.total().first().total == 3
    assert [r._id for r in s.hits().collect()] == ["2", "1", "3"]


def test_dynamic_template_typing_and_subfield(spark):
    from docsift.sources.schema import Template, apply_templates
    raw = spark.createDataFrame([("1", "10"), ("2", "2")], "_id string, company_id string")
    df = apply_templates(raw, [Template("bigint", match="*_id", unmatch="_id", subfields=(("id", "string"),))])
    s = Search(df, "_id")
    assert s.filter(Q.Term("company_id__id", "10")).count().first()[0] == 1
    assert [r._id for r in s.sort("company_id").hits().collect()] == ["2", "1"]


def test_explanation(spark):
    phones = _phones(spark)
    assert "_explanation" not in Search(phones, "_id").hits().columns
    h = Search(phones, "_id").explain().size(None).hits().collect()
    assert len(h) == 8 and all(len(r._explanation) == 1 and r._explanation[0].value == 1.0 for r in h)
    h = Search(phones, "_id").query(Q.Match("model", "Galaxy Note 10")).explain().size(None).hits().collect()
    assert len(h) == 5
    for r in h:
        top, details = r._explanation[0], r._explanation[1:]
        assert top.description == "sum of:" and details
        assert top.value == pytest.approx(sum(d.value for d in details)) and top.value == pytest.approx(r._score)
