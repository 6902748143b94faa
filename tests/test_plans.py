"""Physical plan shapes: no cross joins anywhere, filters pushed into scans,
one shuffle for all counting facets."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

STREAMING = {"t1_stream_date_histogram", "t2_bulk_action_stream"}


@pytest.mark.parametrize("name", sorted(set(E.queries()) - STREAMING))
def test_no_cross_join(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    text = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_flagship_filters_reach_the_scan(spark):
    df = E.queries()["flagship_lineitem_terms"](spark, SF_SMALL)
    text = df._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_quantity), GreaterThanOrEqual(l_shipdate" in text
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_returnflag:string,l_shipdate:timestamp_ntz>" in text


def test_all_counting_facets_share_one_aggregate(spark):
    from docsift.operators import facets as FC
    from docsift.plans.search import Search
    from docsift.sources import tables as TB
    part = TB.read(spark, SF_SMALL, "part")
    qf = FC.QueryFilters([FC.FacetFilter("brand", "p_brand"), FC.FacetFilter("type", "p_type"), FC.FacetFilter("size", "p_size")])
    res = qf.apply(Search(part, "p_partkey"), {"brand": ["Brand#1"], "type": ["SMALL"]})
    for name in ("brand", "type", "size"):
        res.facets[name].collect()
    # the three facet frames read the same cached (facets x values) aggregate
    assert all("InMemoryRelation" in res.facets[n]._jdf.queryExecution().optimizedPlan().toString() for n in ("brand", "type", "size"))
    res.release()


def test_children_read_only_the_rows_of_kept_terms(spark):
    """The child histogram's input lies below the semi-join to the terms that were kept."""
    from docsift.operators import aggs as A
    from docsift.plans.search import Search
    from docsift.sources import tables as TB

    s = Search(TB.read(spark, SF_SMALL, "lineitem"), "l_orderkey").aggs(
        part=A.TermsAgg("l_partkey", size=5, aggs={"qty": A.Histogram("l_quantity", interval=5)}))
    plan = s.aggregations()["part>qty"]._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    semi = next(i for i, x in enumerate(lines) if "LeftSemi" in x)
    above = "\n".join(lines[:semi])
    assert "Aggregate" in above and "sequence" in above  # grouping and gap filling happen above the cut


def test_histogram_joins_on_whole_numbers(spark):
    from docsift.operators import aggs as A
    from docsift.plans.search import Search

    rows = [(i, x) for i, x in enumerate([0.05, 0.31, 0.61, 0.69, 1.05])]
    s = Search(spark.createDataFrame(rows, "id long, price double"), "id").aggs(price=A.Histogram("price", interval=0.1, aggs={"a": A.Avg("price")}))
    got = {round(r.price, 6): (r.doc_count, r.a) for r in s.aggregations()["price"].collect()}
    assert len(got) == 11 and got[0.6] == (2, pytest.approx(0.65)) and got[0.5] == (0, None) and got[1.0][0] == 1


def test_ranges_leave_out_nan_and_array_value_scripts_keep_rows(spark):
    from docsift.operators import aggs as A
    from docsift.plans.search import Search

    d = spark.createDataFrame([(1, float("nan"), [1.0, 2.0]), (2, 1.0, [3.0])], "id long, x double, v array<double>")
    s = Search(d, "id").aggs(r=A.RangeAgg("x", ranges=((0, None, "all"),)), t=A.Sum("v", value_script="_value * 10"),
                             t_x=A.Max("x"))
    found = s.aggregations()
    assert [r.doc_count for r in found["r"].collect()] == [1]
    assert found["t"].columns == ["t"] and found["t"].first().t == 60.0
