"""Registered queries: one per inventory id, each with its DuckDB oracle SQL.

Every query reads the given tables (or views Spark derives from them) in full;
limits appear only where they are the feature (top-k, paging, kNN k).
Doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

from typing import Callable

import pandas as pd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.operators import aggs as A
from docsift.operators import query as Q
from docsift.operators.sort import Sort
from docsift.plans.search import Search
from docsift.sources import tables as TB

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def reg(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def rnd(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (summation order differs between engines).

    Scales, rounds half away from zero, scales back -- the same arithmetic as
    SQL ``round(x, d)`` in the oracle, so values on a half agree."""
    out = []
    scale = float(10 ** digits)
    for f in df.schema.fields:
        if f.dataType.typeName() in ("double", "float"):
            c = F.col(f"`{f.name}`").cast("double")
            out.append((F.round(c * F.lit(scale), 0) / F.lit(scale)).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def lineitem(spark, sf):
    """lineitem with a unique string id (see ``tables.line_id``)."""
    return TB.read(spark, sf, "lineitem").withColumn("l_id", TB.line_id())


L_ID = "(l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || l_quantity::BIGINT)"


# ----------------------------------------------------------------------------- minimum slice


@reg("flagship_lineitem_terms", f"""
SELECT l_returnflag AS flag, count(*)::BIGINT AS doc_count, round(avg(l_extendedprice), 6) AS avg_price
FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'
  AND l_quantity >= 5 AND l_returnflag IN ('A', 'N', 'R')
GROUP BY l_returnflag ORDER BY doc_count DESC, flag LIMIT 10""")
def flagship(spark, sf):
    s = (Search(lineitem(spark, sf), "l_id")
         .filter(Q.Range("l_shipdate", gte="1995-01-01", lt="1997-01-01"), Q.Range("l_quantity", gte=5),
                 Q.Terms("l_returnflag", ["A", "N", "R"]))
         .aggs(flag=A.TermsAgg("l_returnflag", aggs={"avg_price": A.Avg("l_extendedprice")})))
    return rnd(s.aggregations()["flag"])


@reg("flagship_top_hits_by_price", f"""
SELECT {L_ID} AS l_id, l_orderkey, l_extendedprice FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1997-01-01'
ORDER BY l_extendedprice DESC, l_id LIMIT 10""")
def flagship_hits(spark, sf):
    s = (Search(lineitem(spark, sf), "l_id").filter(Q.Range("l_shipdate", gte="1995-01-01", lt="1997-01-01"))
         .sort(Sort("l_extendedprice", "desc")).size(10))
    return s.hits().select("l_id", "l_orderkey", "l_extendedprice")


@reg("p1_term", f"""
SELECT {L_ID} AS l_id, l_returnflag, l_linestatus FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'""")
def p1_term(spark, sf):
    s = Search(lineitem(spark, sf), "l_id").filter(Q.Term("l_returnflag", "R"), Q.field("l_linestatus").eq("F"))
    return s.matched().select("l_id", "l_returnflag", "l_linestatus")


@reg("p2_terms", """
SELECT p_partkey, p_brand FROM part WHERE p_brand IN ('Brand#1', 'Brand#7', 'Brand#13') OR p_size IN (1, 2)""")
def p2_terms(spark, sf):
    q = Q.Bool(should=[Q.Terms("p_brand", ["Brand#1", "Brand#7", "Brand#13"]), Q.field("p_size").one_of([1, 2])])
    return Search(TB.read(spark, sf, "part"), "p_partkey").query(q).matched().select("p_partkey", "p_brand")


@reg("p3_ids", """
SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def p3_ids(spark, sf):
    o = TB.read(spark, sf, "orders")
    ids = o.filter(F.col("o_orderstatus") == "F").select("o_custkey")
    return Search(o, "o_orderkey").filter(Q.Ids(ids)).matched().select("o_orderkey")


@reg("p4_exists_missing", """
SELECT d.doc_id, l.quality IS NOT NULL AS has_quality FROM documents d LEFT JOIN labels l USING (doc_id)
WHERE l.quality IS NULL OR l.toxic IS NOT NULL""")
def p4_exists(spark, sf):
    d = TB.docs_labelled(spark, sf)
    q = Q.Bool(should=[Q.field("quality").missing(), Q.Exists("toxic")])
    return Search(d, "doc_id").query(q).matched().select("doc_id", F.col("quality").isNotNull().alias("has_quality"))


@reg("p5_ne_keeps_missing", """
SELECT d.doc_id FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.toxic IS DISTINCT FROM 1""")
def p5_ne(spark, sf):
    d = TB.docs_labelled(spark, sf)
    return Search(d, "doc_id").filter(Q.field("toxic").ne(1)).matched().select("doc_id")


@reg("p6_range", f"""
SELECT {L_ID} AS l_id FROM lineitem
WHERE l_shipdate > TIMESTAMP '1996-03-01' AND l_shipdate <= TIMESTAMP '1996-06-30T12:00:00'
  AND l_quantity >= 10 AND l_quantity < 20 AND l_discount > 0.02""")
def p6_range(spark, sf):
    s = Search(lineitem(spark, sf), "l_id").filter(
        Q.Range("l_shipdate", gt="1996-03-01", lte="1996-06-30T12:00:00"),
        Q.Range("l_quantity", gte=10, lt=20), Q.field("l_discount").gt(0.02))
    return s.matched().select("l_id")


@reg("p7_range_relation", """
WITH r AS (SELECT l_orderkey, min(l_shipdate) AS lo, max(l_shipdate) AS hi FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey,
  (lo <= TIMESTAMP '1996-12-31' AND hi >= TIMESTAMP '1996-01-01') AS intersects,
  (lo >= TIMESTAMP '1996-01-01' AND hi <= TIMESTAMP '1996-12-31') AS within,
  (lo <= TIMESTAMP '1996-06-01' AND hi >= TIMESTAMP '1996-06-30') AS contains
FROM r""")
def p7_relation(spark, sf):
    r = TB.ship_ranges(spark, sf)
    ctx = Q.Ctx(r, "l_orderkey")
    return r.select("l_orderkey",
                    Q.Range("ship", gte="1996-01-01", lte="1996-12-31").predicate(ctx).alias("intersects"),
                    Q.Range("ship", gte="1996-01-01", lte="1996-12-31", relation="within").predicate(ctx).alias("within"),
                    Q.Range("ship", gte="1996-06-01", lte="1996-06-30", relation="contains").predicate(ctx).alias("contains"))


@reg("p8_bool", """
SELECT p_partkey FROM part
WHERE p_size >= 10 AND NOT (p_type = 'STANDARD') AND p_retailprice < 1500
  AND (p_brand IN ('Brand#1', 'Brand#2') OR p_name LIKE '%red%' OR p_size > 40)""")
def p8_bool(spark, sf):
    q = Q.Bool(must=[Q.Range("p_size", gte=10)], filter=[Q.Range("p_retailprice", lt=1500)],
               must_not=[Q.Term("p_type", "STANDARD")],
               should=[Q.Terms("p_brand", ["Brand#1", "Brand#2"]), Q.Match("p_name", "red"), Q.Range("p_size", gt=40)],
               minimum_should_match=1)
    return Search(TB.read(spark, sf, "part"), "p_partkey").query(q).matched().select("p_partkey")


@reg("p9_minimum_should_match", """
SELECT p_partkey FROM part
WHERE ((p_size > 25)::INT + (p_retailprice > 1500)::INT + (p_type = 'LARGE')::INT + (p_brand = 'Brand#3')::INT) >= 2""")
def p9_msm(spark, sf):
    q = Q.Bool(should=[Q.Range("p_size", gt=25), Q.Range("p_retailprice", gt=1500), Q.Term("p_type", "LARGE"),
                       Q.Term("p_brand", "Brand#3")], minimum_should_match="-50%")
    return Search(TB.read(spark, sf, "part"), "p_partkey").query(q).matched().select("p_partkey")


@reg("p10_match_all", "SELECT c_custkey, 1.0::DOUBLE AS _score FROM customer")
def p10_match_all(spark, sf):
    return Search(TB.read(spark, sf, "customer"), "c_custkey").query(Q.MatchAll()).matched().select("c_custkey", "_score")


@reg("p16_post_filter", """
SELECT o_orderstatus AS status, count(*)::BIGINT AS doc_count,
  (SELECT count(*) FROM orders WHERE o_totalprice > 100000 AND o_orderpriority = '1-URGENT')::BIGINT AS hits_total
FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderstatus""")
def p16_post(spark, sf):
    s = (Search(TB.read(spark, sf, "orders"), "o_orderkey").filter(Q.Range("o_totalprice", gt=100000))
         .post_filter(Q.Term("o_orderpriority", "1-URGENT")).aggs(status=A.TermsAgg("o_orderstatus", size=None)))
    total = s.total().select("total").scalar()
    return s.aggregations()["status"].withColumn("hits_total", total)


# ----------------------------------------------------------------------------- sorting and paging


@reg("s1_sort_fields", """
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 100""")
def s1_sort(spark, sf):
    s = Search(TB.read(spark, sf, "orders"), "o_orderkey").sort("o_orderpriority", "-o_totalprice").size(100)
    return s.hits().select("o_orderkey", "o_orderpriority", "o_totalprice")


@reg("s7_from_size", """
SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderdate DESC, o_orderkey LIMIT 10 OFFSET 20""")
def s7_page(spark, sf):
    s = Search(TB.read(spark, sf, "orders"), "o_orderkey").filter(Q.Term("o_orderstatus", "O")).sort(Sort("o_orderdate", "desc")).offset(20).size(10)
    return s.hits().select("o_orderkey")


@reg("s8_total_max_score", """
SELECT count(*)::BIGINT AS total, 0.0::DOUBLE AS max_score FROM orders WHERE o_orderstatus = 'F'""")
def s8_total(spark, sf):
    return Search(TB.read(spark, sf, "orders"), "o_orderkey").filter(Q.Term("o_orderstatus", "F")).total()


# ----------------------------------------------------------------------------- metrics


@reg("e1_e2_e4_min_max_sum", """
SELECT min(l_quantity) AS min_qty, max(l_extendedprice) AS max_price, round(sum(l_tax), 6) AS sum_tax
FROM lineitem WHERE l_returnflag = 'N'""")
def e_min_max_sum(spark, sf):
    s = Search(lineitem(spark, sf), "l_id").filter(Q.Term("l_returnflag", "N")).aggs(
        min_qty=A.Min("l_quantity"), max_price=A.Max("l_extendedprice"), sum_tax=A.Sum("l_tax"))
    a = s.aggregations()
    return rnd(a["min_qty"].select("min_qty", a["max_price"].select("max_price").scalar().alias("max_price"),
                                   a["sum_tax"].select("sum_tax").scalar().alias("sum_tax")))


@reg("e3_avg_by_status", """
SELECT l_linestatus AS status, count(*)::BIGINT AS doc_count, round(avg(l_discount), 6) AS avg_disc
FROM lineitem GROUP BY 1""")
def e3_avg(spark, sf):
    s = Search(lineitem(spark, sf), "l_id").aggs(status=A.TermsAgg("l_linestatus", aggs={"avg_disc": A.Avg("l_discount")}))
    return rnd(s.aggregations()["status"])


@reg("e0_value_script_missing", """
SELECT (SELECT round(avg(l_extendedprice * (1 - l_discount)), 6) FROM lineitem) AS net,
       (SELECT round(sum(coalesce(l.quality, 2) * 10.0), 6)::DOUBLE FROM documents d LEFT JOIN labels l USING (doc_id)) AS q10""")
def e0_value(spark, sf):
    a = Search(lineitem(spark, sf), "l_id").aggs(net=A.Avg(script="l_extendedprice * (1 - l_discount)")).aggregations()
    b = Search(TB.docs_labelled(spark, sf), "doc_id").aggs(
        q10=A.Sum("quality", value_script="_value * 10", missing=2)).aggregations()
    return rnd(a["net"].select("net", b["q10"].select("q10").scalar().alias("q10")))


@reg("e5_weighted_avg", """
SELECT l_returnflag AS flag, count(*)::BIGINT AS doc_count,
       round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 6) AS wavg
FROM lineitem GROUP BY 1""")
def e5_wavg(spark, sf):
    s = Search(lineitem(spark, sf), "l_id").aggs(flag=A.TermsAgg("l_returnflag", aggs={
        "wavg": A.WeightedAvg(value=A._Src("l_extendedprice"), weight=A._Src("l_quantity"))}))
    return rnd(s.aggregations()["flag"])


@reg("e6_value_count", """
SELECT count(l.quality)::BIGINT AS n_quality FROM documents d LEFT JOIN labels l USING (doc_id)""")
def e6_count(spark, sf):
    return Search(TB.docs_labelled(spark, sf), "doc_id").aggs(n_quality=A.ValueCount("quality")).aggregations()["n_quality"]


@reg("e7_cardinality", """
SELECT l_returnflag AS flag, count(*)::BIGINT AS doc_count, count(DISTINCT l_partkey)::BIGINT AS parts
FROM lineitem GROUP BY 1""")
def e7_card(spark, sf):
    s = Search(lineitem(spark, sf), "l_id").aggs(flag=A.TermsAgg("l_returnflag", aggs={"parts": A.Cardinality("l_partkey", exact=True)}))
    return s.aggregations()["flag"]


@reg("e8_e9_stats", """
SELECT l_linestatus AS st, count(*)::BIGINT AS doc_count,
  count(l_quantity)::BIGINT AS q_count, min(l_quantity) AS q_min, max(l_quantity) AS q_max,
  round(avg(l_quantity), 6) AS q_avg, round(sum(l_quantity), 6) AS q_sum,
  round(sum(l_quantity * l_quantity), 6) AS q_sum_of_squares, round(var_pop(l_quantity), 6) AS q_variance,
  round(stddev_pop(l_quantity), 6) AS q_std_deviation,
  round(avg(l_quantity) + 2 * stddev_pop(l_quantity), 6) AS q_std_upper,
  round(avg(l_quantity) - 2 * stddev_pop(l_quantity), 6) AS q_std_lower,
  count(l_discount)::BIGINT AS d_count, min(l_discount) AS d_min, max(l_discount) AS d_max,
  round(avg(l_discount), 6) AS d_avg, round(sum(l_discount), 6) AS d_sum
FROM lineitem GROUP BY 1""")
def e8_stats(spark, sf):
    s = Search(lineitem(spark, sf), "l_id").aggs(st=A.TermsAgg("l_linestatus", aggs={
        "q": A.ExtendedStats("l_quantity"), "d": A.Stats("l_discount")}))
    return rnd(s.aggregations()["st"])


@reg("e10_percentiles", """
SELECT l_returnflag AS flag, count(*)::BIGINT AS doc_count,
  quantile_disc(l_extendedprice, 0.01) AS pct_p1, quantile_disc(l_extendedprice, 0.25) AS pct_p25,
  quantile_disc(l_extendedprice, 0.5) AS pct_p50, quantile_disc(l_extendedprice, 0.95) AS pct_p95,
  quantile_disc(l_extendedprice, 0.999) AS pct_p99_9
FROM lineitem GROUP BY 1""")
def e10_pct(spark, sf):
    s = Search(lineitem(spark, sf), "l_id").aggs(flag=A.TermsAgg("l_returnflag", aggs={
        "pct": A.Percentiles("l_extendedprice", percents=(1, 25, 50, 95, 99.9), accuracy=1_000_000)}))
    return rnd(s.aggregations()["flag"])


@reg("e11_median_absolute_deviation", """
WITH m AS (SELECT l_returnflag, quantile_disc(l_extendedprice, 0.5) AS med FROM lineitem GROUP BY 1)
SELECT l_returnflag AS flag, count(*)::BIGINT AS doc_count,
       round(quantile_disc(abs(l_extendedprice - med), 0.5), 6) AS mad
FROM lineitem JOIN m USING (l_returnflag) GROUP BY 1""")
def e11_mad(spark, sf):
    s = Search(lineitem(spark, sf), "l_id").aggs(flag=A.TermsAgg("l_returnflag", aggs={
        "mad": A.MedianAbsoluteDeviation("l_extendedprice", accuracy=1_000_000)}))
    return rnd(s.aggregations()["flag"])


def _sm_map(state, pdf):
    return state + float((pdf["l_quantity"] * pdf["l_extendedprice"]).sum())


@reg("e12_scripted_metric", """
SELECT l_returnflag AS flag, count(*)::BIGINT AS doc_count, round(sum(l_quantity * l_extendedprice), 2) AS revenue
FROM lineitem GROUP BY 1""")
def e12_scripted(spark, sf):
    sm = A.ScriptedMetric(init=lambda: 0.0, map=_sm_map, combine=lambda s: s, reduce=lambda vs: float(sum(vs)),
                          fields=("l_quantity", "l_extendedprice"))
    s = Search(lineitem(spark, sf), "l_id").aggs(flag=A.TermsAgg("l_returnflag", aggs={"revenue": sm}))
    return rnd(s.aggregations()["flag"], 2)


def _histogram_map(state, pdf):
    for k, n in pdf["l_quantity"].floordiv(10).value_counts().items():
        state[int(k)] = state.get(int(k), 0) + int(n)
    return state


def _histogram_merge(states):
    out: dict = {}
    for s in states:
        for k, n in s.items():
            out[k] = out.get(k, 0) + n
    return out


def _histogram_metric() -> A.ScriptedMetric:
    """The most frequent decade of quantities, smaller first: its states are merged in levels."""
    return A.ScriptedMetric(init=dict, map=_histogram_map, merge=_histogram_merge, fan_in=4, fields=("l_quantity",), result_type="bigint",
                            reduce=lambda states: min(_histogram_merge(states).items(), key=lambda x: (-x[1], x[0]))[0])


@reg("e12_scripted_metric_merged", """
WITH g AS (SELECT l_returnflag AS flag, l_linestatus AS status, floor(l_quantity / 10)::BIGINT AS k, count(*) AS n FROM lineitem GROUP BY 1, 2, 3),
a AS (SELECT floor(l_quantity / 10)::BIGINT AS k, count(*) AS n FROM lineitem GROUP BY 1)
SELECT flag, status, sum(n)::BIGINT AS doc_count, arg_min(k, {'n': -n, 'k': k}) AS mode, (SELECT arg_min(k, {'n': -n, 'k': k}) FROM a) AS mode_of_all
FROM g GROUP BY 1, 2""")
def e12_merged(spark, sf):
    li = lineitem(spark, sf).repartition(24)
    m = _histogram_metric()
    found = Search(li, "l_id").aggs(all=m, flag=A.TermsAgg("l_returnflag", aggs={"status": A.TermsAgg("l_linestatus", aggs={"mode": m})})).aggregations()
    return found["flag>status"].withColumn("mode_of_all", found["all"].scalar())


@reg("e13_top_hits", """
SELECT o_orderstatus AS status, rn AS _rank, o_orderkey, o_totalprice, n AS _total FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS rn,
         count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
WHERE rn <= 3""")
def e13_top_hits(spark, sf):
    s = Search(TB.read(spark, sf, "orders"), "o_orderkey").aggs(status=A.TermsAgg("o_orderstatus", aggs={
        "top": A.TopHits(size=3, sort=("-o_totalprice",), source=("o_orderkey", "o_totalprice"))}))
    return s.aggregations()["status>top"].withColumn("_rank", F.col("_rank").cast("bigint"))


@reg("e13_top_hits_options", """
WITH t AS (SELECT *, o_totalprice * 0.001 AS sc FROM orders)
SELECT o_orderstatus AS status, row_number() OVER (PARTITION BY o_orderstatus ORDER BY sc DESC, o_orderkey) AS _rank, o_orderkey, o_orderpriority,
       round(sc, 6) AS _score, [strftime(o_orderdate, '%Y/%m/%d')] AS fields_o_orderdate, [o_custkey] AS docvalue_o_custkey,
       [epoch_ms(o_orderdate)::VARCHAR] AS docvalue_o_orderdate, round(max(sc) OVER (PARTITION BY o_orderstatus), 6) AS _max_score,
       count(*) OVER (PARTITION BY o_orderstatus) AS _total
FROM t QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY sc DESC, o_orderkey) <= 4""")
def e13_options(spark, sf):
    q = SC.FunctionScore(Q.MatchAll(), [SC.FieldValueFactor("o_totalprice", factor=0.001)], boost_mode="replace")
    s = Search(TB.read(spark, sf, "orders"), "o_orderkey").query(q).aggs(status=A.TermsAgg("o_orderstatus", aggs={"top": A.TopHits(
        size=4, sort=("-_score",), source_includes=("o_order*",), source_excludes=("o_orderstatus", "*date"), fields=(("o_orderdate", "yyyy/MM/dd"),),
        docvalue_fields=("o_custkey", ("o_orderdate", "epoch_millis")), max_score=True)}))
    return rnd(s.aggregations()["status>top"].withColumn("_rank", F.col("_rank").cast("bigint")))


# ----------------------------------------------------------------------------- buckets


@reg("e14_terms_size_other", """
WITH g AS (SELECT p_brand AS brand, count(*)::BIGINT AS doc_count FROM part GROUP BY 1),
t AS (SELECT * FROM g ORDER BY doc_count DESC, brand LIMIT 5)
SELECT *, ((SELECT sum(doc_count) FROM g) - (SELECT sum(doc_count) FROM t))::BIGINT AS sum_other_doc_count FROM t""")
def e14_terms(spark, sf):
    s = Search(TB.read(spark, sf, "part"), "p_partkey").aggs(brand=A.TermsAgg("p_brand", size=5, show_other=True))
    return s.aggregations()["brand"]


@reg("e15_terms_order_by_metric", """
SELECT l_suppkey AS supp, count(*)::BIGINT AS doc_count, round(avg(l_extendedprice), 6) AS avg_price
FROM lineitem GROUP BY 1 HAVING count(*) >= 5 ORDER BY avg(l_extendedprice) DESC, supp LIMIT 10""")
def e15_order(spark, sf):
    s = Search(lineitem(spark, sf), "l_id").aggs(supp=A.TermsAgg("l_suppkey", size=10, min_doc_count=5, order=(("avg_price", "desc"),),
                                                                 aggs={"avg_price": A.Avg("l_extendedprice")}))
    return rnd(s.aggregations()["supp"])


@reg("e16_terms_include_exclude", """
SELECT p_brand AS brand, count(*)::BIGINT AS doc_count FROM part
WHERE regexp_full_match(p_brand, 'Brand#1.*') AND p_brand NOT IN ('Brand#10', 'Brand#11')
GROUP BY 1 ORDER BY doc_count DESC, brand LIMIT 100""")
def e16_incl(spark, sf):
    s = Search(TB.read(spark, sf, "part"), "p_partkey").aggs(brand=A.TermsAgg("p_brand", size=100, include="Brand#1.*",
                                                                               exclude=["Brand#10", "Brand#11"]))
    return s.aggregations()["brand"]


@reg("e16_terms_partition", """
SELECT p_brand AS brand, count(*)::BIGINT AS doc_count FROM part WHERE ('0x' || substr(md5(p_brand), 1, 8))::BIGINT % 4 = 1 GROUP BY 1""")
def e16_part(spark, sf):
    s = Search(TB.read(spark, sf, "part"), "p_partkey").aggs(
        brand=A.TermsAgg("p_brand", size=None, include={"partition": 1, "num_partitions": 4}))
    return s.aggregations()["brand"]


@reg("e17_significant_terms", """
WITH b AS (SELECT l_suppkey AS k, l_discount >= 0.09 AS fg FROM lineitem),
t AS (SELECT count(*) FILTER (WHERE fg)::DOUBLE AS fgt, count(*)::DOUBLE AS bgt FROM b),
g AS (SELECT k, count(*) FILTER (WHERE fg)::BIGINT AS doc_count, count(*)::BIGINT AS bg_count FROM b GROUP BY k)
SELECT k AS sig, doc_count, bg_count,
  round(((doc_count / fgt) - (bg_count / bgt)) * ((doc_count / fgt) / (bg_count / bgt)), 6) AS score
FROM g, t WHERE doc_count >= 3 AND doc_count / fgt > bg_count / bgt
ORDER BY ((doc_count / fgt) - (bg_count / bgt)) * ((doc_count / fgt) / (bg_count / bgt)) DESC, sig LIMIT 10""")
def e17_sig(spark, sf):
    s = Search(lineitem(spark, sf), "l_id").query(Q.Range("l_discount", gte=0.09)).aggs(sig=A.SignificantTerms("l_suppkey"))
    return rnd(s.aggregations()["sig"])


@reg("e18_histogram_gaps", """
WITH k AS (SELECT floor((l_extendedprice - 500) / 7)::BIGINT AS i, count(*) AS n FROM lineitem GROUP BY 1),
r AS (SELECT unnest(generate_series(min(i), max(i))) AS i FROM k)
SELECT i * 7.0::DOUBLE + 500 AS price, coalesce(n, 0)::BIGINT AS doc_count FROM r LEFT JOIN k USING (i)""")
def e18_hist(spark, sf):
    s = Search(lineitem(spark, sf), "l_id").aggs(price=A.Histogram("l_extendedprice", interval=7, offset=500, min_doc_count=0))
    return s.aggregations()["price"]


@reg("e18_bucket_named_like_field", """
WITH k AS (SELECT floor(l_discount / 0.1::DOUBLE)::BIGINT AS i, count(*) AS n, round(avg(l_discount), 6) AS mean FROM lineitem GROUP BY 1),
r AS (SELECT unnest(generate_series(min(i), max(i))) AS i FROM k)
SELECT round(i * 0.1::DOUBLE, 6) AS l_discount, coalesce(n, 0)::BIGINT AS doc_count, mean FROM r LEFT JOIN k USING (i)""")
def e18_named(spark, sf):
    s = Search(lineitem(spark, sf), "l_id").aggs(l_discount=A.Histogram("l_discount", interval=0.1, aggs={"mean": A.Avg("l_discount")}))
    return rnd(s.aggregations()["l_discount"])


@reg("e14_e20_buckets_named_like_fields", """
SELECT p_brand, band AS p_size, count(*)::BIGINT AS doc_count, round(avg(p_size), 6) AS mean
FROM (SELECT *, CASE WHEN p_size < 20 THEN 'small' ELSE 'large' END AS band FROM part)
WHERE p_brand IN (SELECT p_brand FROM part GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 4) GROUP BY 1, 2""")
def e14_named(spark, sf):
    s = Search(TB.read(spark, sf, "part"), "p_partkey").aggs(p_brand=A.TermsAgg("p_brand", size=4, aggs={
        "p_size": A.RangeAgg("p_size", ranges=((None, 20, "small"), (20, None, "large")), aggs={"mean": A.Avg("p_size")})}))
    return rnd(s.aggregations()["p_brand>p_size"].select("p_brand", "p_size", "doc_count", "mean"))


@reg("e14_high_cardinality_gap_fill", """
WITH t AS (SELECT l_partkey FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, l_partkey LIMIT 5),
k AS (SELECT l_partkey AS part, floor(l_quantity / 5)::BIGINT AS i, count(*) AS n FROM lineitem JOIN t USING (l_partkey) GROUP BY 1, 2),
r AS (SELECT part, unnest(generate_series(min(i), max(i))) AS i FROM k GROUP BY 1)
SELECT part, i * 5.0::DOUBLE AS qty, coalesce(n, 0)::BIGINT AS doc_count FROM r LEFT JOIN k USING (part, i)""")
def e14_gaps(spark, sf):
    s = Search(lineitem(spark, sf), "l_id").aggs(part=A.TermsAgg("l_partkey", size=5, aggs={"qty": A.Histogram("l_quantity", interval=5)}))
    return s.aggregations()["part>qty"]


@reg("e0_array_value_script", """
SELECT o_orderstatus AS status, count(*)::BIGINT AS doc_count, round(sum(o_totalprice), 6) AS total, round(sum(q), 6) AS doubled
FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_quantity * 2) AS q FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1""")
def e0_array(spark, sf):
    o = TB.orders_nested(spark, sf, ("quantity",)).withColumn("quantities", F.col("items.quantity"))
    s = Search(o, "o_orderkey").aggs(status=A.TermsAgg("o_orderstatus", aggs={
        "total": A.Sum("o_totalprice"), "doubled": A.Sum("quantities", value_script="_value * 2")}))
    return rnd(s.aggregations()["status"])


@reg("e17_sub_aggs", """
WITH b AS (SELECT *, l_discount >= 0.09 AS fg FROM lineitem WHERE l_suppkey <> 5),
t AS (SELECT count(*) FILTER (WHERE l_discount >= 0.09)::DOUBLE AS fgt, count(*)::DOUBLE AS bgt FROM lineitem),
g AS (SELECT l_suppkey AS k, count(*) FILTER (WHERE fg)::BIGINT AS doc_count, count(*)::BIGINT AS bg_count,
             round(sum(l_quantity) FILTER (WHERE fg), 6) AS qty FROM b GROUP BY k)
SELECT k AS sig, doc_count, bg_count,
  round(((doc_count / fgt) - (bg_count / bgt)) * ((doc_count / fgt) / (bg_count / bgt)), 6) AS score, qty
FROM g, t WHERE doc_count >= 3 AND doc_count / fgt > bg_count / bgt ORDER BY doc_count DESC, sig LIMIT 6""")
def e17_sub(spark, sf):
    s = Search(lineitem(spark, sf), "l_id").query(Q.Range("l_discount", gte=0.09)).aggs(sig=A.SignificantTerms(
        "l_suppkey", size=6, exclude=[5], order=("_count", "desc"), aggs={"qty": A.Sum("l_quantity")}))
    return rnd(s.aggregations()["sig"])


@reg("e19_date_histogram_calendar", """
SELECT epoch_ms(date_trunc('week', ts)) AS wk, count(*)::BIGINT AS doc_count, round(sum(value), 6) AS total,
       strftime(date_trunc('week', ts), '%Y-%m-%dT%H:%M:%S.000Z') AS wk_as_string
FROM events GROUP BY 1, 4""")
def e19_cal(spark, sf):
    s = Search(TB.read(spark, sf, "events"), "event_id").aggs(wk=A.DateHistogram("ts", calendar_interval="week", aggs={"total": A.Sum("value")}))
    return rnd(s.aggregations()["wk"])


@reg("e19_date_histogram_fixed_nested", """
SELECT event_type AS et, (epoch_ms(ts) // 21600000) * 21600000 AS h6, count(*)::BIGINT AS doc_count,
       strftime(make_timestamp(((epoch_ms(ts) // 21600000) * 21600000) * 1000), '%Y-%m-%dT%H:%M:%S.000Z') AS h6_as_string
FROM events GROUP BY 1, 2""")
def e19_fixed(spark, sf):
    s = Search(TB.read(spark, sf, "events"), "event_id").aggs(et=A.TermsAgg("event_type", size=None, aggs={
        "h6": A.DateHistogram("ts", fixed_interval="6h")}))
    return s.aggregations()["et>h6"]


@reg("e19_year_histogram_orders", """
SELECT epoch_ms(date_trunc('year', o_orderdate)) AS yr, count(*)::BIGINT AS doc_count,
       strftime(date_trunc('year', o_orderdate), '%Y-%m-%dT%H:%M:%S.000Z') AS yr_as_string
FROM orders GROUP BY 1, 3""")
def e19_year(spark, sf):
    s = Search(TB.read(spark, sf, "orders"), "o_orderkey").aggs(yr=A.DateHistogram("o_orderdate", calendar_interval="year", min_doc_count=0))
    return s.aggregations()["yr"]


_RANGES_SQL = """
SELECT r.k AS price, r.f::DOUBLE AS price_from, r.t::DOUBLE AS price_to, count(o.o_orderkey)::BIGINT AS doc_count,
       round(avg(o.o_totalprice), 6) AS avg_price
FROM (VALUES ('*-50000.0', NULL, 50000.0), ('50000.0-150000.0', 50000.0, 150000.0),
             ('mid', 100000.0, 300000.0), ('300000.0-*', 300000.0, NULL), ('huge', 600000.0, 700000.0)) r(k, f, t)
LEFT JOIN orders o ON (r.f IS NULL OR o.o_totalprice >= r.f) AND (r.t IS NULL OR o.o_totalprice < r.t)
GROUP BY 1, 2, 3"""


@reg("e20_range", _RANGES_SQL)
def e20_range(spark, sf):
    s = Search(TB.read(spark, sf, "orders"), "o_orderkey").aggs(price=A.RangeAgg("o_totalprice", ranges=(
        (None, 50000), (50000, 150000), (100000, 300000, "mid"), (300000, None), (600000, 700000, "huge")),
        aggs={"avg_price": A.Avg("o_totalprice")}))
    return rnd(s.aggregations()["price"])


@reg("e20_date_range", """
SELECT r.k AS period, count(o.o_orderkey)::BIGINT AS doc_count
FROM (VALUES ('early', NULL, TIMESTAMP '1997-01-01'), ('late', TIMESTAMP '1999-06-01', NULL),
             ('y98', TIMESTAMP '1998-01-01', TIMESTAMP '1999-01-01')) r(k, f, t)
LEFT JOIN orders o ON (r.f IS NULL OR o.o_orderdate >= r.f) AND (r.t IS NULL OR o.o_orderdate < r.t)
GROUP BY 1""")
def e20_date_range(spark, sf):
    s = Search(TB.read(spark, sf, "orders"), "o_orderkey").aggs(period=A.DateRangeAgg("o_orderdate", ranges=(
        (None, "1997-01-01", "early"), ("1999-06-01", None, "late"), ("1998-01-01", "1999-01-01", "y98"))))
    return s.aggregations()["period"].select("period", "doc_count")


@reg("e21_nested_agg", """
WITH li AS (SELECT l.* FROM lineitem l WHERE l_orderkey IN (SELECT o_orderkey FROM orders)),
k AS (SELECT floor(l_extendedprice / 10000) * 10000 AS price, count(*) AS n FROM li GROUP BY 1),
r AS (SELECT unnest(generate_series(0, ((max(price) - min(price)) / 10000)::BIGINT)) AS i, min(price) AS lo FROM k)
SELECT (lo + i * 10000)::DOUBLE AS price, coalesce(n, 0)::BIGINT AS doc_count,
       (SELECT count(*) FROM li)::BIGINT AS lines_doc_count
FROM r LEFT JOIN k ON k.price = lo + i * 10000""")
def e21_nested(spark, sf):
    s = Search(TB.orders_nested(spark, sf, ("price",)), "o_orderkey").aggs(lines=A.NestedAgg(path="items", aggs={
        "price": A.Histogram("items.price", interval=10000)}))
    a = s.aggregations()
    return a["lines>price"].withColumn("lines_doc_count", a["lines"].select("doc_count").scalar())


@reg("e22_filter_bucket", """
SELECT count(*)::BIGINT AS doc_count, round(avg(l_quantity), 6) AS avg_qty FROM lineitem WHERE l_shipmode_dummy IS NULL AND l_returnflag = 'R'
""".replace("l_shipmode_dummy IS NULL AND ", ""))
def e22_filter(spark, sf):
    s = Search(lineitem(spark, sf), "l_id").aggs(r=A.FilterAgg(Q.Term("l_returnflag", "R"), aggs={"avg_qty": A.Avg("l_quantity")}))
    return rnd(s.aggregations()["r"])


@reg("e23_filters_other", """
SELECT k AS band, count(o_orderkey)::BIGINT AS doc_count FROM (
  SELECT 'cheap' AS k, o_orderkey FROM orders WHERE o_totalprice < 100000
  UNION ALL SELECT 'urgent', o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT 'other', o_orderkey FROM orders WHERE NOT (o_totalprice < 100000) AND o_orderpriority <> '1-URGENT'
  UNION ALL SELECT 'empty', NULL FROM orders WHERE false
  UNION ALL SELECT k, NULL FROM (VALUES ('cheap'), ('urgent'), ('other'), ('empty')) v(k)) x
GROUP BY 1""")
def e23_filters(spark, sf):
    s = Search(TB.read(spark, sf, "orders"), "o_orderkey").aggs(band=A.FiltersAgg(filters={
        "cheap": Q.Range("o_totalprice", lt=100000), "urgent": Q.Term("o_orderpriority", "1-URGENT"),
        "empty": Q.Range("o_totalprice", gt=1e12)}, other_bucket_key="other"))
    return s.aggregations()["band"]


@reg("e24_global", """
SELECT (SELECT count(*) FROM lineitem)::BIGINT AS doc_count,
       (SELECT round(avg(l_extendedprice), 6) FROM lineitem) AS avg_all,
       (SELECT count(*) FROM lineitem WHERE l_returnflag = 'A')::BIGINT AS matched""")
def e24_global(spark, sf):
    s = Search(lineitem(spark, sf), "l_id").query(Q.Term("l_returnflag", "A")).aggs(
        all=A.GlobalAgg(aggs={"avg_all": A.Avg("l_extendedprice")}))
    return rnd(s.aggregations()["all"].withColumn("matched", s.total().select("total").scalar()))


@reg("e14_e19_nested_buckets", """
SELECT o_orderpriority AS prio, epoch_ms(date_trunc('year', o_orderdate)) AS yr, count(*)::BIGINT AS doc_count,
       round(max(o_totalprice), 6) AS top_price,
       strftime(date_trunc('year', o_orderdate), '%Y-%m-%dT%H:%M:%S.000Z') AS yr_as_string
FROM orders WHERE o_orderpriority IN (SELECT o_orderpriority FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3)
GROUP BY 1, 2, 5""")
def e_nested_buckets(spark, sf):
    s = Search(TB.read(spark, sf, "orders"), "o_orderkey").aggs(prio=A.TermsAgg("o_orderpriority", size=3, aggs={
        "yr": A.DateHistogram("o_orderdate", calendar_interval="year", aggs={"top_price": A.Max("o_totalprice")})}))
    return rnd(s.aggregations()["prio>yr"])


# ----------------------------------------------------------------------------- sorting and shaping


@reg("s2_sort_missing", """
SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id)
ORDER BY quality DESC NULLS FIRST, coalesce(toxic, 5), doc_id LIMIT 150""")
def s2_missing(spark, sf):
    s = Search(TB.docs_labelled(spark, sf), "doc_id").sort(Sort("quality", "desc", missing="_first"), Sort("toxic", missing=5)).size(150)
    return s.hits().select("doc_id", "quality")


@reg("s3_array_sort_mode", """
SELECT o_orderkey FROM orders o JOIN (SELECT l_orderkey, median(l_extendedprice) AS m, max(l_quantity) AS mq FROM lineitem GROUP BY 1) l
  ON o.o_orderkey = l.l_orderkey
ORDER BY m DESC, mq, o_orderkey LIMIT 25""")
def s3_mode(spark, sf):
    s = Search(TB.orders_nested(spark, sf, ("price", "quantity")), "o_orderkey").sort(Sort("items.price", "desc", mode="median"),
                                                               Sort("items.quantity", "asc", mode="max")).size(25)
    return s.hits().select("o_orderkey")


@reg("s4_unmapped_numeric_type", """
SELECT o_orderkey FROM orders ORDER BY CAST(o_totalprice AS BIGINT) DESC, o_orderkey LIMIT 20""")
def s4_unmapped(spark, sf):
    s = Search(TB.read(spark, sf, "orders"), "o_orderkey").sort(
        Sort("no_such_field", unmapped_type="double"), Sort("o_totalprice", "desc", numeric_type="long")).size(20)
    return s.hits().select("o_orderkey")


@reg("s5_nested_sort_filter", """
SELECT o_orderkey FROM orders o LEFT JOIN (
  SELECT l_orderkey, sum(l_quantity) AS s FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) l ON o.o_orderkey = l.l_orderkey
ORDER BY s DESC NULLS LAST, o_orderkey LIMIT 30""")
def s5_nested(spark, sf):
    from docsift.operators.sort import NestedSort
    s = Search(TB.orders_nested(spark, sf, ("quantity", "returnflag")), "o_orderkey").sort(
        Sort("items.quantity", "desc", mode="sum", nested=NestedSort("items", filter=Q.Term("items.returnflag", "R")))).size(30)
    return s.hits().select("o_orderkey")


@reg("s6_script_sort", """
SELECT o_orderkey, NULL::DOUBLE AS _score FROM orders ORDER BY o_totalprice / (1 + length(o_orderpriority)) DESC, o_orderkey LIMIT 25""")
def s6_script(spark, sf):
    s = Search(TB.read(spark, sf, "orders"), "o_orderkey").sort(
        Sort(script="o_totalprice / (1 + length(o_orderpriority))", order="desc")).size(25)
    return s.hits().select("o_orderkey", "_score")


@reg("s9_source_filter", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders""")
def s9_source(spark, sf):
    s = Search(TB.read(spark, sf, "orders"), "o_orderkey").size(None).source(
        includes=["o_*"], excludes=["o_orderstatus", "o_orderpriority"])
    return s.hits().drop("_score")


@reg("s10_formatted_fields", """
SELECT o_orderkey, [strftime(o_orderdate, '%Y-%m')] AS fields_o_orderdate, [o_orderpriority] AS fields_o_orderpriority
FROM orders""")
def s10_fields(spark, sf):
    s = (Search(TB.read(spark, sf, "orders"), "o_orderkey").size(None)
         .fields(("o_orderdate", "yyyy-MM"), "o_orderpriority"))
    return s.hits().select("o_orderkey", "fields_o_orderdate", "fields_o_orderpriority")


@reg("s9_s10_nested_paths", """
SELECT o_orderkey, list_sort(list(l_linenumber))::VARCHAR AS lines, list_sort(list(l_quantity::INT))::VARCHAR AS quantities, FALSE AS has_price
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def s9_nested(spark, sf):
    o = TB.orders_nested(spark, sf, ("quantity", "price")).where("items IS NOT NULL")
    s = Search(o, "o_orderkey").size(None).source(includes=["o_orderkey", "items.*"], excludes=["items.price"]).fields("items.line")
    h = s.hits()
    fields = h.schema["items"].dataType.elementType.fieldNames()
    lines = F.array_sort(F.transform("`fields_items.line`", lambda x: x.cast("int")))
    quantities = F.array_sort(F.transform("items.quantity", lambda x: x.cast("int")))
    text = lambda a: F.concat(F.lit("["), F.array_join(a.cast("array<string>"), ", "), F.lit("]"))
    return h.select("o_orderkey", text(lines).alias("lines"), text(quantities).alias("quantities"), F.lit("price" in fields).alias("has_price"))


@reg("s11_stored_fields", """
SELECT o_orderkey, o_totalprice FROM orders""")
def s11_stored(spark, sf):
    s = Search(TB.read(spark, sf, "orders"), "o_orderkey")
    return s.size(None).stored_fields("o_orderkey", "o_totalprice").hits().drop("_score")


@reg("s10_docvalue_fields", """
SELECT o_orderkey, [round(o_totalprice, 6)] AS docvalue_o_totalprice, [o_orderpriority] AS docvalue_o_orderpriority, [strftime(o_orderdate, '%Y-%m')] AS docvalue_o_orderdate
FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 30""")
def s10_docvalue(spark, sf):
    s = Search(TB.read(spark, sf, "orders"), "o_orderkey").filter(Q.Term("o_orderstatus", "F")).sort("-o_totalprice").size(30).source("o_orderkey")
    h = s.docvalue_fields("o_totalprice", "o_orderpriority", ("o_orderdate", "yyyy-MM")).hits().drop("_score")
    return h.withColumn("docvalue_o_totalprice", F.transform("docvalue_o_totalprice", lambda x: F.round(x, 6)))


@reg("s12_multi_search", """
SELECT * FROM (SELECT 0 AS query_id, o_orderkey FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 5)
UNION ALL SELECT * FROM (SELECT 1, o_orderkey FROM orders WHERE o_orderpriority = '5-LOW' ORDER BY o_orderdate, o_orderkey LIMIT 7)""")
def s12_msearch(spark, sf):
    from docsift.plans.search import multi_search
    o = TB.read(spark, sf, "orders")
    a = Search(o, "o_orderkey").filter(Q.Term("o_orderstatus", "F")).sort("-o_totalprice").size(5)
    b = Search(o, "o_orderkey").filter(Q.Term("o_orderpriority", "5-LOW")).sort("o_orderdate").size(7)
    return multi_search([a, b]).select("query_id", "o_orderkey")


@reg("s13_terminate_after", """
WITH t AS (SELECT * FROM orders WHERE o_totalprice > 50000 ORDER BY o_orderkey LIMIT 500)
SELECT o_orderstatus AS status, count(*)::BIGINT AS doc_count FROM t GROUP BY 1""")
def s13_terminate(spark, sf):
    ordered = TB.read(spark, sf, "orders").orderBy("o_orderkey")  # so that the first 500 are the same everywhere
    s = Search(ordered, "o_orderkey").filter(Q.Range("o_totalprice", gt=50000)).terminate_after(500).aggs(
        status=A.TermsAgg("o_orderstatus", size=None))
    return s.aggregations()["status"]


# ----------------------------------------------------------------------------- faceted navigation

from docsift.operators import facets as FC  # noqa: E402

_PART_PARAMS = {
    "brand": [f"Brand#{i}" for i in range(1, 13)] + ["Brand#99"], "type": ["SMALL", "LARGE", "PROMO"], "words": ["red"],
    ("price", "gte"): ["900", "920"], ("price", "lte"): ["990"], "size": ["x"] + [str(i) for i in range(5, 31)],
    "band": ["cheap", "mid", "nope"], "sort": ["-price"], "page": ["2"], ("page", "size"): ["10", "7"],
}


def _part_facets(spark, sf, params=None):
    part = TB.read(spark, sf, "part").withColumn("words", F.split("p_name", " "))
    qf = FC.QueryFilters([
        FC.FacetFilter("brand", "p_brand"),
        FC.FacetFilter("type", "p_type"),
        FC.FacetFilter("words", "words", mode=FC.INTERSECT),
        FC.FacetRangeFilter("price", "p_retailprice", aggs={"min": A.Min("p_retailprice"), "max": A.Max("p_retailprice")}),
        FC.SimpleFilter("size", "p_size"),
        FC.FacetExpressionsFilter("band", {"cheap": Q.Range("p_retailprice", lt=930),
                                           "mid": Q.Range("p_retailprice", gte=930, lt=960),
                                           "dear": Q.Range("p_retailprice", gte=960)}),
        FC.SortFilter("sort", {"price": ["p_retailprice"], "-price": ["-p_retailprice"], "size": ["p_size"]}),
        FC.PageFilter("page", available_sizes=(10, 25), default_size=10, max_hits=10000),
    ])
    return qf.apply(Search(part, "p_partkey"), params if params is not None else _PART_PARAMS)


_PF = """WITH base AS (SELECT *, string_split(p_name, ' ') AS words FROM part),
sel AS (SELECT *,
  p_brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5', 'Brand#6', 'Brand#7', 'Brand#8', 'Brand#9',
              'Brand#10', 'Brand#11', 'Brand#12', 'Brand#99') AS f_brand,
  p_type IN ('SMALL', 'LARGE', 'PROMO') AS f_type,
  list_contains(words, 'red') AS f_words, (p_retailprice >= 920 AND p_retailprice <= 990) AS f_price,
  (p_size BETWEEN 5 AND 30) AS f_size, (p_retailprice < 930 OR (p_retailprice >= 930 AND p_retailprice < 960)) AS f_band
  FROM base)
"""


@reg("f1_f15_f16_facet_hits_page", _PF + """
SELECT p_partkey, p_retailprice FROM sel WHERE f_brand AND f_type AND f_words AND f_price AND f_size AND f_band
ORDER BY p_retailprice DESC, p_partkey LIMIT 10 OFFSET 10""")
def f_hits(spark, sf):
    return _part_facets(spark, sf).hits.select("p_partkey", "p_retailprice")


@reg("f16_page_info", _PF + """
SELECT count(*)::BIGINT AS total, 2 AS page, 10 AS per_page,
  least(((count(*) - 1) // 10)::INT + 1, 1000) AS total_pages, 10 AS "from", 10 AS size
FROM sel WHERE f_brand AND f_type AND f_words AND f_price AND f_size AND f_band""")
def f_page(spark, sf):
    return _part_facets(spark, sf).page


@reg("f3_f4_facet_union", _PF + """
, c AS (SELECT p_brand AS value, count(*) AS n FROM sel WHERE f_type AND f_words AND f_price AND f_size AND f_band GROUP BY 1)
SELECT coalesce(c.value, s.value) AS value, coalesce(n, 0)::BIGINT AS doc_count, s.value IS NOT NULL AS selected
FROM c FULL JOIN (SELECT 'Brand#' || i AS value FROM range(1, 13) t(i) UNION ALL SELECT 'Brand#99') s
  ON c.value = s.value""")
def f_brand(spark, sf):
    return _part_facets(spark, sf).facets["brand"]


@reg("f5_facet_intersect", _PF + """
, c AS (SELECT w AS value, count(*) AS n FROM (SELECT unnest(list_distinct(words)) AS w FROM sel
        WHERE f_brand AND f_type AND f_words AND f_price AND f_size AND f_band) GROUP BY 1)
SELECT coalesce(c.value, s.value) AS value, coalesce(n, 0)::BIGINT AS doc_count, s.value IS NOT NULL AS selected
FROM c FULL JOIN (VALUES ('red')) s(value) ON c.value = s.value""")
def f_words(spark, sf):
    return _part_facets(spark, sf).facets["words"]


@reg("f6_range_facet", _PF + """
SELECT count(p_retailprice)::BIGINT AS count, min(p_retailprice) AS min, max(p_retailprice) AS max
FROM sel WHERE f_brand AND f_type AND f_words AND f_size AND f_band""")
def f_price(spark, sf):
    return _part_facets(spark, sf).facets["price"]


@reg("f7_f8_expression_facet", _PF + """
SELECT v.value, (SELECT count(*) FROM sel WHERE f_brand AND f_type AND f_words AND f_price AND f_size AND
  CASE v.value WHEN 'cheap' THEN p_retailprice < 930 WHEN 'mid' THEN p_retailprice >= 930 AND p_retailprice < 960
               ELSE p_retailprice >= 960 END)::BIGINT AS doc_count, v.value IN ('cheap', 'mid') AS selected
FROM (VALUES ('cheap'), ('mid'), ('dear')) v(value)""")
def f_band(spark, sf):
    return _part_facets(spark, sf).facets["band"]


_ATTR_PARAMS = {("attrs", "1", "any"): [str(i) for i in range(1, 21)], ("attrs", "2", "any"): ["3", "5", "-1"],
                ("ranges", "5", "gte"): ["910.5"], ("ranges", "5", "lte"): ["980"]}


def _attr_facets(spark, sf):
    pa = TB.part_attrs(spark, sf)
    qf = FC.QueryFilters([FC.AttrFacetFilter("attrs", "attrs"), FC.AttrRangeFacetFilter("ranges", "range_attrs")])
    return qf.apply(Search(pa, "p_partkey"), _ATTR_PARAMS)


_AF = """WITH b AS (SELECT p_partkey, p_size AS a1, CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INT) AS a2,
                  CAST(p_retailprice AS FLOAT) AS a5 FROM part),
s AS (SELECT *, a1 BETWEEN 1 AND 20 AS s1, a2 IN (3, 5) AS s2, (a5 >= 910.5 AND a5 <= 980) AS s5 FROM b)
"""


@reg("f9_f10_attr_facet", _AF + """
, c AS (SELECT 1 AS attr_id, a1 AS value, count(*) AS n FROM s WHERE s2 AND s5 GROUP BY 2
        UNION ALL SELECT 2, a2, count(*) FROM s WHERE s1 AND s5 GROUP BY 2),
sel AS (SELECT 1 AS attr_id, unnest(range(1, 21)) AS value UNION ALL SELECT 2, 3 UNION ALL SELECT 2, 5)
SELECT coalesce(c.attr_id, sel.attr_id) AS attr_id, coalesce(c.value, sel.value)::INTEGER AS value,
       coalesce(n, 0)::BIGINT AS doc_count, sel.value IS NOT NULL AS selected
FROM c FULL JOIN sel ON c.attr_id = sel.attr_id AND c.value = sel.value""")
def f_attrs(spark, sf):
    return _attr_facets(spark, sf).facets["attrs"]


@reg("f11_f12_range_attr_facet", _AF + """
SELECT 5 AS attr_id, count(*)::BIGINT AS doc_count, min(a5) AS min, max(a5) AS max FROM s WHERE s1 AND s2""")
def f_ranges(spark, sf):
    return _attr_facets(spark, sf).facets["ranges"]


@reg("f9_f11_attr_hits_total", _AF + """
SELECT count(*)::BIGINT AS total FROM s WHERE s1 AND s2 AND s5""")
def f_attr_total(spark, sf):
    return _attr_facets(spark, sf).total.select("total")


@reg("f1_facets_all_hits", """
SELECT p_partkey, p_brand FROM part WHERE p_brand IN ('Brand#1', 'Brand#2') ORDER BY p_partkey""")
def f1_all(spark, sf):
    s = Search(TB.read(spark, sf, "part"), "p_partkey").size(None)
    return FC.QueryFilters([FC.FacetFilter("brand", "p_brand")]).apply(s, {"brand": ["Brand#1", "Brand#2"]}).hits.select("p_partkey", "p_brand")


def _f1(spark, sf):
    s = (Search(TB.read(spark, sf, "part"), "p_partkey").aggs(type=A.TermsAgg("p_type", aggs={"mean": A.Avg("p_retailprice")}))
         .post_filter(Q.Range("p_size", lte=25)).sort("p_retailprice").offset(5).size(20))
    return FC.QueryFilters([FC.SimpleFilter("size", "p_size"), FC.FacetFilter("brand", "p_brand")]).apply(
        s, {"size": [str(i) for i in range(10, 41)], "brand": ["Brand#3"]})


@reg("f1_facets_with_aggs_and_post_filter", """
SELECT 'agg' AS kind, p_type AS value, count(*)::BIGINT AS n, round(avg(p_retailprice), 6) AS mean, NULL::BOOLEAN AS selected
FROM part WHERE p_size BETWEEN 10 AND 40 GROUP BY 2
UNION ALL SELECT 'facet', p_brand, count(*), NULL, p_brand = 'Brand#3' FROM part WHERE p_size BETWEEN 10 AND 40 GROUP BY 2
UNION ALL SELECT 'total', NULL, count(*), NULL, NULL FROM part WHERE p_size BETWEEN 10 AND 25 AND p_brand = 'Brand#3'
UNION ALL (SELECT 'hit', p_partkey::VARCHAR, 0, NULL, NULL FROM part WHERE p_size BETWEEN 10 AND 25 AND p_brand = 'Brand#3'
           ORDER BY p_retailprice, p_partkey LIMIT 20 OFFSET 5)""")
def f1_aggs(spark, sf):
    r = _f1(spark, sf)
    no, nob = F.lit(None).cast("double"), F.lit(None).cast("boolean")
    n = lambda c: F.col(c).cast("bigint").alias("n")
    parts = [r.aggregations["type"].select(F.lit("agg").alias("kind"), F.col("type").alias("value"), n("doc_count"), "mean", nob.alias("selected")),
             r.facets["brand"].select(F.lit("facet").alias("kind"), "value", n("doc_count"), no.alias("mean"), "selected"),
             r.total.select(F.lit("total").alias("kind"), F.lit(None).cast("string").alias("value"), n("total"), no.alias("mean"), nob.alias("selected")),
             r.hits.select(F.lit("hit").alias("kind"), F.col("p_partkey").cast("string").alias("value"), F.lit(0).cast("bigint").alias("n"),
                           no.alias("mean"), nob.alias("selected"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return rnd(out)


@reg("f4_facet_size_selected_outside", """
WITH c AS (SELECT p_brand AS value, count(*)::BIGINT AS doc_count FROM part GROUP BY 1),
t AS (SELECT value FROM c ORDER BY doc_count DESC, value LIMIT 3)
SELECT value, doc_count, FALSE AS selected FROM c WHERE value IN (SELECT value FROM t)
UNION ALL SELECT 'none such', 0, TRUE""")
def f4_outside(spark, sf):
    s = Search(TB.read(spark, sf, "part"), "p_partkey")
    return FC.QueryFilters([FC.FacetFilter("brand", "p_brand", size=3)]).apply(s, {"brand": ["none such"]}).facets["brand"]


@reg("f4_facet_selected_beyond_size", """
WITH c AS (SELECT l_linenumber::VARCHAR AS value, count(*)::BIGINT AS doc_count FROM lineitem GROUP BY 1)
SELECT value, doc_count, value = '7' AS selected FROM c
WHERE value = '7' OR value IN (SELECT value FROM c ORDER BY doc_count DESC, value LIMIT 2)""")
def f4_beyond(spark, sf):
    s = Search(lineitem(spark, sf), "l_id")
    out = FC.QueryFilters([FC.FacetFilter("line", "l_linenumber", size=2)]).apply(s, {"line": ["7"]}).facets["line"]
    return out.withColumn("value", F.col("value").cast("string"))


@reg("f4_date_facet_selected", """
SELECT epoch_ms(d) AS value, count(*)::BIGINT AS doc_count, d = TIMESTAMP '1996-01-02' AS selected
FROM (SELECT date_trunc('day', o_orderdate) AS d FROM orders) GROUP BY d
UNION ALL SELECT epoch_ms(TIMESTAMP '1890-05-05'), 0, TRUE""")
def f4_date(spark, sf):
    o = TB.read(spark, sf, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    out = FC.QueryFilters([FC.FacetFilter("day", "day")]).apply(Search(o, "o_orderkey"), {"day": ["1996-01-02", "1890-05-05"]}).facets["day"]
    return out.withColumn("value", F.unix_millis(F.col("value").cast("timestamp")))


@reg("f4_facet_custom_terms", """
SELECT p_brand AS brand, count(*)::BIGINT AS doc_count, round(avg(p_retailprice), 6) AS mean, p_brand = 'Brand#12' AS selected FROM part
WHERE p_brand LIKE 'Brand#1_' AND p_brand <> 'Brand#10' GROUP BY 1 ORDER BY mean DESC, brand LIMIT 4""")
def f4_terms(spark, sf):
    terms = A.TermsAgg("p_brand", size=4, include="Brand#1.", exclude=["Brand#10"], order=("mean", "desc"), aggs={"mean": A.Avg("p_retailprice")})
    s = Search(TB.read(spark, sf, "part"), "p_partkey")
    return rnd(FC.QueryFilters([FC.FacetFilter("brand", "p_brand", terms=terms)]).apply(s, {"brand": ["Brand#12"]}).facets["brand"])


@reg("f13_f14_bool_attr_facet", """
WITH s AS (SELECT quality = 1 AS b1, toxic = 1 AS b2 FROM labels),
c AS (SELECT 1 AS attr_id, b1 AS value, count(*) AS n FROM s GROUP BY 2
      UNION ALL SELECT 2, b2, count(*) FROM s WHERE b1 GROUP BY 2)
SELECT attr_id, value, n::BIGINT AS doc_count, (attr_id = 1 AND value) AS selected FROM c""")
def f_bool(spark, sf):
    la = TB.label_attrs(spark, sf)
    qf = FC.QueryFilters([FC.AttrBoolFacetFilter("flags", "bool_attrs")])
    return qf.apply(Search(la, "doc_id"), {("flags", "1"): ["true", "maybe"]}).facets["flags"]


# ----------------------------------------------------------------------------- text and relevance

from docsift.operators import scoring as SC  # noqa: E402
from docsift.plans.search import Rescore  # noqa: E402

_TOK = "regexp_extract_all(lower({f}), '[\\p{{L}}\\p{{N}}]+')"


def bm25_sql(src: str, idc: str, field: str, terms: list[str], boost: float = 1.0) -> str:
    """DuckDB subquery (id, s, nhit, ...) with the BM25 score of ``terms``
    (k1=1.2, b=0.75; idf ln(1 + (N - df + 0.5) / (df + 0.5))) over the whole ``src``."""
    tok = _TOK.format(f=field)
    dfs = ", ".join(f"count(*) FILTER (WHERE list_contains(tok, '{w}'))::DOUBLE AS df{i}" for i, w in enumerate(terms))
    tfs = ", ".join(f"len(list_filter(tok, lambda x: x = '{w}'))::DOUBLE AS tf{i}" for i, w in enumerate(terms))
    sc = " + ".join(f"CASE WHEN tf{i} > 0 THEN ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} / "
                    f"(tf{i} + 1.2 * (0.25 + 0.75 * dl / avgdl)) ELSE 0 END" for i in range(len(terms)))
    hits = " + ".join(f"(tf{i} > 0)::INT" for i in range(len(terms)))
    return (f"(SELECT id, ({sc}) * {boost} AS s, ({hits}) AS nhit, tok FROM "
            f"(SELECT id, tok, len(tok)::DOUBLE AS dl, {tfs} FROM (SELECT {idc} AS id, {tok} AS tok FROM {src} WHERE {field} IS NOT NULL)), "
            f"(SELECT count(*)::DOUBLE AS n, avg(len(tok)) AS avgdl, {dfs} FROM (SELECT {tok} AS tok FROM {src} WHERE {field} IS NOT NULL)))")


def _docs(spark, sf):
    return Search(TB.read(spark, sf, "documents"), "doc_id")


def _scored(df):
    return rnd(df)


@reg("p11_r1_match_bm25", f"""
SELECT id AS doc_id, round(s, 6) AS _score FROM {bm25_sql('documents', 'doc_id', 'text', ['und', 'der', 'xylophon'])} WHERE nhit >= 1""")
def p11_match(spark, sf):
    return _scored(_docs(spark, sf).query(Q.Match("text", "Und der XYLOPHON!")).matched().select("doc_id", "_score"))


@reg("p11_match_msm", f"""
SELECT id AS doc_id, round(s, 6) AS _score FROM {bm25_sql('documents', 'doc_id', 'text', ['the', 'of', 'und', 'la'])} WHERE nhit >= 3""")
def p11_msm(spark, sf):
    return _scored(_docs(spark, sf).query(Q.Match("text", "the of und la", minimum_should_match="75%")).matched().select("doc_id", "_score"))


@reg("p11_match_analyzer", f"""
WITH a AS (SELECT id, s, nhit FROM {bm25_sql('documents', 'doc_id', 'text', ['river', 'und'])}),
b AS (SELECT id, s, nhit FROM {bm25_sql('documents', 'doc_id', 'text', ['the'])})
SELECT 'stop' AS analyzer, id AS doc_id, round(s, 6) AS _score FROM a WHERE nhit >= 1 UNION ALL SELECT 'whitespace', id, round(s, 6) FROM b WHERE nhit >= 1""")
def p11_analyzer(spark, sf):
    stop = _docs(spark, sf).query(Q.Match("text", "The river AND und", analyzer="stop")).matched()
    words = _docs(spark, sf).query(Q.Match("text", "the UND river,", analyzer="whitespace")).matched()  # of these, documents can hold only "the"
    return _scored(stop.select(F.lit("stop").alias("analyzer"), "doc_id", "_score").union(words.select(F.lit("whitespace"), "doc_id", "_score")))


@reg("p12_match_phrase", f"""
SELECT id AS doc_id, round(s, 6) AS _score FROM {bm25_sql('documents', 'doc_id', 'text', ['of', 'the'])}
WHERE ' ' || array_to_string(tok, ' ') || ' ' LIKE '% of the %'""")
def p12_phrase(spark, sf):
    return _scored(_docs(spark, sf).query(Q.MatchPhrase("text", "of the")).matched().select("doc_id", "_score"))


@reg("p7_range_open_bounds", """
WITH r AS (SELECT l_orderkey, min(l_quantity) AS gt, max(l_quantity) AS lt FROM lineitem GROUP BY 1)
SELECT l_orderkey, (lt > 20 AND gt < 30) AS intersects, (gt >= 20 AND lt <= 30) AS within, (gt < 20 AND lt > 30) AS contains FROM r""")
def p7_open(spark, sf):
    li = TB.read(spark, sf, "lineitem")
    r = li.groupBy("l_orderkey").agg(F.struct(F.min("l_quantity").alias("gt"), F.max("l_quantity").alias("lt")).alias("q"))
    ctx = Search(r, "l_orderkey")._ctx(r)
    kinds = {k: Q.Range("q", gte=20, lte=30, relation=k).predicate(ctx) for k in ("intersects", "within", "contains")}
    return r.select("l_orderkey", *[c.alias(k) for k, c in kinds.items()])


@reg("p12_match_phrase_slop", f"""
WITH m AS (SELECT * FROM {bm25_sql('documents', 'doc_id', 'text', ['the', 'and'])} WHERE nhit = 2),
p AS (SELECT id, unnest(tok) AS t, unnest(range(len(tok))) AS i FROM m)
SELECT id AS doc_id, round(s, 6) AS _score FROM m WHERE id IN (
  SELECT a.id FROM p a JOIN p b ON a.id = b.id AND abs(b.i - 1 - a.i) <= 2 WHERE a.t = 'the' AND b.t = 'and')""")
def p12_slop(spark, sf):
    return _scored(_docs(spark, sf).query(Q.MatchPhrase("text", "the and", slop=2)).matched().select("doc_id", "_score"))


def _mm_sql(kind: str) -> str:
    a = bm25_sql("part", "p_partkey", "p_name", ["red", "large", "gear"])
    b = bm25_sql("part", "p_partkey", "p_type", ["red", "large", "gear"], 2.0)
    if kind == "best":
        comb = "greatest(sa, sb) + 0.3 * (sa + sb - greatest(sa, sb))"
    else:
        comb = "sa + sb"
    return f"""
SELECT p_partkey, round({comb}, 6) AS _score FROM (
  SELECT p_partkey, coalesce(CASE WHEN a.nhit > 0 THEN a.s END, 0) AS sa, coalesce(CASE WHEN b.nhit > 0 THEN b.s END, 0) AS sb,
         coalesce(a.nhit, 0) + coalesce(b.nhit, 0) AS nh
  FROM part LEFT JOIN {a} a ON a.id = p_partkey LEFT JOIN {b} b ON b.id = p_partkey) WHERE nh > 0"""


@reg("p13_multi_match_best_fields", _mm_sql("best"))
def p13_best(spark, sf):
    q = Q.MultiMatch("red large gear", ["p_name", "p_type^2"], type="best_fields", tie_breaker=0.3)
    return _scored(Search(TB.read(spark, sf, "part"), "p_partkey").query(q).matched().select("p_partkey", "_score"))


@reg("p13_multi_match_most_fields", _mm_sql("most"))
def p13_most(spark, sf):
    q = Q.MultiMatch("red large gear", ["p_name", "p_type^2"], type="most_fields")
    return _scored(Search(TB.read(spark, sf, "part"), "p_partkey").query(q).matched().select("p_partkey", "_score"))


@reg("p13_multi_match_cross_fields", f"""
SELECT p_partkey, round(greatest(coalesce(a0.s, 0), coalesce(b0.s, 0)) + greatest(coalesce(a1.s, 0), coalesce(b1.s, 0)), 6) AS _score
FROM part
LEFT JOIN {bm25_sql('part', 'p_partkey', 'p_name', ['small'])} a0 ON a0.id = p_partkey
LEFT JOIN {bm25_sql('part', 'p_partkey', 'p_type', ['small'])} b0 ON b0.id = p_partkey
LEFT JOIN {bm25_sql('part', 'p_partkey', 'p_name', ['promo'])} a1 ON a1.id = p_partkey
LEFT JOIN {bm25_sql('part', 'p_partkey', 'p_type', ['promo'])} b1 ON b1.id = p_partkey
WHERE a0.nhit + b0.nhit >= 1 AND a1.nhit + b1.nhit >= 1""")
def p13_cross(spark, sf):
    q = Q.MultiMatch("small promo", ["p_name", "p_type"], type="cross_fields", operator="and")
    return _scored(Search(TB.read(spark, sf, "part"), "p_partkey").query(q).matched().select("p_partkey", "_score"))


@reg("p15_r4_dis_max", f"""
SELECT id AS doc_id, round(greatest(sa, sb) + 0.5 * (sa + sb - greatest(sa, sb)), 6) AS _score FROM (
  SELECT a.id, CASE WHEN a.nhit > 0 THEN a.s ELSE 0 END AS sa, CASE WHEN b.nhit > 0 THEN b.s ELSE 0 END AS sb, a.nhit + b.nhit AS nh
  FROM {bm25_sql('documents', 'doc_id', 'text', ['und'])} a JOIN {bm25_sql('documents', 'doc_id', 'text', ['les'])} b USING (id))
WHERE nh > 0""")
def p15_dismax(spark, sf):
    q = Q.DisMax([Q.Match("text", "und"), Q.Match("text", "les")], tie_breaker=0.5)
    return _scored(_docs(spark, sf).query(q).matched().select("doc_id", "_score"))


@reg("r2_r3_bool_score_boost", f"""
SELECT d.doc_id, round(a.s + CASE WHEN b.nhit > 0 THEN b.s ELSE 0 END + CASE WHEN d.lang = 'en' THEN 0.5 ELSE 0 END, 6) AS _score
FROM documents d JOIN {bm25_sql('documents', 'doc_id', 'text', ['the'])} a ON a.id = d.doc_id
JOIN {bm25_sql('documents', 'doc_id', 'text', ['of'], 2.0)} b ON b.id = d.doc_id
WHERE a.nhit > 0 AND d.n_chars >= 500""")
def r2_bool(spark, sf):
    q = Q.Bool(must=[Q.Match("text", "the")], should=[Q.Match("text", "of", boost=2.0), Q.Term("lang", "en", boost=0.5)],
               filter=[Q.Range("n_chars", gte=500)])
    return _scored(_docs(spark, sf).query(q).matched().select("doc_id", "_score"))


_FS_Q = bm25_sql("part", "p_partkey", "p_name", ["red", "bolt"])


@reg("r6_r9_function_score_sum", f"""
SELECT p_partkey, round(q * ((CASE WHEN p_type = 'SMALL' THEN 2.0 ELSE 0 END)
    + log10(1 + 0.1 * coalesce(p_size, 1)) + (p_retailprice / 1000 + q)), 6) AS _score
FROM part JOIN (SELECT id, s AS q FROM {_FS_Q} WHERE nhit > 0) ON id = p_partkey""")
def r6_fs_sum(spark, sf):
    fs = SC.FunctionScore(Q.Match("p_name", "red bolt"), [
        SC.Weight(2.0, filter=Q.Term("p_type", "SMALL")),
        SC.FieldValueFactor("p_size", factor=0.1, modifier="log1p", missing=1),
        SC.ScriptScore("p_retailprice / 1000 + _score")], score_mode="sum", boost_mode="multiply")
    return _scored(Search(TB.read(spark, sf, "part"), "p_partkey").query(fs).matched().select("p_partkey", "_score"))


@reg("r6_r8_function_score_modes", f"""
SELECT p_partkey, round(greatest(sqrt(p_size * 1.0), CASE WHEN p_brand = 'Brand#3' THEN 5.0 END), 6) AS _score
FROM part WHERE greatest(sqrt(p_size * 1.0), CASE WHEN p_brand = 'Brand#3' THEN 5.0 END) >= 4""")
def r6_fs_modes(spark, sf):
    fs = SC.FunctionScore(Q.MatchAll(), [SC.FieldValueFactor("p_size", modifier="sqrt"), SC.Weight(5.0, filter=Q.Term("p_brand", "Brand#3"))],
                          score_mode="max", boost_mode="replace", min_score=4)
    return _scored(Search(TB.read(spark, sf, "part"), "p_partkey").query(fs).matched().select("p_partkey", "_score"))


@reg("r6_function_score_avg_weighted", """
SELECT p_partkey, round(1.0 * ((CASE WHEN p_type = 'SMALL' THEN 3.0 ELSE 0 END) + 2 * ln(p_size + 2.0) + (CASE WHEN p_size > 40 THEN 1.0 / p_size ELSE 0 END))
  / ((CASE WHEN p_type = 'SMALL' THEN 3.0 ELSE 0 END) + 2 + (CASE WHEN p_size > 40 THEN 1.0 ELSE 0 END)), 6) AS _score
FROM part""")
def r6_fs_avg(spark, sf):
    fs = SC.FunctionScore(None, [SC.Weight(3.0, filter=Q.Term("p_type", "SMALL")),
                                 SC.FieldValueFactor("p_size", modifier="ln2p", weight=2.0),
                                 SC.FieldValueFactor("p_size", modifier="reciprocal", filter=Q.Range("p_size", gt=40))],
                          score_mode="avg", boost_mode="multiply")
    return _scored(Search(TB.read(spark, sf, "part"), "p_partkey").query(fs).matched().select("p_partkey", "_score"))


@reg("r10_random_score", """
SELECT p_partkey, ('0x' || substr(md5('42:' || p_partkey), 1, 6))::BIGINT / 16777216.0::DOUBLE AS _score FROM part
ORDER BY _score DESC, p_partkey LIMIT 50""")
def r10_random(spark, sf):
    fs = SC.FunctionScore(Q.MatchAll(), [SC.RandomScore(seed=42, field="p_partkey")], boost_mode="replace")
    return Search(TB.read(spark, sf, "part"), "p_partkey").query(fs).size(50).hits().select("p_partkey", "_score")


_RS_A = bm25_sql("documents", "doc_id", "text", ["the"])
_RS_B = bm25_sql("documents", "doc_id", "text", ["of", "the"])


@reg("r11_rescore", f"""
WITH a AS (SELECT id, s FROM {_RS_A} WHERE nhit > 0),
r AS (SELECT *, row_number() OVER (ORDER BY s DESC, id) AS rn FROM a),
b AS (SELECT id, s AS s2 FROM {_RS_B} WHERE ' ' || array_to_string(tok, ' ') || ' ' LIKE '% of the %'),
x AS (SELECT r.id, rn, CASE WHEN rn <= 30 THEN (CASE WHEN s2 IS NOT NULL THEN s + 2.0 * s2 ELSE s END) ELSE s END AS ns
      FROM r LEFT JOIN b USING (id))
SELECT id AS doc_id, round(ns, 6) AS _score FROM x ORDER BY (rn <= 30) DESC, ns DESC, rn LIMIT 15""")
def r11_rescore(spark, sf):
    s = _docs(spark, sf).query(Q.Match("text", "the")).rescore(
        Rescore(Q.MatchPhrase("text", "of the"), window_size=30, rescore_query_weight=2.0)).size(15)
    return _scored(s.hits().select("doc_id", "_score"))


@reg("r12_explain", f"""
WITH a AS (SELECT id, s FROM {_RS_A} WHERE nhit > 0), b AS (SELECT id, s AS s2, nhit AS h2 FROM {bm25_sql('documents', 'doc_id', 'text', ['of'])}),
t AS (SELECT a.id, s, CASE WHEN h2 > 0 THEN s2 ELSE 0 END AS s2 FROM a JOIN b USING (id) ORDER BY s + CASE WHEN h2 > 0 THEN s2 ELSE 0 END DESC, id LIMIT 5)
SELECT id AS doc_id, 'query' AS path, 'sum of:' AS description, round(s + s2, 6) AS value FROM t
UNION ALL SELECT id, 'query.must[0]', 'sum of:', round(s, 6) FROM t
UNION ALL SELECT id, 'query.must[0].terms[0]', 'weight(text:the)', round(s, 6) FROM t
UNION ALL SELECT id, 'query.should[0]', 'sum of:', round(s2, 6) FROM t
UNION ALL SELECT id, 'query.should[0].terms[0]', 'weight(text:of)', round(s2, 6) FROM t""")
def r12_explain(spark, sf):
    q = Q.Bool(must=[Q.Match("text", "the")], should=[Q.Match("text", "of")])
    h = _docs(spark, sf).query(q).explain().size(5).hits()
    return rnd(h.select("doc_id", F.inline("_explanation")))


@reg("r13_track_scores", f"""
SELECT p_partkey, p_retailprice, round(s, 6) AS _score FROM part JOIN {bm25_sql('part', 'p_partkey', 'p_name', ['red'])} ON id = p_partkey
WHERE nhit > 0 ORDER BY p_retailprice DESC, p_partkey LIMIT 20""")
def r13_track(spark, sf):
    s = Search(TB.read(spark, sf, "part"), "p_partkey").query(Q.Match("p_name", "red")).sort("-p_retailprice").track_scores().size(20)
    return _scored(s.hits().select("p_partkey", "p_retailprice", "_score"))


# ----------------------------------------------------------------------------- nested documents


@reg("p14_nested_same_element", """
SELECT o_orderkey FROM orders o WHERE EXISTS (
  SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l_returnflag = 'R' AND l_quantity >= 45)""")
def p14_nested(spark, sf):
    q = Q.Nested("items", Q.Bool(filter=[Q.Term("items.returnflag", "R"), Q.Range("items.quantity", gte=45)]))
    return Search(TB.orders_nested(spark, sf, ("returnflag", "quantity")), "o_orderkey").query(q).matched().select("o_orderkey")


@reg("r5_nested_score_modes", """
SELECT l_orderkey AS o_orderkey, round(max(l_extendedprice * 0.01), 6) AS s_max, round(avg(l_extendedprice * 0.01), 6) AS s_avg,
       round(sum(l_extendedprice * 0.01), 6) AS s_sum, round(min(l_extendedprice * 0.01), 6) AS s_min, count(*)::DOUBLE AS s_cnt
FROM lineitem WHERE l_quantity >= 40 AND l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY 1""")
def r5_nested(spark, sf):
    inner = SC.FunctionScore(Q.Range("items.quantity", gte=40), [SC.FieldValueFactor("items.price", factor=0.01)], boost_mode="replace")
    base = TB.orders_nested(spark, sf, ("quantity", "price"))
    ctx = Q.Ctx(base, "o_orderkey")
    cols = {m: Q.Nested("items", inner, score_mode=m).score(ctx) for m in ("max", "avg", "sum", "min")}
    cnt = Q.Nested("items", Q.Range("items.quantity", gte=40), score_mode="sum").score(ctx)
    pred = Q.Nested("items", inner).predicate(ctx)
    return rnd(base.filter(pred).select("o_orderkey", *[c.alias(f"s_{m}") for m, c in cols.items()], cnt.alias("s_cnt")))


# ----------------------------------------------------------------------------- parent / child

from docsift.operators import relations as RL  # noqa: E402


@reg("j1_has_child_min_max", """
SELECT 'o' || l_orderkey AS _id FROM lineitem WHERE l_quantity >= 45 AND l_orderkey IN (SELECT o_orderkey FROM orders)
GROUP BY l_orderkey HAVING count(*) BETWEEN 1 AND 2""")
def j1_has_child(spark, sf):
    q = RL.HasChild("line", Q.Range("l_quantity", gte=45), max_children=2)
    return Search(TB.order_family(spark, sf), "_id").query(q).matched().select("_id")


@reg("j2_has_child_score_modes", """
WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_quantity * 0.1 AS s FROM lineitem
           WHERE l_quantity >= 40 AND l_orderkey IN (SELECT o_orderkey FROM orders))
SELECT 'o' || l_orderkey AS _id, round(sum(s), 6) AS s_sum, round(avg(s), 6) AS s_avg, round(max(s), 6) AS s_max,
       round(min(s), 6) AS s_min, round(exp(sum(ln(s))), 6) AS s_multiply,
       round(arg_min(s, 'l' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || l_quantity::BIGINT), 6)
         AS s_first, 0.0::DOUBLE AS s_none
FROM c GROUP BY l_orderkey""")
def j2_modes(spark, sf):
    fam = TB.order_family(spark, sf)
    inner = SC.FunctionScore(Q.Range("l_quantity", gte=40), [SC.FieldValueFactor("l_quantity", factor=0.1)], boost_mode="replace")
    ctx = Q.Ctx(fam, "_id")
    modes = ("sum", "avg", "max", "min", "multiply", "first", "none")
    qs = {m: RL.HasChild("line", inner, score_mode=m) for m in modes}
    cols = {m: q.score(ctx) for m, q in qs.items()}
    pred = qs["sum"].predicate(ctx)
    return rnd(ctx.apply(fam).filter(pred).select("_id", *[c.alias(f"s_{m}") for m, c in cols.items()]))


@reg("j3_has_parent_score", """
SELECT 'l' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || l_quantity::BIGINT AS _id,
       round(o_totalprice * 0.00001, 6) AS _score
FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F'""")
def j3_has_parent(spark, sf):
    pq = SC.FunctionScore(Q.Term("o_orderstatus", "F"), [SC.FieldValueFactor("o_totalprice", factor=0.00001)], boost_mode="replace")
    q = RL.HasParent("order", pq, score_=True)
    return _scored(Search(TB.order_family(spark, sf), "_id").query(q).matched().select("_id", "_score"))


_FAMILIES: dict = {}


def _families(spark, sf):
    """The family table, bucketed by family, written once per application and input."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FAMILIES:
        _FAMILIES[key] = RL.store_families(TB.order_family(spark, sf), "_id", buckets=16)
    return _FAMILIES[key]


@reg("j1_j2_stored_families", """
WITH c AS (SELECT l_orderkey, l_quantity * 0.1 AS s FROM lineitem WHERE l_quantity >= 40 AND l_orderkey IN (SELECT o_orderkey FROM orders))
SELECT 'o' || l_orderkey AS _id, round(sum(s) + max(s), 6) AS _score FROM c GROUP BY l_orderkey HAVING count(*) >= 2""")
def j1_stored(spark, sf):
    inner = SC.FunctionScore(Q.Range("l_quantity", gte=40), [SC.FieldValueFactor("l_quantity", factor=0.1)], boost_mode="replace")
    q = Q.Bool(must=[RL.HasChild("line", inner, min_children=2, score_mode="sum"), RL.HasChild("line", inner, score_mode="max")])
    return _scored(Search(_families(spark, sf), "_id").query(q).matched().select("_id", "_score"))


@reg("j3_stored_families", SQL["j3_has_parent_score"])
def j3_stored(spark, sf):
    pq = SC.FunctionScore(Q.Term("o_orderstatus", "F"), [SC.FieldValueFactor("o_totalprice", factor=0.00001)], boost_mode="replace")
    return _scored(Search(_families(spark, sf), "_id").query(RL.HasParent("order", pq, score_=True)).matched().select("_id", "_score"))


@reg("j4_family_terms", """
SELECT 'o' || o_orderkey AS family, (1 + count(l_orderkey))::BIGINT AS doc_count
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
UNION ALL SELECT 'o' || l_orderkey, count(*)::BIGINT FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY l_orderkey""")
def j4_family(spark, sf):
    s = Search(TB.order_family(spark, sf), "_id").aggs(family=A.TermsAgg(script=RL.family_key("_id"), size=None))
    return s.aggregations()["family"]


@reg("j5_relation_name_filter", """
SELECT l_returnflag AS flag, count(*)::BIGINT AS doc_count FROM lineitem WHERE l_quantity < 5 GROUP BY 1""")
def j5_relation(spark, sf):
    s = Search(TB.order_family(spark, sf), "_id").filter(Q.Term("join.name", "line"), Q.Range("l_quantity", lt=5)).aggs(
        flag=A.TermsAgg("l_returnflag", size=None))
    return s.aggregations()["flag"]


# ----------------------------------------------------------------------------- vectors

from docsift.operators.knn import Knn, KnnQuery  # noqa: E402

# Fixed query vector (64 dims) used by the kNN queries.
QV = tuple(round(((i * 37) % 11 - 5) / 10.0, 1) for i in range(64))
_QV_SQL = "[" + ", ".join(repr(x) for x in QV) + "]::DOUBLE[]"
_E = "embedding::DOUBLE[]"
_DOT = f"list_sum(list_transform(list_zip({_E}, {_QV_SQL}), lambda x: x[1] * x[2]))"
_L2 = f"list_sum(list_transform(list_zip({_E}, {_QV_SQL}), lambda x: (x[1] - x[2]) * (x[1] - x[2])))"
_L1 = f"list_sum(list_transform(list_zip({_E}, {_QV_SQL}), lambda x: abs(x[1] - x[2])))"
_NORM = f"sqrt(list_sum(list_transform({_E}, lambda x: x * x)))"
_QN = sum(x * x for x in QV) ** 0.5


@reg("r14_knn_l2_filter", f"""
SELECT vec_id, round(1.0 / (1.0 + {_L2}), 6) AS _score FROM embeddings WHERE label = 1
ORDER BY 1.0 / (1.0 + {_L2}) DESC, vec_id LIMIT 10""")
def r14_l2(spark, sf):
    s = Search(TB.read(spark, sf, "embeddings"), "vec_id").knn(Knn("embedding", QV, k=10, filter=Q.Term("label", 1))).size(10)
    return _scored(s.hits().select("vec_id", "_score"))


@reg("r14_knn_cosine", f"""
SELECT vec_id, round((1 + {_DOT} / ({_NORM} * {_QN!r})) / 2, 6) AS _score FROM embeddings
ORDER BY (1 + {_DOT} / ({_NORM} * {_QN!r})) / 2 DESC, vec_id LIMIT 7""")
def r14_cos(spark, sf):
    s = Search(TB.read(spark, sf, "embeddings"), "vec_id").knn(Knn("embedding", QV, k=7, similarity="cosine")).size(7)
    return _scored(s.hits().select("vec_id", "_score"))


@reg("r15_knn_query_l1_k", f"""
SELECT vec_id, round(1.0 / (1.0 + {_L1}), 6) AS _score FROM embeddings ORDER BY {_L1}, vec_id LIMIT 5""")
def r15_l1(spark, sf):
    q = KnnQuery("embedding", QV, k=5, space="l1")
    return _scored(Search(TB.read(spark, sf, "embeddings"), "vec_id").query(q).size(5).hits().select("vec_id", "_score"))


@reg("r15_knn_radial", f"""
SELECT vec_id, round(1.0 / (1.0 + {_L2}), 6) AS _score FROM embeddings WHERE sqrt({_L2}) <= 3.5""")
def r15_radial(spark, sf):
    q = KnnQuery("embedding", QV, max_distance=3.5, space="l2")
    return _scored(Search(TB.read(spark, sf, "embeddings"), "vec_id").query(q).matched().select("vec_id", "_score"))


@reg("r15_knn_min_score_inner_product", f"""
SELECT vec_id, round(CASE WHEN {_DOT} < 0 THEN 1.0 / (1.0 - {_DOT}) ELSE {_DOT} + 1.0 END, 6) AS _score FROM embeddings
WHERE CASE WHEN {_DOT} < 0 THEN 1.0 / (1.0 - {_DOT}) ELSE {_DOT} + 1.0 END >= 1.5""")
def r15_ip(spark, sf):
    q = KnnQuery("embedding", QV, min_score=1.5, space="innerproduct")
    return _scored(Search(TB.read(spark, sf, "embeddings"), "vec_id").query(q).matched().select("vec_id", "_score"))


@reg("r16_hybrid_knn_text", f"""
WITH dv AS (SELECT d.*, e.embedding FROM documents d JOIN embeddings e ON d.doc_id = e.vec_id),
t AS (SELECT id, s FROM {bm25_sql('dv', 'doc_id', 'text', ['und', 'der'])} WHERE nhit > 0),
k AS (SELECT doc_id AS id, 1.0 / (1.0 + {_L2}) AS ks FROM dv ORDER BY ks DESC, doc_id LIMIT 10)
SELECT coalesce(t.id, k.id) AS doc_id, round(coalesce(s, 0) + coalesce(ks, 0), 6) AS _score
FROM t FULL JOIN k ON t.id = k.id ORDER BY coalesce(s, 0) + coalesce(ks, 0) DESC, doc_id LIMIT 20""")
def r16_hybrid(spark, sf):
    s = Search(TB.doc_vectors(spark, sf), "doc_id").query(Q.Match("text", "und der")).knn(Knn("embedding", QV, k=10)).size(20)
    return _scored(s.hits().select("doc_id", "_score"))


# ----------------------------------------------------------------------------- writes

from docsift.operators import writes as WR  # noqa: E402

def _bulk_sql(extra: str = "", ids: int = 1000, version: str = "NULL::BIGINT") -> str:
    """Oracle for bulk requests: a recursive fold over each id's actions.

    ``extra`` gives the actions' vtype, version, script, n and scripted_upsert,
    where they have them; ``version`` the stored documents' versions.
    """
    extra = extra or "NULL::VARCHAR AS vtype, NULL::BIGINT AS version, NULL::VARCHAR AS script, 0 AS n, false AS scripted_upsert"
    return f"""
base AS (SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_acctbal AS bal, c_mktsegment AS seg, {version} AS version FROM customer),
act AS (SELECT c_custkey AS seq,
    CASE WHEN c_custkey % 7 = 0 THEN 'delete' WHEN c_custkey % 7 = 1 THEN 'create' WHEN c_custkey % 7 <= 3 THEN 'update' ELSE 'index' END AS op,
    c_custkey % {ids} + CASE WHEN c_custkey % 3 = 0 THEN 5000000 ELSE 0 END AS id,
    c_name AS d_name, c_nationkey AS d_nation, c_acctbal AS d_bal, c_mktsegment AS d_seg,
    c_acctbal + 1 AS u_bal, CASE WHEN c_custkey % 2 = 0 THEN 'UPDATED' END AS u_seg,
    c_custkey % 5 = 0 AS has_upsert, c_custkey % 5 = 1 AS doc_as_upsert, {extra}
  FROM customer),
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn FROM act),
f AS (
  SELECT i.id, 0::BIGINT AS rn, NULL::BIGINT AS seq, NULL::VARCHAR AS op, NULL::VARCHAR AS status, b.id IS NOT NULL AS live, b.version AS ver,
         b.name, b.nation, b.bal, b.seg, 0::BIGINT AS writes
  FROM (SELECT DISTINCT id FROM act) i LEFT JOIN base b USING (id)
  UNION ALL
  SELECT id, rn, seq, op, status, CASE WHEN status IN ('created', 'updated') THEN true WHEN status = 'deleted' THEN false ELSE live END,
         CASE WHEN NOT wrote THEN ver WHEN vtype IS NOT NULL THEN version ELSE coalesce(ver, 0) + 1 END,
         CASE WHEN wrote THEN n_name ELSE name END, CASE WHEN wrote THEN n_nation ELSE nation END, CASE WHEN wrote THEN n_bal ELSE bal END,
         CASE WHEN wrote THEN n_seg ELSE seg END, writes + wrote::BIGINT
  FROM (SELECT *, coalesce(status IN ('created', 'updated', 'deleted'), false) AS wrote FROM (
    SELECT *, CASE
        WHEN NOT ok THEN 'conflict'
        WHEN op = 'index' THEN CASE WHEN live THEN 'updated' ELSE 'created' END
        WHEN op = 'create' THEN CASE WHEN live THEN 'conflict' ELSE 'created' END
        WHEN op = 'delete' THEN CASE WHEN live THEN 'deleted' ELSE 'not_found' END
        WHEN run THEN CASE WHEN asked = 'none' THEN 'noop' WHEN asked = 'delete' THEN CASE WHEN live THEN 'deleted' ELSE 'noop' END
                           WHEN live THEN 'updated' ELSE 'created' END
        WHEN live THEN CASE WHEN n_bal IS NOT DISTINCT FROM bal AND n_seg IS NOT DISTINCT FROM seg THEN 'noop' ELSE 'updated' END
        WHEN has_upsert OR doc_as_upsert THEN 'created' ELSE 'not_found' END AS status
    FROM (SELECT *,
        CASE WHEN op <> 'update' THEN d_name WHEN run THEN o_name WHEN live THEN name WHEN doc_as_upsert THEN NULL ELSE 'upserted' END AS n_name,
        CASE WHEN op <> 'update' THEN d_nation WHEN run THEN o_nation WHEN live THEN nation WHEN doc_as_upsert THEN NULL ELSE 0 END AS n_nation,
        CASE WHEN op <> 'update' THEN d_bal WHEN run THEN CASE WHEN script = 'add' THEN coalesce(o_bal, 0) + n ELSE o_bal END
             WHEN live THEN coalesce(u_bal, bal) WHEN doc_as_upsert THEN u_bal ELSE 0.0 END AS n_bal,
        CASE WHEN op <> 'update' THEN d_seg WHEN run THEN CASE WHEN script = 'tag' THEN concat(coalesce(o_seg, ''), '-', n) ELSE o_seg END
             WHEN live THEN coalesce(u_seg, seg) WHEN doc_as_upsert THEN u_seg ELSE 'NEW' END AS n_seg,
        CASE WHEN script = 'tag' AND length(o_seg) > 20 THEN 'none' WHEN script = 'tag' AND n = 6 THEN 'delete' ELSE 'index' END AS asked
      FROM (SELECT *,
          CASE WHEN live THEN name WHEN has_upsert THEN 'upserted' END AS o_name, CASE WHEN live THEN nation WHEN has_upsert THEN 0 END AS o_nation,
          CASE WHEN live THEN bal WHEN has_upsert THEN 0.0 END AS o_bal, CASE WHEN live THEN seg WHEN has_upsert THEN 'NEW' END AS o_seg,
          op = 'update' AND script IS NOT NULL AND (live OR scripted_upsert) AS run,
          vtype IS NULL OR ver IS NULL OR (vtype = 'external' AND version > ver) OR (vtype = 'external_gte' AND version >= ver) AS ok
        FROM (SELECT r.*, f.live, f.ver, f.name, f.nation, f.bal, f.seg, f.writes FROM f JOIN r ON r.id = f.id AND r.rn = f.rn + 1)))))),
items AS (SELECT seq, id, op, status FROM f WHERE rn > 0),
fin AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY id ORDER BY rn DESC) = 1),
tab AS (SELECT id, name, nation, bal, seg, ver FROM fin WHERE writes > 0 AND live
        UNION ALL SELECT * FROM base WHERE id NOT IN (SELECT id FROM fin WHERE writes > 0))"""


@reg("w6_bulk_items", "WITH RECURSIVE " + _bulk_sql().strip() + """
SELECT * FROM items""")
def w6_items(spark, sf):
    r = WR.bulk(TB.read(spark, sf, "customer"), TB.customer_actions(spark, sf), "c_custkey")
    return r.items.select("seq", "id", "op", "status")


_TAB_SQL = """
SELECT id AS c_custkey, name AS c_name, nation AS c_nationkey, round(bal, 6) AS c_acctbal, seg AS c_mktsegment FROM tab"""


@reg("w1_w4_bulk_table", "WITH RECURSIVE " + _bulk_sql().strip() + _TAB_SQL)
def w1_table(spark, sf):
    r = WR.bulk(TB.read(spark, sf, "customer"), TB.customer_actions(spark, sf), "c_custkey")
    return rnd(r.table)


@reg("w5_versioned_items", "WITH RECURSIVE " + _bulk_sql(
    "CASE WHEN c_custkey % 2 = 0 THEN 'external' ELSE 'external_gte' END AS vtype, (c_custkey * 7919) % 1000 AS version, NULL::VARCHAR AS script, 0 AS n, "
    "false AS scripted_upsert").strip() + """
SELECT * FROM items""")
def w5_versioned(spark, sf):
    r = WR.bulk(TB.read(spark, sf, "customer"), TB.customer_actions(spark, sf, versioned=True), "c_custkey")
    return r.items.select("seq", "id", "op", "status")


# ids with many actions each: stored versions, plain and versioned writes, scripts in chains
_MIXED_SQL = _bulk_sql(
    "CASE WHEN c_custkey % 11 IN (2, 7) AND c_custkey % 7 NOT IN (2, 3) THEN CASE WHEN c_custkey % 2 = 0 THEN 'external' ELSE 'external_gte' END END AS vtype, "
    "c_custkey // 97 * 3 + c_custkey % 5 AS version, CASE WHEN c_custkey % 4 = 0 THEN 'add' WHEN c_custkey % 4 = 1 THEN 'tag' END AS script, "
    "(c_custkey % 13)::INT % 7 AS n, c_custkey % 6 < 3 AS scripted_upsert", ids=97, version="CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 20 END")
_MIXED_SCRIPTS = {"add": {"c_acctbal": "coalesce(c_acctbal, 0) + params.n"},
                  "tag": {"c_mktsegment": "concat(coalesce(c_mktsegment, ''), '-', params.n)",
                          "_op": "CASE WHEN length(c_mktsegment) > 20 THEN 'none' WHEN params.n = 6 THEN 'delete' ELSE 'index' END"}}


def _mixed_bulk(spark, sf):
    base = TB.read(spark, sf, "customer").withColumn("_version", F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey") % 20).cast("long"))
    k = F.col("seq")
    kind = F.when(k % 2 == 0, "external").otherwise("external_gte")
    acts = TB.customer_actions(spark, sf, ids=97).withColumns({
        "version_type": F.when((k % 11).isin(2, 7) & ~(k % 7).isin(2, 3), kind), "version": F.floor(k / 97) * 3 + k % 5,
        "script": F.when(F.col("op") == "update", F.when(k % 4 == 0, "add").when(k % 4 == 1, "tag")),
        "params": F.struct(((k % 13) % 7).cast("int").alias("n")), "scripted_upsert": k % 6 < 3})
    return WR.bulk(base, acts, "c_custkey", scripts=_MIXED_SCRIPTS)


@reg("w4_scripted_update", "WITH RECURSIVE " + _MIXED_SQL.strip() + """
SELECT id AS c_custkey, name AS c_name, nation AS c_nationkey, round(bal, 6) AS c_acctbal, seg AS c_mktsegment, ver AS _version FROM tab""")
def w4_scripted(spark, sf):
    return rnd(_mixed_bulk(spark, sf).table.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "_version"))


@reg("w5_w6_mixed_items", "WITH RECURSIVE " + _MIXED_SQL.strip() + """
SELECT * FROM items""")
def w5_mixed(spark, sf):
    return _mixed_bulk(spark, sf).items.select("seq", "id", "op", "status")


@reg("w7_update_by_query", """
SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'P')::BIGINT AS total,
       (SELECT count(*) FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority <> '1-URGENT')::BIGINT AS updated,
       (SELECT count(*) FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')::BIGINT AS noops,
       (SELECT count(*) FROM orders WHERE o_orderpriority = '1-URGENT' OR o_orderstatus = 'P')::BIGINT AS urgent_after""")
def w7_update(spark, sf):
    o = TB.read(spark, sf, "orders")
    new, rep = WR.update_by_query(o, "o_orderkey", Q.Term("o_orderstatus", "P"), {"o_orderpriority": "'1-URGENT'"})
    return rep.withColumn("urgent_after", new.filter(F.col("o_orderpriority") == "1-URGENT").select(F.count(F.lit(1))).scalar())


@reg("w7_update_conflicts", """
WITH moved AS (SELECT * FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 5 < 2)
SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'P')::BIGINT AS total,
       (SELECT count(*) FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 5 >= 2 AND o_orderpriority <> '1-URGENT')::BIGINT AS updated,
       (SELECT count(*) FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 5 >= 2 AND o_orderpriority = '1-URGENT')::BIGINT AS noops,
       (SELECT count(*) FROM moved)::BIGINT AS version_conflicts, true AS aborted""")
def w7_conflicts(spark, sf):
    """Between read and write, some documents get a new version and others are deleted."""
    o = TB.read(spark, sf, "orders").withColumn("_version", F.lit(1).cast("long"))
    now = o.where("o_orderkey % 5 <> 0").withColumn("_version", F.when(F.col("o_orderkey") % 5 == 1, 2).otherwise(1).cast("long"))
    args = (o, "o_orderkey", Q.Term("o_orderstatus", "P"), {"o_orderpriority": "'1-URGENT'"})
    _, rep = WR.update_by_query(*args, conflicts="proceed", current=now)
    try:
        WR.update_by_query(*args, current=now)
        aborted = False
    except WR.VersionConflict:
        aborted = True
    return rep.withColumn("aborted", F.lit(aborted))


@reg("w8_delete_by_query", """
SELECT (SELECT count(*) FROM orders WHERE o_totalprice < 50000)::BIGINT AS deleted,
       (SELECT count(*) FROM orders WHERE NOT (o_totalprice < 50000))::BIGINT AS remaining,
       (SELECT count(*) FROM (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 100))::BIGINT AS capped""")
def w8_delete(spark, sf):
    o = TB.read(spark, sf, "orders")
    new, rep = WR.delete_by_query(o, "o_orderkey", Q.Range("o_totalprice", lt=50000))
    _, rep2 = WR.delete_by_query(o, "o_orderkey", Q.Term("o_orderstatus", "F"), max_docs=100)
    return rep.withColumn("remaining", new.select(F.count(F.lit(1))).scalar()).withColumn("capped", rep2.select("deleted").scalar())


# ----------------------------------------------------------------------------- schema, typing, scripts

from docsift.functions import packing as PK  # noqa: E402
from docsift.functions.dates import parse_date  # noqa: E402
from docsift.functions.scripts import Script, register_script  # noqa: E402
from docsift.sources import schema as SCH  # noqa: E402

ORDER_DOC = SCH.Document({"o_orderkey": SCH.long().req(), "o_custkey": SCH.long(), "o_orderstatus": SCH.keyword(),
                          "o_totalprice": SCH.double(), "o_orderdate": SCH.FieldSpec("timestamp_ntz")})


@reg("a1_declared_schema", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, epoch_ms(o_orderdate) AS date_ms FROM orders""")
def a1_schema(spark, sf):
    df = spark.read.schema(ORDER_DOC.struct()).parquet(f"{sf}/orders.parquet")
    return df.withColumn("date_ms", F.unix_millis(F.col("o_orderdate").cast("timestamp"))).drop("o_orderdate")


EVENT_DOC = SCH.Document({"id": SCH.long().req(), "user": SCH.int_(), "amount": SCH.int_(),
                          "kind": SCH.keyword().with_default("none"), "tags": SCH.keyword().as_list()})


def _raw_events(spark, sf):
    e = TB.read(spark, sf, "events")
    return e.select(F.col("event_id").cast("string").alias("id"), F.col("user_id").alias("user"), F.col("value").alias("amount"),
                    F.when(F.col("event_type") != "view", F.col("event_type")).alias("kind"), F.col("event_type").alias("tags"),
                    F.lit("ignored").alias("unknown_field"))


@reg("a2_a3_conform_valid", """
SELECT event_id AS id, user_id::INT AS "user", value::INT AS amount, CASE WHEN event_type <> 'view' THEN event_type ELSE 'none' END AS kind,
       [event_type] AS tags FROM events WHERE value = floor(value)""")
def a2_valid(spark, sf):
    ok, _ = SCH.conform(_raw_events(spark, sf), EVENT_DOC)
    return ok


@reg("a2_a3_conform_rejected", """
SELECT event_id::VARCHAR AS id, 'amount: not a valid int: ' || value::VARCHAR AS _reason FROM events WHERE value <> floor(value)""")
def a2_rejected(spark, sf):
    _, bad = SCH.conform(_raw_events(spark, sf), EVENT_DOC)
    return bad.select("id", "_reason")


NESTED_DOC = SCH.Document({"o_orderkey": SCH.long().req(), "customer": SCH.obj(SCH.Document({"id": SCH.int_().req(), "tier": SCH.keyword().with_default("basic")})),
                           "items": SCH.nested(SCH.Document({"line": SCH.short(), "quantity": SCH.int_().req(), "flags": SCH.keyword().as_list()}))})


def _nested_raw(spark, sf):
    o = TB.orders_nested(spark, sf, ("quantity", "returnflag"))
    items = F.transform("items", lambda x: F.struct(F.col("o_orderkey").alias("ignored"), x["line"].cast("string").alias("line"),
                                                    F.when(x["quantity"] < 50, x["quantity"]).alias("quantity"), x["returnflag"].alias("flags")))
    return o.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), F.struct(F.col("o_custkey").cast("string").alias("id")).alias("customer"), items.alias("items"))


@reg("a2_conform_nested_valid", """
WITH i AS (SELECT l_orderkey, list({'line': l_linenumber::SMALLINT, 'quantity': l_quantity::INT, 'flags': [l_returnflag]}
                  ORDER BY l_linenumber, l_quantity, l_returnflag) AS items, max(l_quantity) AS q FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_custkey AS customer_id, 'basic' AS tier, list_sum(list_transform(items, lambda x: x.line::BIGINT))::BIGINT AS lines,
       list_sum(list_transform(items, lambda x: x.quantity::BIGINT))::BIGINT AS quantity, len(items)::INT AS n
FROM orders LEFT JOIN i ON l_orderkey = o_orderkey WHERE coalesce(q, 0) < 50""")
def a2_nested(spark, sf):
    ok, _ = SCH.conform(_nested_raw(spark, sf), NESTED_DOC)
    total = lambda c: F.aggregate(F.transform("items", lambda x: x[c].cast("long")), F.lit(0).cast("long"), lambda a, b: a + b)
    return ok.select("o_orderkey", F.col("customer.id").alias("customer_id"), F.col("customer.tier").alias("tier"), total("line").alias("lines"),
                     total("quantity").alias("quantity"), F.when(F.col("items").isNotNull(), F.size("items")).alias("n"))


@reg("a2_conform_nested_rejected", """
SELECT o_orderkey::VARCHAR AS o_orderkey, count(*)::INT AS bad_items FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_quantity >= 50 GROUP BY 1""")
def a2_nested_bad(spark, sf):
    _, bad = SCH.conform(_nested_raw(spark, sf), NESTED_DOC)
    return bad.select("o_orderkey", F.size(F.split("_reason", "; ")).alias("bad_items"))


@reg("a4_flexible_dates", """
SELECT event_id, epoch_us(ts) // 1000 - 7200000 AS t_zone, epoch_ms(date_trunc('month', ts)) AS t_month,
       epoch_ms(date_trunc('year', ts)) AS t_year, epoch_us(ts) // 1000 AS t_epoch, true AS rejects_month_13
FROM events""")
def a4_dates(spark, sf):
    e = TB.read(spark, sf, "events")
    ts = F.col("ts").cast("timestamp")
    return e.select(
        "event_id",
        F.unix_millis(parse_date(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'"))).alias("t_zone"),
        F.unix_millis(parse_date(F.date_format(ts, "yyyy-MM"))).alias("t_month"),
        F.unix_millis(parse_date(F.date_format(ts, "yyyy"))).alias("t_year"),
        F.unix_millis(parse_date(F.unix_millis(ts).cast("string"))).alias("t_epoch"),
        parse_date(F.lit("2015-13")).isNull().alias("rejects_month_13"))


_STATUS = {"F": 0, "O": 1, "P": 2}


@reg("a5_enum_both_ways", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS status_id,
       o_orderstatus AS status_back FROM orders""")
def a5_enum(spark, sf):
    o = TB.read(spark, sf, "orders")
    enc = SCH.enum_encode(F.col("o_orderstatus"), _STATUS, on_unknown="error")
    return o.select("o_orderkey", enc.alias("status_id"), SCH.enum_decode(enc, _STATUS).alias("status_back"))


@reg("a6_schemaless_path", """
SELECT event_id, json_extract(props, '$.k')::INT AS k, json_extract(props, '$.k')::INT + 1 AS k_set FROM events""")
def a6_dyn(spark, sf):
    e = TB.read(spark, sf, "events")
    k = SCH.dyn_get(F.col("props"), "k", "int")
    d = e.select("event_id", k.alias("k"), F.struct(F.col("event_id").alias("id")).alias("doc"))
    d = SCH.dyn_set(d, "doc", "meta.k", F.col("k") + 1)
    return d.select("event_id", "k", F.col("doc.meta.k").alias("k_set"))


@reg("a6_schemaless_set", """
SELECT event_id, json_extract(props, '$.k')::INT AS k, event_type AS kind, value::DOUBLE AS amount, user_id::BIGINT AS "user" FROM events""")
def a6_set(spark, sf):
    e = TB.read(spark, sf, "events")
    for path, value in (("meta.kind", F.col("event_type")), ("meta.deep.amount", F.col("value")), ("meta.kind", F.upper("event_type")),
                        ("meta.kind", F.col("event_type")), ("user", F.col("user_id"))):
        e = SCH.dyn_set(e, "props", path, value)
    return e.select("event_id", *(SCH.dyn_get(F.col("props"), p, t).alias(n) for n, p, t in (
        ("k", "k", "int"), ("kind", "meta.kind", "string"), ("amount", "meta.deep.amount", "double"), ("user", "user", "bigint"))))


@reg("a7_merge_documents", """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation, round(c_acctbal, 6) AS acctbal, c_mktsegment AS segment,
       'customer' AS _kind FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal, 6), NULL, 'supplier' FROM supplier""")
def a7_merge(spark, sf):
    c = TB.read(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"),
                                              F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    s = TB.read(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"),
                                              F.col("s_acctbal").alias("acctbal"))
    return rnd(SCH.merge_documents({"customer": c, "supplier": s}))


@reg("a8_name_pattern_templates", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::VARCHAR AS l_linenumber, l_quantity::INT AS l_quantity,
       round(l_extendedprice, 6) AS l_extendedprice, round(l_discount::FLOAT::DOUBLE, 6) AS l_discount, round(l_tax::FLOAT::DOUBLE, 6) AS l_tax, l_returnflag, l_linestatus, l_shipdate::DATE AS l_shipdate
FROM lineitem""")
def a8_templates(spark, sf):
    rules = [SCH.Template("int", match="*_quantity"), SCH.Template("date", match="l_ship*", match_mapping_type="date"),
             SCH.Template("float", match="l_(tax|discount)", match_pattern="regex"),
             SCH.Template("string", match="l_*", unmatch="l_*key", match_mapping_type="long")]
    return rnd(SCH.apply_templates(TB.read(spark, sf, "lineitem"), rules))


@reg("a9_select_kind", f"""
SELECT 'l' || {L_ID} AS _id, l_orderkey AS o_orderkey, l_quantity FROM lineitem""")
def a9_kind(spark, sf):
    kinds = SCH.select_kind(TB.order_family(spark, sf), {"order": ["_id", "o_totalprice"], "line": ["_id", "o_orderkey", "l_quantity"]})
    return kinds["line"]


@reg("a10_runtime_field", """
SELECT dayname(o_orderdate) AS dow, count(*)::BIGINT AS doc_count FROM orders GROUP BY 1""")
def a10_runtime(spark, sf):
    s = Search(TB.read(spark, sf, "orders"), "o_orderkey").runtime_field("dow", "date_format(o_orderdate, 'EEEE')", "string").aggs(
        dow=A.TermsAgg("dow", size=None))
    return s.aggregations()["dow"]


@reg("a11_attribute_packing", """
SELECT p_partkey, [(1::BIGINT << 32) | p_size, (2::BIGINT << 32) | CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INT)] AS packed,
       [1, 2] AS attr_ids, [p_size::BIGINT, CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS BIGINT)] AS values,
       (5::BIGINT << 1) | (p_size > 25)::INT AS bool_packed
FROM part""")
def a11_packing(spark, sf):
    pa = TB.part_attrs(spark, sf)
    packed = F.transform("attrs", lambda a: PK.encode_attr(a["attr_id"], a["value"]))
    return pa.select("p_partkey", packed.alias("packed"), F.transform(packed, PK.decode_attr_id).alias("attr_ids"),
                     F.transform(packed, PK.decode_attr_value).alias("values"),
                     PK.encode_bool_attr(F.lit(5), F.col("p_size") > 25).alias("bool_packed"))


@reg("a11_float_attribute_packing", """
SELECT p_partkey, (5::BIGINT * 4294967296 + CAST(p_retailprice::FLOAT::BIT AS INTEGER))::BIGINT AS packed, 5 AS attr_id,
       p_retailprice::FLOAT AS value, TRUE AS roundtrip FROM part""")
def a11_float(spark, sf):
    pa = TB.part_attrs(spark, sf)
    packed = PK.encode_range_attr(F.lit(5), F.col("p_retailprice"))
    aid, val = PK.decode_range_attr(packed)
    return pa.select("p_partkey", packed.alias("packed"), aid.alias("attr_id"), val.alias("value"),
                     (val == F.col("p_retailprice").cast("float")).alias("roundtrip"))


@reg("u1_inline_script_params", """
SELECT p_partkey, round(p_retailprice * 2 + 1, 6) AS price2 FROM part""")
def u1_script(spark, sf):
    s = (Search(TB.read(spark, sf, "part"), "p_partkey").size(None)
         .script_field("price2", Script("p_retailprice * params.factor + params.add", params={"factor": 2, "add": 1})))
    return rnd(s.hits().select("p_partkey", "price2"))


def _name_len():
    return F.length("p_name")


register_script("discounted", "p_retailprice * (1 - params.d)")
register_script("name_len", _name_len)


@reg("u2_stored_scripts", """
SELECT p_partkey, round(p_retailprice * (1 - 0.1), 6) AS disc, length(p_name)::INTEGER AS name_len FROM part""")
def u2_stored(spark, sf):
    s = (Search(TB.read(spark, sf, "part"), "p_partkey").size(None)
         .script_field("disc", Script(id="discounted", params={"d": 0.1})).script_field("name_len", Script(id="name_len")))
    return rnd(s.hits().select("p_partkey", "disc", "name_len"))


# ----------------------------------------------------------------------------- streaming

from docsift.session import checkpoint_dir  # noqa: E402
from docsift.streaming.bulk_stream import run_bulk_stream  # noqa: E402
from docsift.streaming.histogram import run_upserts, stream_date_histogram  # noqa: E402


@reg("t1_stream_date_histogram", """
SELECT (epoch_ms(ts) // 21600000) * 21600000 AS key, count(*)::BIGINT AS doc_count FROM events GROUP BY 1""")
def t1_stream(spark, sf):
    schema = TB.read(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    h = stream_date_histogram(stream, "ts", "6 hours", "1 day")
    return run_upserts(h, ["key"]).select("key", "doc_count")


@reg("t2_bulk_action_stream", SQL["w1_w4_bulk_table"])
def t2_bulk_stream(spark, sf):
    import uuid

    root = f"{checkpoint_dir(spark)}/actions-{uuid.uuid4().hex}"
    acts = TB.customer_actions(spark, sf)
    bounds = acts.select(F.min("seq"), F.max("seq")).first()  # two scalars: split points of the staged files
    lo, hi = int(bounds[0]), int(bounds[1])
    step = (hi - lo) // 3 + 1
    stream = lambda: spark.readStream.schema(acts.schema).option("recursiveFileLookup", "true").parquet(f"{root}/in")
    base = TB.read(spark, sf, "customer")
    for i in range(3):  # actions arrive in three parts, each consumed by its own availableNow run
        acts.filter((F.col("seq") >= lo + i * step) & (F.col("seq") < lo + (i + 1) * step)).write.mode("overwrite").parquet(f"{root}/in/part{i}")
        table, _ = run_bulk_stream(base, stream(), "c_custkey", out_dir=f"{root}/out")
    return rnd(table)


# ----------------------------------------------------------------------------- more variants


@reg("e17_significant_terms_under_bucket", """
WITH b AS (SELECT l_returnflag AS flag, l_suppkey AS k FROM lineitem WHERE l_discount >= 0.08),
bg AS (SELECT l_suppkey AS k, count(*) AS bg_count FROM lineitem GROUP BY 1),
bgt AS (SELECT count(*)::DOUBLE AS bgt FROM lineitem),
fgt AS (SELECT flag, count(*)::DOUBLE AS fgt FROM b GROUP BY 1),
g AS (SELECT flag, k, count(*)::BIGINT AS doc_count FROM b GROUP BY 1, 2),
s AS (SELECT g.flag, g.k AS sig, doc_count, bg_count::BIGINT AS bg_count,
        ((doc_count / fgt) - (bg_count / bgt)) * ((doc_count / fgt) / (bg_count / bgt)) AS sc
      FROM g JOIN fgt USING (flag) JOIN bg USING (k), bgt WHERE doc_count / fgt > bg_count / bgt AND doc_count >= 3)
SELECT flag, sig, doc_count, bg_count, round(sc, 6) AS score FROM s
QUALIFY row_number() OVER (PARTITION BY flag ORDER BY sc DESC, sig) <= 5""")
def e17_sig_nested(spark, sf):
    s = Search(lineitem(spark, sf), "l_id").query(Q.Range("l_discount", gte=0.08)).aggs(
        flag=A.TermsAgg("l_returnflag", aggs={"sig": A.SignificantTerms("l_suppkey", size=5)}))
    return rnd(s.aggregations()["flag>sig"])


@reg("w5_seq_no_conditions", """
WITH a AS (SELECT c_custkey AS seq, c_custkey % 500 AS id,
             CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 500 + 1 ELSE c_custkey % 500 END AS if_seq_no FROM customer),
m AS (SELECT a.*, (b.c_custkey IS NOT NULL AND if_seq_no = b.c_custkey) AS matches FROM a LEFT JOIN customer b ON b.c_custkey = a.id),
r AS (SELECT *, sum(matches::INT) OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM m)
SELECT seq, id, CASE WHEN matches AND coalesce(prev, 0) = 0 THEN 'updated' ELSE 'conflict' END AS status FROM r""")
def w5_seq_no(spark, sf):
    c = TB.read(spark, sf, "customer")
    base = c.withColumn("_seq_no", F.col("c_custkey")).withColumn("_primary_term", F.lit(1).cast("long"))
    k = F.col("c_custkey")
    acts = c.select(k.alias("seq"), F.lit("update").alias("op"), (k % 500).alias("id"),
                    F.struct(F.lit(None).cast("string").alias("c_name"), F.lit(None).cast("int").alias("c_nationkey"),
                             (F.col("c_acctbal") + 1).alias("c_acctbal"), F.lit(None).cast("string").alias("c_mktsegment")).alias("doc"),
                    F.when(k % 3 == 0, k % 500 + 1).otherwise(k % 500).alias("if_seq_no"), F.lit(1).cast("long").alias("if_primary_term"))
    return WR.bulk(base, acts, "c_custkey").items.select("seq", "id", "status")


_MIP = f"CASE WHEN {_DOT} < 0 THEN 1.0 / (1.0 - {_DOT}) ELSE {_DOT} + 1.0 END"


@reg("r14_knn_dot_and_max_inner_product", f"""
SELECT * FROM (SELECT 'dot_product' AS kind, vec_id, round((1 + {_DOT}) / 2, 6) AS _score FROM embeddings ORDER BY (1 + {_DOT}) / 2 DESC, vec_id LIMIT 20)
UNION ALL
SELECT * FROM (SELECT 'max_inner_product', vec_id, round({_MIP}, 6) FROM embeddings ORDER BY {_MIP} DESC, vec_id LIMIT 20)""")
def r14_dot(spark, sf):
    out = None
    for kind in ("dot_product", "max_inner_product"):
        s = Search(TB.read(spark, sf, "embeddings"), "vec_id").knn(Knn("embedding", QV, k=20, similarity=kind)).size(20)
        hits = s.hits().select(F.lit(kind).alias("kind"), "vec_id", "_score")
        out = hits if out is None else out.unionByName(hits)
    return rnd(out)


@reg("r14_knn_similarity_threshold", f"""
SELECT * FROM (SELECT 'l2_norm' AS kind, vec_id, round(1 / (1 + {_L2}), 6) AS _score FROM embeddings WHERE sqrt({_L2}) <= 4.7 ORDER BY 1 / (1 + {_L2}) DESC, vec_id LIMIT 200000)
UNION ALL
SELECT * FROM (SELECT 'dot_product', vec_id, round((1 + {_DOT}) / 2, 6) FROM embeddings WHERE {_DOT} >= 0.1 ORDER BY (1 + {_DOT}) / 2 DESC, vec_id LIMIT 200000)""")
def r14_threshold(spark, sf):
    out = None
    for kind, bound in (("l2_norm", 4.7), ("dot_product", 0.1)):
        k = Knn("embedding", QV, k=200_000, similarity=kind, min_similarity=bound)
        hits = Search(TB.read(spark, sf, "embeddings"), "vec_id").knn(k).size(None).hits().select(F.lit(kind).alias("kind"), "vec_id", "_score")
        out = hits if out is None else out.unionByName(hits)
    return rnd(out)


@reg("r15_knn_query_linf", f"""
SELECT vec_id, round(1.0 / (1.0 + list_max(list_transform(list_zip({_E}, {_QV_SQL}), lambda x: abs(x[1] - x[2])))), 6) AS _score
FROM embeddings ORDER BY list_max(list_transform(list_zip({_E}, {_QV_SQL}), lambda x: abs(x[1] - x[2]))), vec_id LIMIT 8""")
def r15_linf(spark, sf):
    q = KnnQuery("embedding", QV, k=8, space="linf")
    return _scored(Search(TB.read(spark, sf, "embeddings"), "vec_id").query(q).size(8).hits().select("vec_id", "_score"))


@reg("p13_multi_match_phrase_prefix", f"""
SELECT p_partkey, round(CASE WHEN a.nhit > 0 THEN a.s ELSE 0 END, 6) AS _score
FROM part JOIN {bm25_sql('part', 'p_partkey', 'p_name', ['red'])} a ON a.id = p_partkey
WHERE regexp_matches(lower(p_name), '(^|[^a-z0-9])red[^a-z0-9]+gea')""")
def p13_prefix(spark, sf):
    q = Q.MultiMatch("red gea", ["p_name", "p_type"], type="phrase_prefix")
    return _scored(Search(TB.read(spark, sf, "part"), "p_partkey").query(q).matched().select("p_partkey", "_score"))


@reg("e18_histogram_extended_bounds", """
WITH k AS (SELECT floor(l_quantity / 10) * 10 AS q, count(*) AS n FROM lineitem GROUP BY 1)
SELECT g.q::DOUBLE AS q, coalesce(n, 0)::BIGINT AS doc_count FROM (SELECT unnest(generate_series(-20, 80, 10)) AS q) g LEFT JOIN k USING (q)""")
def e18_ext(spark, sf):
    s = Search(lineitem(spark, sf), "l_id").aggs(q=A.Histogram("l_quantity", interval=10, min_doc_count=0, extended_bounds=(-20, 80)))
    return s.aggregations()["q"]


@reg("e18_histogram_hard_bounds", """
SELECT floor(l_quantity / 5) * 5 AS q, count(*)::BIGINT AS doc_count FROM lineitem
WHERE floor(l_quantity / 5) * 5 BETWEEN 10 AND 30 GROUP BY 1""")
def e18_hard(spark, sf):
    s = Search(lineitem(spark, sf), "l_id").aggs(q=A.Histogram("l_quantity", interval=5, min_doc_count=1, hard_bounds=(10, 30)))
    return s.aggregations()["q"]


@reg("e19_date_histogram_offset", """
SELECT epoch_ms(date_trunc('day', ts - INTERVAL 6 HOUR)) + 21600000 AS d, count(*)::BIGINT AS doc_count,
       strftime(date_trunc('day', ts - INTERVAL 6 HOUR) + INTERVAL 6 HOUR, '%Y-%m-%dT%H:%M:%S.000Z') AS d_as_string
FROM events GROUP BY 1, 3""")
def e19_offset(spark, sf):
    s = Search(TB.read(spark, sf, "events"), "event_id").aggs(d=A.DateHistogram("ts", calendar_interval="day", offset_ms=6 * 3600 * 1000))
    return s.aggregations()["d"]


@reg("e14_terms_missing_and_key_order", """
SELECT coalesce(l.quality, -1) AS q, count(*)::BIGINT AS doc_count FROM documents d LEFT JOIN labels l USING (doc_id)
GROUP BY 1 ORDER BY q DESC LIMIT 2""")
def e14_missing(spark, sf):
    s = Search(TB.docs_labelled(spark, sf), "doc_id").aggs(q=A.TermsAgg("quality", missing=-1, size=2, order=(("_key", "desc"),)))
    return s.aggregations()["q"]


@reg("e10_percentiles_default", """
SELECT unnest([1.0, 5.0, 25.0, 50.0, 75.0, 95.0, 99.0])::DOUBLE AS percent, TRUE AS within_rank_error""")
def e10_default(spark, sf):
    """The default sketch: each percentile's true rank lies within the promised error (1 / 10,000 of the rows)."""
    orders = TB.read(spark, sf, "orders")
    found = Search(orders, "o_orderkey").aggs(p=A.Percentiles("o_totalprice")).aggregations()["p"]
    price, cols = F.col("o_totalprice"), []
    for p in A.DEFAULT_PERCENTS:
        value = found.select("p_" + A.pct_name(p)).scalar()
        cols.append(F.struct(F.lit(p).alias("percent"), F.count_if(price <= value).alias("upto"), F.count_if(price < value).alias("below")))
    counts = orders.agg(F.count(price).alias("n"), F.array(*cols).alias("c")).select("n", F.inline("c"))
    target, error = F.col("percent") / 100 * F.col("n"), F.col("n") / 10000 + 1
    return counts.select("percent", ((F.col("upto") >= target - error) & (F.col("below") <= target + error)).alias("within_rank_error"))


_PARTIALS: dict = {}


def _order_partials(spark, sf):
    from docsift.operators.partials import Partials

    key = (spark.sparkContext.applicationId, sf)
    if key not in _PARTIALS:
        _PARTIALS[key] = Partials.build(TB.read(spark, sf, "orders"), ["o_orderstatus"], "o_orderdate", ["o_totalprice", "o_custkey"], unit="month")
    return _PARTIALS[key]


@reg("e8_e9_from_partials", """
SELECT o_orderstatus, count(*)::BIGINT AS p_count, min(o_totalprice) AS p_min, max(o_totalprice) AS p_max, round(avg(o_totalprice), 6) AS p_avg,
       round(sum(o_totalprice), 4) AS p_sum, round(var_pop(o_totalprice), 2) AS p_variance, round(stddev_pop(o_totalprice), 6) AS p_std_deviation
FROM orders WHERE o_orderdate >= TIMESTAMP '1993-03-01' GROUP BY 1""")
def e8_partials(spark, sf):
    since = F.col("period") >= F.lit("1993-03-01").cast("timestamp")
    out = _order_partials(spark, sf).stats(["o_orderstatus"], "o_totalprice", name="p", where=since)
    return out.select("o_orderstatus", "p_count", "p_min", "p_max", F.round("p_avg", 6).alias("p_avg"), F.round("p_sum", 4).alias("p_sum"),
                      F.round("p_variance", 2).alias("p_variance"), F.round("p_std_deviation", 6).alias("p_std_deviation"))


@reg("e7_e10_e11_from_partials", """
SELECT unnest(['p_1', 'p_5', 'p_25', 'p_50', 'p_75', 'p_95', 'p_99', 'deviation', 'cardinality']) AS measure, TRUE AS within_error""")
def e10_partials(spark, sf):
    """Merged over all months and states: ranks within twice the sketch's published error, distinct values within 5 percent."""
    from docsift.operators.partials import rank_error

    orders, parts = TB.read(spark, sf, "orders"), _order_partials(spark, sf)
    price, cols = F.col("o_totalprice"), []
    found = parts.percentiles([], "o_totalprice", name="p")
    for p in A.DEFAULT_PERCENTS:
        value = found.select("p_" + A.pct_name(p)).scalar()
        cols.append(F.struct(F.lit("p_%g" % p).alias("measure"), F.lit(p / 100).alias("share"), F.count_if(price <= value).alias("upto"), F.count_if(price < value).alias("below")))
    median = orders.select(F.median(price)).scalar()
    away, value = F.abs(price - median), parts.deviation([], "o_totalprice", name="d").select("d").scalar()
    cols.append(F.struct(F.lit("deviation").alias("measure"), F.lit(0.5).alias("share"), F.count_if(away <= value).alias("upto"), F.count_if(away < value).alias("below")))
    counts = orders.agg(F.count(price).alias("n"), F.array(*cols).alias("c")).select("n", F.inline("c"))
    error = F.col("n") * (2 * rank_error() + F.when(F.col("measure") == "deviation", 2 * rank_error() + 0.002).otherwise(0.0)) + 1
    ranks = counts.select("measure", ((F.col("upto") >= F.col("share") * F.col("n") - error) & (F.col("below") <= F.col("share") * F.col("n") + error)).alias("within_error"))
    exact = orders.select(F.count_distinct("o_custkey")).scalar()
    return ranks.union(parts.cardinality([], "o_custkey", name="c").select(F.lit("cardinality"), F.abs(F.col("c") - exact) <= 0.05 * exact))


@reg("e19_date_histogram_bounds", """
WITH k AS (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders
           WHERE date_trunc('month', o_orderdate) BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31' GROUP BY 1),
g AS (SELECT unnest(generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '1996-12-01', INTERVAL 1 MONTH)) AS m)
SELECT epoch_ms(g.m) AS mon, coalesce(n, 0)::BIGINT AS doc_count, strftime(g.m, '%Y-%m-%dT%H:%M:%S.000Z') AS mon_as_string
FROM g LEFT JOIN k USING (m)""")
def e19_bounds(spark, sf):
    s = Search(TB.read(spark, sf, "orders"), "o_orderkey").aggs(mon=A.DateHistogram(
        "o_orderdate", calendar_interval="month", min_doc_count=0, extended_bounds=("1995-10-15", "1996-03"),
        hard_bounds=("1996-01-01", "1996-12-31")))
    return s.aggregations()["mon"]


@reg("e14_terms_min_doc_count_zero", """
SELECT p_brand AS brand, count(p.p_partkey)::BIGINT AS doc_count
FROM (SELECT DISTINCT p_brand FROM part) b LEFT JOIN part p USING (p_brand) WHERE p.p_size IS NULL OR p.p_size > 48 GROUP BY 1
UNION ALL SELECT DISTINCT p_brand, 0::BIGINT FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size > 48)""")
def e14_zero(spark, sf):
    s = Search(TB.read(spark, sf, "part"), "p_partkey").filter(Q.Range("p_size", gt=48)).aggs(
        brand=A.TermsAgg("p_brand", size=None, min_doc_count=0))
    return s.aggregations()["brand"]


@reg("r1_bm25_with_stored_statistics", SQL["p11_r1_match_bm25"])
def r1_stored_stats(spark, sf):
    """BM25 with collection statistics built once and stored in the shared folder."""
    import uuid

    from docsift.functions.text import collection_stats
    docs = TB.read(spark, sf, "documents")
    path = f"{checkpoint_dir(spark)}/text-stats-{uuid.uuid4().hex}"
    collection_stats(docs, "text").write.mode("overwrite").parquet(path)
    stats = spark.read.parquet(path)
    s = Search(docs, "doc_id").with_text_stats("text", stats).query(Q.Match("text", "Und der XYLOPHON!"))
    return _scored(s.matched().select("doc_id", "_score"))


@reg("s12_multi_search_one_pass", f"""
WITH t AS (SELECT id, s FROM {bm25_sql('documents', 'doc_id', 'text', ['the', 'and'])} WHERE nhit > 0),
u AS (SELECT id, s FROM {bm25_sql('documents', 'doc_id', 'text', ['und'])} WHERE nhit > 0)
SELECT * FROM (SELECT 0 AS query_id, id AS doc_id, round(s, 6) AS _score FROM t ORDER BY s DESC, id LIMIT 6 OFFSET 2)
UNION ALL SELECT * FROM (SELECT 1, id, round(s, 6) FROM u ORDER BY s DESC, id LIMIT 4)
UNION ALL SELECT * FROM (SELECT 2, doc_id, NULL::DOUBLE FROM documents WHERE lang = 'en' ORDER BY n_chars DESC, doc_id LIMIT 5)""")
def s12_one_pass(spark, sf):
    from docsift.plans.search import multi_search
    d = _docs(spark, sf).source("doc_id")
    found = multi_search([d.query(Q.Match("text", "the and")).size(6).offset(2), d.query(Q.Match("text", "und")).size(4),
                          d.filter(Q.Term("lang", "en")).sort("-n_chars").size(5)])
    return _scored(found.select("query_id", "doc_id", "_score"))


_VECTORS: dict = {}


@reg("r14_knn_vector_index", f"""
SELECT * FROM (SELECT 'l2' AS kind, vec_id, round(1.0 / (1.0 + {_L2}), 6) AS _score FROM embeddings ORDER BY {_L2}, vec_id LIMIT 12)
UNION ALL SELECT * FROM (SELECT 'cosine', vec_id, round((1 + {_DOT} / ({_NORM} * {_QN!r})) / 2, 6) FROM embeddings ORDER BY {_DOT} / {_NORM} DESC, vec_id LIMIT 12)""")
def r14_index(spark, sf):
    """As many candidates as there are vectors: every list is read, and the exact scores decide."""
    from docsift.operators.vector_index import VectorIndex

    e = TB.read(spark, sf, "embeddings")
    key = (spark.sparkContext.applicationId, sf)
    if key not in _VECTORS:
        _VECTORS[key] = VectorIndex.build(e, "vec_id", "embedding")
    s = Search(e, "vec_id").with_vector_index("embedding", _VECTORS[key]).size(12)
    every = int(_VECTORS[key].sizes.sum())
    parts = [s.knn(Knn("embedding", QV, k=12, num_candidates=every, similarity=name)).hits().select(F.lit(kind).alias("kind"), "vec_id", "_score")
             for kind, name in (("l2", "l2_norm"), ("cosine", "cosine"))]
    return _scored(parts[0].union(parts[1]))


# ----------------------------------------------------------------------------- postings

from docsift.operators.text_index import TextIndex  # noqa: E402

_INDEXES: dict = {}


def _text_index(spark, sf, view: str, docs) -> TextIndex:
    """Postings of ``text``, built once per application, input and view."""
    key = (spark.sparkContext.applicationId, sf, view)
    if key not in _INDEXES:
        _INDEXES[key] = TextIndex.build(docs, "doc_id", "text")
    return _INDEXES[key]


def _indexed_docs(spark, sf) -> Search:
    return _docs(spark, sf).with_text_index("text", _text_index(spark, sf, "documents", TB.read(spark, sf, "documents")), whole=True)


@reg("p11_postings_match_bm25", SQL["p11_r1_match_bm25"])
def p11_postings(spark, sf):
    return _scored(_indexed_docs(spark, sf).query(Q.Match("text", "Und der XYLOPHON!")).matched().select("doc_id", "_score"))


@reg("p11_postings_match_msm", SQL["p11_match_msm"])
def p11_postings_msm(spark, sf):
    return _scored(_indexed_docs(spark, sf).query(Q.Match("text", "the of und la", minimum_should_match="75%")).matched().select("doc_id", "_score"))


@reg("p12_postings_phrase", SQL["p12_match_phrase"])
def p12_postings(spark, sf):
    return _scored(_indexed_docs(spark, sf).query(Q.MatchPhrase("text", "of the")).matched().select("doc_id", "_score"))


@reg("p12_postings_phrase_slop", SQL["p12_match_phrase_slop"])
def p12_postings_slop(spark, sf):
    return _scored(_indexed_docs(spark, sf).query(Q.MatchPhrase("text", "the and", slop=2)).matched().select("doc_id", "_score"))


@reg("r11_postings_rescore", SQL["r11_rescore"])
def r11_postings(spark, sf):
    s = _indexed_docs(spark, sf).query(Q.Match("text", "the")).rescore(
        Rescore(Q.MatchPhrase("text", "of the"), window_size=30, rescore_query_weight=2.0)).size(15)
    return _scored(s.hits().select("doc_id", "_score"))


@reg("r16_postings_hybrid", SQL["r16_hybrid_knn_text"])
def r16_postings(spark, sf):
    docs = TB.doc_vectors(spark, sf)
    s = Search(docs, "doc_id").with_text_index("text", _text_index(spark, sf, "doc_vectors", docs)).query(Q.Match("text", "und der"))
    return _scored(s.knn(Knn("embedding", QV, k=10)).size(20).hits().select("doc_id", "_score"))


@reg("r1_postings_top_k", f"""
SELECT id AS doc_id, round(s, 6) AS _score FROM {bm25_sql('documents', 'doc_id', 'text', ['the', 'und', 'la'])} WHERE nhit >= 1 ORDER BY s DESC, id LIMIT 25""")
def r1_postings_top(spark, sf):
    return _scored(_indexed_docs(spark, sf).query(Q.Match("text", "the und la")).size(25).hits().select("doc_id", "_score"))


@reg("f7_simple_expression_filter", """
SELECT (SELECT count(*) FROM part WHERE p_retailprice < 930 OR p_retailprice >= 960)::BIGINT AS total_union,
       (SELECT count(*) FROM part WHERE p_retailprice >= 930 AND p_size > 25)::BIGINT AS total_intersect""")
def f7_simple(spark, sf):
    part = TB.read(spark, sf, "part")
    bands = {"cheap": Q.Range("p_retailprice", lt=930), "dear": Q.Range("p_retailprice", gte=960),
             "notcheap": Q.Range("p_retailprice", gte=930), "big": Q.Range("p_size", gt=25)}
    union = FC.QueryFilters([FC.SimpleExpressionsFilter("band", bands)]).apply(Search(part, "p_partkey"), {"band": ["cheap", "dear"]})
    inter = FC.QueryFilters([FC.SimpleExpressionsFilter("band", bands, mode=FC.INTERSECT)]).apply(
        Search(part, "p_partkey"), {"band": ["notcheap", "big", "unknown"]})
    return union.total.select(F.col("total").alias("total_union"), inter.total.select("total").scalar().alias("total_intersect"))
