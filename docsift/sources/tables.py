"""Readers for the test tables and the derived document views.

Tables are Parquet; ``read`` never infers anything and lets Catalyst prune
columns and push filters into the scan.  Derived views re-shape the relational
tables into the document model the operators work on (nested arrays,
attribute arrays, parent/child families, range-typed fields).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The table names of the test data set.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# Item struct fields of the nested orders view and their source columns.
ITEM_FIELDS = {"line": "l_linenumber", "product_id": "l_partkey", "quantity": "l_quantity", "price": "l_extendedprice",
               "discount": "l_discount", "returnflag": "l_returnflag", "shipdate": "l_shipdate"}


def orders_nested(spark: SparkSession, sf_dir: str, item_fields: tuple | None = None) -> DataFrame:
    """orders + ``items``: array of line structs sorted by line number.

    This is the nested-document model itself (one document holds its lines);
    the aggregation is a partial+final ``collect_list`` keyed by order.
    ``item_fields`` limits the struct to the fields a query reads (fields
    inside a collected struct are not pruned by the optimizer)."""
    li = read(spark, sf_dir, "lineitem")
    names = ["line"] + [f for f in (item_fields or ITEM_FIELDS) if f != "line"]
    items = li.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct(*[F.col(ITEM_FIELDS[n]).alias(n) for n in names]))).alias("items"))
    o = read(spark, sf_dir, "orders")
    return o.join(items, o.o_orderkey == items.l_orderkey, "left").drop("l_orderkey")


def line_id():
    """Unique line key: order, line number, part, supplier and quantity (the
    (order, line number) pair alone repeats in the data)."""
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"),
                       F.col("l_suppkey").cast("string"), F.col("l_quantity").cast("bigint").cast("string"))


def brand_number(c):
    return F.regexp_extract(c, r"(\d+)$", 1).cast("int")


def part_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part + select attributes [(1, p_size), (2, brand number)] and range
    attributes [(5, p_retailprice as float)]."""
    p = read(spark, sf_dir, "part")
    return p.select(
        "*",
        F.array(F.struct(F.lit(1).alias("attr_id"), F.col("p_size").alias("value")),
                F.struct(F.lit(2).alias("attr_id"), brand_number(F.col("p_brand")).alias("value"))).alias("attrs"),
        F.array(F.struct(F.lit(5).alias("attr_id"), F.col("p_retailprice").cast("float").alias("value"))).alias("range_attrs"),
    )


def label_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lb = read(spark, sf_dir, "labels")
    return lb.select("*", F.array(
        F.struct(F.lit(1).alias("attr_id"), (F.col("quality") == 1).alias("value")),
        F.struct(F.lit(2).alias("attr_id"), (F.col("toxic") == 1).alias("value"))).alias("bool_attrs"))


def docs_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    lb = read(spark, sf_dir, "labels")
    return d.join(lb, "doc_id", "left")


def order_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One collection holding orders (join.name = 'order') and their lines
    (join.name = 'line', join.parent = order id).  ``_id`` is a string."""
    o = read(spark, sf_dir, "orders")
    li = read(spark, sf_dir, "lineitem")
    parents = o.select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("_id"),
        F.struct(F.lit("order").alias("name"), F.lit(None).cast("string").alias("parent")).alias("join"),
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        F.lit(None).cast("double").alias("l_quantity"), F.lit(None).cast("double").alias("l_extendedprice"),
        F.lit(None).cast("string").alias("l_returnflag"))
    children = li.select(
        F.concat(F.lit("l"), line_id()).alias("_id"),
        F.struct(F.lit("line").alias("name"), F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("parent")).alias("join"),
        F.col("l_orderkey").alias("o_orderkey"), F.lit(None).cast("string").alias("o_orderstatus"),
        F.lit(None).cast("double").alias("o_totalprice"), F.lit(None).cast("string").alias("o_orderpriority"),
        "l_quantity", "l_extendedprice", "l_returnflag")
    return parents.unionByName(children)


def ship_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(F.struct(F.min("l_shipdate").alias("gte"), F.max("l_shipdate").alias("lte")).alias("ship"))


def doc_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents joined with embeddings on doc_id = vec_id (hybrid search)."""
    d = read(spark, sf_dir, "documents")
    e = read(spark, sf_dir, "embeddings")
    return d.join(e, d.doc_id == e.vec_id, "inner").drop("vec_id")


def customer_actions(spark: SparkSession, sf_dir: str, versioned: bool = False, ids: int = 1000) -> DataFrame:
    """Bulk actions derived from every customer row (key k = c_custkey, seq = k).

    op by k mod 7: 0 delete, 1 create, 2-3 update, else index; target id
    k mod ``ids``, moved to a missing id range (+5,000,000) when k mod 3 = 0.
    Updates set c_acctbal + 1 and, for even k, c_mktsegment = 'UPDATED'; an
    update upserts when k mod 5 = 0 and is doc-as-upsert when k mod 5 = 1.
    ``versioned``: external (even k) / external_gte (odd k) versions
    (k * 7919) mod 1000.
    """
    c = read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    op = (F.when(k % 7 == 0, "delete").when(k % 7 == 1, "create").when(k % 7 <= 3, "update").otherwise("index"))
    full = F.struct(F.col("c_name"), F.col("c_nationkey"), F.col("c_acctbal"), F.col("c_mktsegment"))
    patch = F.struct(F.lit(None).cast("string").alias("c_name"), F.lit(None).cast("int").alias("c_nationkey"),
                     (F.col("c_acctbal") + 1).alias("c_acctbal"),
                     F.when(k % 2 == 0, F.lit("UPDATED")).alias("c_mktsegment"))
    ups = F.struct(F.lit("upserted").alias("c_name"), F.lit(0).alias("c_nationkey"), F.lit(0.0).alias("c_acctbal"),
                   F.lit("NEW").alias("c_mktsegment"))
    is_upd = op == "update"
    cols = [k.alias("seq"), op.alias("op"), ((k % ids) + F.when(k % 3 == 0, F.lit(5_000_000)).otherwise(F.lit(0))).alias("id"),
            F.when(is_upd, patch).when(op != "delete", full).alias("doc"),
            F.when(is_upd & (k % 5 == 0), ups).alias("upsert"), (is_upd & (k % 5 == 1)).alias("doc_as_upsert")]
    if versioned:
        cols += [((k * 7919) % 1000).alias("version"), F.when(k % 2 == 0, "external").otherwise("external_gte").alias("version_type")]
    return c.select(*cols)
