"""Hierarchies built from the driver's TPC-H-style tables.

*geo*: root -> region -> nation -> customer / supplier, and customer -> order.
An id is ``key * 8 + level``, so the levels share one id space and can never
meet, however large the keys grow:

    root 1, region 2, nation 3, customer 4, supplier 5, order 6, line item 7
    (a line item's key is ``l_orderkey * 64 + l_linenumber``).

Names: root has "all" then "root"; a region, nation and supplier have their name;
a customer has its name then its market segment. Orders have no name.

*dag*: geo, and every order also below the suppliers of its line items, and every
line item below its order: nodes with several parents and several paths.

*heap*: one node per order, ``src = o_orderkey + 1`` with parent ``(o_orderkey + 1) div 2``
(a binary heap, depth about log2 of the order count), root 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .edges import edges_from

# Fixed level codes of the geo tree (see module docstring).
LEVELS = 8
ROOT = 1
REGION, NATION, CUSTOMER, SUPPLIER, ORDER, LINE = 2, 3, 4, 5, 6, 7
PART = 0  # parts are not in the geo tree
# Fixed names of the root, in order.
ROOT_NAMES = ("all", "root")


def node_id(key: str | Column, level: int) -> Column:
    """Id of the node with ``key`` on ``level``."""
    return (F.col(key) if isinstance(key, str) else key).cast("bigint") * LEVELS + level


def level_of(node: Column) -> Column:
    return F.pmod(node, F.lit(LEVELS))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def geo_raw_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unfiltered ``(src, dst)`` pairs of the geo tree, including the root's self-loop."""
    t = lambda n: read_table(spark, sf_dir, n)
    parts = [
        spark.range(1).select(F.lit(ROOT).cast("bigint").alias("src"), F.lit(ROOT).cast("bigint").alias("dst")),
        t("region").select(node_id("r_regionkey", REGION).alias("src"), F.lit(ROOT).cast("bigint").alias("dst")),
        t("nation").select(node_id("n_nationkey", NATION).alias("src"), node_id("n_regionkey", REGION).alias("dst")),
        t("customer").select(node_id("c_custkey", CUSTOMER).alias("src"), node_id("c_nationkey", NATION).alias("dst")),
        t("supplier").select(node_id("s_suppkey", SUPPLIER).alias("src"), node_id("s_nationkey", NATION).alias("dst")),
        t("orders").select(node_id("o_orderkey", ORDER).alias("src"), node_id("o_custkey", CUSTOMER).alias("dst")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def geo_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges_from(geo_raw_edges(spark, sf_dir))


def line_key() -> Column:
    return F.col("l_orderkey").cast("bigint") * 64 + F.col("l_linenumber")


def dag_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geo edges, order -> supplier of each of its line items (each once), line item -> order."""
    li = read_table(spark, sf_dir, "lineitem")
    order = node_id("l_orderkey", ORDER)
    up = li.select(order.alias("src"), node_id("l_suppkey", SUPPLIER).alias("dst")).distinct()
    # an order number and line number name one line item; the tables may repeat them
    lines = li.select(node_id(line_key(), LINE).alias("src"), order.alias("dst")).distinct()
    return edges_from(geo_raw_edges(spark, sf_dir).unionByName(up).unionByName(lines))


def geo_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name records ``(id, ord, name)`` of the geo tree."""
    t = lambda n: read_table(spark, sf_dir, n)
    rec = lambda i, o, n: (i.alias("id"), F.lit(o).cast("int").alias("ord"), n.alias("name"))
    root = F.lit(ROOT).cast("bigint")
    parts = [
        spark.range(1).select(*rec(root, 0, F.lit(ROOT_NAMES[0]))),
        spark.range(1).select(*rec(root, 1, F.lit(ROOT_NAMES[1]))),
        t("region").select(*rec(node_id("r_regionkey", REGION), 0, F.col("r_name"))),
        t("nation").select(*rec(node_id("n_nationkey", NATION), 0, F.col("n_name"))),
        t("customer").select(*rec(node_id("c_custkey", CUSTOMER), 0, F.col("c_name"))),
        t("customer").select(*rec(node_id("c_custkey", CUSTOMER), 1, F.col("c_mktsegment"))),
        t("supplier").select(*rec(node_id("s_suppkey", SUPPLIER), 0, F.col("s_name"))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def heap_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey").cast("bigint") + F.lit(1)
    return edges_from(o.select(k.alias("src"), F.floor(k / 2).cast("bigint").alias("dst")))
