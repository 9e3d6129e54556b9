"""Parquet tables and the flat order-line view built from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

# Total order of order lines: no two lines share it.
ROW_KEY = ["order_id", "line_number", "product_id", "supplier_id", "ship_date"]

_LINE = ["order_id", "line_number", "product_id", "supplier_id", "ship_date", "quantity", "discount", "sales"]
_ORDER = ["order_date", "customer_id", "ship_mode"]
_CUSTOMER = ["customer_name", "segment"]
_PART = ["category", "sub_category", "product_name", "profit"]
SALES_COLUMNS = [*_LINE, *_ORDER, *_CUSTOMER, "state", "region", *_PART]

NUMERIC = ["quantity", "discount", "sales", "profit"]
TEXT = ["ship_mode", "customer_name", "segment", "state", "region", "category", "sub_category", "product_name"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales_lines(spark: SparkSession, sf_dir: str, columns: Sequence[str] = SALES_COLUMNS) -> DataFrame:
    """One row per order line, joining only the tables the wanted columns come from.

    Dimensions are joined to each other before they meet the lines. No broadcast is forced:
    Spark broadcasts a side when its size is below ``spark.sql.autoBroadcastJoinThreshold``,
    and adaptive execution splits skewed sort-merge partitions.
    """
    wanted = set(columns)
    unknown = wanted - set(SALES_COLUMNS)
    if unknown:
        raise ValueError(f"unknown sales columns: {sorted(unknown)}")
    geography = wanted & {"state", "region"}
    customer = geography or wanted & set(_CUSTOMER)

    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_shipdate").alias("ship_date"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        net.alias("sales"),
    )
    if customer or wanted & set(_ORDER):
        orders = table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderdate").alias("order_date"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderpriority").alias("ship_mode"),
        )
        if customer:
            orders = orders.join(_customers(spark, sf_dir, "region" in wanted, bool(geography)), "customer_id")
        lines = lines.join(orders, "order_id")
    if wanted & set(_PART):
        parts = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("sub_category"),
            F.col("p_name").alias("product_name"),
            F.col("p_retailprice").alias("_list_price"),
        )
        lines = lines.join(parts, "product_id").withColumn(
            "profit", F.col("sales") - F.col("quantity") * F.col("_list_price")
        )
    return lines.select(*columns)


def _customers(spark, sf_dir, with_region, with_state):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_id"),
    )
    if not with_state:
        return customers.drop("nation_id")
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nation_id"),
        F.col("n_name").alias("state"),
        F.col("n_regionkey").alias("region_id"),
    )
    if with_region:
        regions = table(spark, sf_dir, "region").select(
            F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region")
        )
        nations = nations.join(regions, "region_id")
    return customers.join(nations.drop("region_id"), "nation_id").drop("nation_id")
