"""Registry of queries: name -> (callable, SQL over the same tables or None)."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Sums and means of short decimals often lie exactly half-way between two rounded values, where
# the last bit, which depends on the order of summation, would decide. Rounding on both sides
# therefore first moves the value by this fraction of the last digit kept.
NUDGE = 3.7e-3


def nudged_sql(sql: str) -> str:
    """Rewrites every ``round(x, d)`` of a SQL text to round the nudged value."""
    out, at = [], 0
    for match in re.finditer(r"\bround\(", sql):
        depth, comma, i = 1, 0, match.end()
        while depth:
            depth += {"(": 1, "[": 1, ")": -1, "]": -1}.get(sql[i], 0)
            comma = i if sql[i] == "," and depth == 1 else comma
            i += 1
        digits = int(sql[comma + 1 : i - 1])
        out += [sql[at:comma], f" + {NUDGE * 10.0 ** -digits!r}"]
        at = comma
    return "".join([*out, sql[at:]])


Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# The order-line view every SQL text starts from.
SALES = """sales AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id,
         l_suppkey AS supplier_id, l_shipdate AS ship_date, l_quantity AS quantity,
         l_discount AS discount, l_extendedprice * (1 - l_discount) AS sales,
         o_orderdate AS order_date, o_custkey AS customer_id, o_orderpriority AS ship_mode,
         c_name AS customer_name, c_mktsegment AS segment, n_name AS state, r_name AS region,
         p_type AS category, p_brand AS sub_category, p_name AS product_name,
         l_extendedprice * (1 - l_discount) - l_quantity * p_retailprice AS profit
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey)"""


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = nudged_sql(sql)
        return function

    return register
