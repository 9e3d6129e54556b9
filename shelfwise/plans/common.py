"""Inputs and column helpers shared by the registered queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.operators.features import rfm_features
from shelfwise.plans.registry import NUDGE, SALES
from shelfwise.sources.tables import SALES_COLUMNS, sales_lines


def rounded(df: DataFrame, digits: int = 4, columns: Sequence[str] | None = None) -> DataFrame:
    """Rounds double columns, so that the order of summation does not show; see ``NUDGE``."""
    names = columns or [name for name, kind in df.dtypes if kind == "double"]
    move = NUDGE * 10.0**-digits
    return df.withColumns({c: F.round(F.col(c) + move, digits) for c in names}) if names else df


# The tables hold no nulls, so the cleaning queries blank some cells of whole rows that stay in.
# Every row is kept; only the cells named here become null.
GAP_COLUMNS = [*SALES_COLUMNS, "remark"]
GAPS = SALES + """, gaps AS (
  SELECT order_id, line_number, product_id, supplier_id, ship_date, quantity,
         CASE WHEN order_id % 17 = 0 THEN NULL ELSE discount END AS discount, sales,
         order_date, customer_id, CASE WHEN order_id % 19 = 0 THEN NULL ELSE ship_mode END AS ship_mode,
         customer_name, segment, state, region, category, sub_category, product_name,
         CASE WHEN order_id % 13 = 0 THEN NULL ELSE profit END AS profit,
         CASE WHEN order_id % 2 <> 0 THEN NULL ELSE sub_category END AS remark
  FROM sales)"""


def sales_with_gaps(spark: SparkSession, sf_dir: str, columns: Sequence[str] = GAP_COLUMNS) -> DataFrame:
    needed = {"order_id", *columns} - {"remark"} | ({"sub_category"} if "remark" in columns else set())
    blank = lambda every, value: F.when(F.col("order_id") % every == 0, None).otherwise(F.col(value))
    lines = sales_lines(spark, sf_dir, [c for c in SALES_COLUMNS if c in needed])
    changed = {
        "discount": blank(17, "discount"),
        "ship_mode": blank(19, "ship_mode"),
        "profit": blank(13, "profit"),
        "remark": F.when(F.col("order_id") % 2 == 0, F.col("sub_category")),
    }
    return lines.withColumns({c: v for c, v in changed.items() if c in columns} or {"order_id": F.col("order_id")}).select(*columns)


def _score_sql(column, source):
    edges = f"list_distinct(quantile_cont(CAST({column} AS DOUBLE), [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))"
    return f"greatest(1, len(list_filter((SELECT {edges} FROM {source}), lambda e: e < {column})))"


# RFM table in SQL: base, scores and segments.
RFM = SALES + f""", rfm_base AS (
  SELECT customer_id, CAST(date_diff('day', max(order_date), (SELECT max(order_date) FROM sales) + INTERVAL 1 DAY) AS INTEGER) AS recency,
         count(DISTINCT order_id) AS frequency, sum(sales) AS monetary, sum(profit) AS total_profit, sum(quantity) AS total_quantity
  FROM sales GROUP BY customer_id),
rfm_scored AS (
  SELECT *, CAST({_score_sql('recency', 'rfm_base')} AS INTEGER) AS r_score,
         CAST(greatest(1, (5 * (rk - 1) + n - 2) // (n - 1)) AS INTEGER) AS f_score,
         CAST({_score_sql('monetary', 'rfm_base')} AS INTEGER) AS m_score
  FROM (SELECT *, row_number() OVER (ORDER BY frequency, customer_id) AS rk, count(*) OVER () AS n FROM rfm_base)),
rfm AS (
  SELECT * EXCLUDE (rk, n), CAST(100 * r_score + 10 * f_score + m_score AS INTEGER) AS rfm_score,
         CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
              WHEN f_score >= 4 THEN 'Loyal Customers'
              WHEN r_score >= 3 AND f_score >= 3 THEN 'Potential Loyalists'
              WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk'
              WHEN r_score <= 2 AND f_score <= 2 THEN 'Lost'
              WHEN r_score >= 4 AND f_score <= 2 THEN 'New Customers'
              ELSE 'Promising' END AS segment
  FROM rfm_scored)"""

RFM_COLUMNS = ["customer_id", "order_id", "order_date", "sales", "profit", "quantity"]


def rfm_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm_features(sales_lines(spark, sf_dir, RFM_COLUMNS))
