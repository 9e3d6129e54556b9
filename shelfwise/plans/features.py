"""RFM, customer, product, lag and join queries."""

from pyspark.sql import functions as F

from shelfwise.operators import features
from shelfwise.plans.common import RFM, RFM_COLUMNS, rfm_table, rounded
from shelfwise.plans.registry import SALES, query
from shelfwise.sources.tables import ROW_KEY, sales_lines

_MONEY = "round(monetary, 4) AS monetary, round(total_profit, 4) AS total_profit, total_quantity"


@query("rfm_base", f"WITH {RFM} SELECT customer_id, recency, frequency, {_MONEY} FROM rfm_base")
def rfm_base(spark, sf_dir):
    return rounded(features.rfm_base(sales_lines(spark, sf_dir, RFM_COLUMNS)))


@query("rfm_scores", f"WITH {RFM} SELECT customer_id, r_score, f_score, m_score, rfm_score FROM rfm")
def rfm_scores(spark, sf_dir):
    return rfm_table(spark, sf_dir).select("customer_id", "r_score", "f_score", "m_score", "rfm_score")


@query("rfm_segments", f"WITH {RFM} SELECT customer_id, recency, frequency, {_MONEY}, rfm_score, segment FROM rfm")
def rfm_segments(spark, sf_dir):
    return rounded(rfm_table(spark, sf_dir).drop("r_score", "f_score", "m_score"))


@query("rfm_segments_recency_inverted", f"""WITH {RFM}, turned AS (
  SELECT customer_id, 6 - r_score AS r, f_score AS f, m_score AS m FROM rfm)
SELECT customer_id, CAST(r AS INTEGER) AS r_score,
       CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'Champions' WHEN f >= 4 THEN 'Loyal Customers'
            WHEN r >= 3 AND f >= 3 THEN 'Potential Loyalists' WHEN r <= 2 AND f >= 3 THEN 'At Risk'
            WHEN r <= 2 AND f <= 2 THEN 'Lost' WHEN r >= 4 AND f <= 2 THEN 'New Customers'
            ELSE 'Promising' END AS segment FROM turned""")
def rfm_segments_recency_inverted(spark, sf_dir):
    lines = sales_lines(spark, sf_dir, RFM_COLUMNS)
    return features.rfm_features(lines, invert_recency=True).select("customer_id", "r_score", "segment")


_MEANS = "round(avg(recency), 2) AS recency, round(avg(frequency), 2) AS frequency, round(avg(monetary), 2) AS monetary"


@query("rfm_segment_profile", f"""WITH {RFM}
SELECT segment, {_MEANS}, count(*) AS customers FROM rfm GROUP BY segment
UNION ALL SELECT 'All', {_MEANS}, count(*) FROM rfm""")
def rfm_segment_profile(spark, sf_dir):
    return rounded(features.segment_profile(rfm_table(spark, sf_dir)), 2)


@query("rfm_segment_share", f"""WITH {RFM}
SELECT segment, count(*) AS customers, round(count(*) * 100.0 / (SELECT count(*) FROM rfm), 4) AS percent FROM rfm GROUP BY segment""")
def rfm_segment_share(spark, sf_dir):
    return rounded(features.segment_share(rfm_table(spark, sf_dir)))


@query("feat_classification", f"""WITH {RFM}
SELECT customer_id, round(total_profit / frequency, 4) AS avg_profit, round(monetary / frequency, 4) AS avg_order_value,
       round(total_profit / nullif(monetary, 0), 6) AS profit_margin FROM rfm_base""")
def feat_classification(spark, sf_dir):
    table = features.classification_features(features.rfm_base(sales_lines(spark, sf_dir, RFM_COLUMNS)))
    picked = table.select("customer_id", "avg_profit", "avg_order_value", "profit_margin")
    return rounded(rounded(picked, 4, ["avg_profit", "avg_order_value"]), 6, ["profit_margin"])


def _preferred_sql(column):
    return f"""SELECT customer_id, {column} FROM (SELECT customer_id, {column},
      row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, {column}) AS rn
      FROM sales GROUP BY customer_id, {column}) WHERE rn = 1"""


@query("feat_customer", f"""WITH {SALES}
SELECT s.customer_id, count(DISTINCT order_id) AS total_orders, CAST(min(order_date) AS DATE) AS first_order_date,
  CAST(max(order_date) AS DATE) AS last_order_date, round(sum(sales), 4) AS total_sales, round(avg(sales), 4) AS avg_order_value,
  round(stddev_samp(sales), 4) AS sales_variance, round(min(sales), 4) AS min_order_value, round(max(sales), 4) AS max_order_value,
  round(sum(profit), 4) AS total_profit, round(avg(profit), 4) AS avg_profit, sum(quantity) AS total_quantity,
  round(avg(quantity), 4) AS avg_quantity, round(avg(discount), 4) AS avg_discount, max(discount) AS max_discount,
  any_value(pc.category) AS preferred_category, any_value(pr.region) AS preferred_region,
  round(count(DISTINCT order_id) / (date_diff('day', min(order_date), max(order_date)) + 1) * 30, 4) AS order_frequency,
  round(sum(profit) / sum(sales), 4) AS profit_margin
FROM sales s JOIN ({_preferred_sql('category')}) pc ON pc.customer_id = s.customer_id
JOIN ({_preferred_sql('region')}) pr ON pr.customer_id = s.customer_id
GROUP BY s.customer_id""")
def feat_customer(spark, sf_dir):
    lines = sales_lines(spark, sf_dir, [*RFM_COLUMNS, "discount", "category", "region"])
    table = features.customer_features(lines)
    return rounded(table.withColumns({c: F.to_date(c) for c in ("first_order_date", "last_order_date")}))


@query("feat_product", f"""WITH {SALES}
SELECT product_id, product_name, count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
  round(sum(sales), 4) AS total_sales, round(avg(sales), 4) AS avg_sales, round(sum(profit), 4) AS total_profit,
  round(avg(profit), 4) AS avg_profit, sum(quantity) AS total_quantity, round(avg(quantity), 4) AS avg_quantity,
  round(avg(discount), 4) AS avg_discount, round(sum(profit) / sum(sales), 4) AS profit_margin
FROM sales GROUP BY product_id, product_name""")
def feat_product(spark, sf_dir):
    columns = ["product_id", "product_name", "order_id", "customer_id", "sales", "profit", "quantity", "discount"]
    return rounded(features.product_features(sales_lines(spark, sf_dir, columns)))


_ID = "order_id, line_number, product_id, supplier_id, CAST(ship_date AS DATE) AS ship_date"
_RUN = "order_date, order_id, line_number, product_id, supplier_id, ship_date"


def _lagged(spark, sf_dir, group, names):
    lines = sales_lines(spark, sf_dir, [*ROW_KEY, "customer_id", "order_date", "sales"])
    table = features.lag_features(lines, group, order=ROW_KEY)
    return rounded(table.select(*ROW_KEY[:-1], F.to_date("ship_date").alias("ship_date"), *names))


@query("win_lag", f"WITH {SALES} SELECT {_ID}, " + ", ".join(
    f"round(lag(sales, {k}) OVER w, 4) AS sales_lag_{k}" for k in (1, 3, 6, 12))
    + f" FROM sales WINDOW w AS (PARTITION BY customer_id ORDER BY {_RUN})")
def win_lag(spark, sf_dir):
    return _lagged(spark, sf_dir, "customer_id", [f"sales_lag_{k}" for k in (1, 3, 6, 12)])


@query("win_rolling_mean", f"WITH {SALES} SELECT {_ID}, " + ", ".join(
    f"round(avg(sales) OVER (PARTITION BY customer_id ORDER BY {_RUN} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW), 4)"
    f" AS sales_rolling_mean_{k}" for k in (3, 6)) + " FROM sales")
def win_rolling_mean(spark, sf_dir):
    return _lagged(spark, sf_dir, "customer_id", ["sales_rolling_mean_3", "sales_rolling_mean_6"])


@query("win_diff", f"""WITH {SALES}
SELECT {_ID}, round(sales - lag(sales) OVER (PARTITION BY product_id ORDER BY customer_id, {_RUN}), 4) AS sales_diff FROM sales""")
def win_diff(spark, sf_dir):
    return _lagged(spark, sf_dir, "product_id", ["sales_diff"])


@query("join_semi_valid_orders", f"""WITH {SALES}
SELECT {_ID}, round(sales, 4) AS sales FROM sales
WHERE order_id IN (SELECT order_id FROM sales GROUP BY order_id HAVING sum(sales) >= 100000)""")
def join_semi_valid_orders(spark, sf_dir):
    lines = features.valid_order_lines(sales_lines(spark, sf_dir, [*ROW_KEY, "sales"]), 100000)
    return rounded(lines.withColumn("ship_date", F.to_date("ship_date")))
