"""Profiling queries."""

from pyspark.sql import functions as F

from shelfwise.operators import profile
from shelfwise.plans.common import GAPS, rounded, sales_with_gaps
from shelfwise.plans.registry import SALES, query
from shelfwise.sources.tables import NUMERIC, ROW_KEY, SALES_COLUMNS, TEXT, sales_lines

_COUNTED = ["order_id", "order_date", "customer_id", "sales", "profit"]


def _each(template, columns, glue=" UNION ALL "):
    return glue.join(template.format(c=c) for c in columns)


@query("src_sales_view", f"""WITH {SALES}
SELECT order_id, line_number, product_id, supplier_id, CAST(ship_date AS DATE) AS ship_date, quantity, discount,
       round(sales, 4) AS sales, CAST(order_date AS DATE) AS order_date, customer_id, ship_mode, customer_name,
       segment, state, region, category, sub_category, product_name, round(profit, 4) AS profit
FROM sales""")
def src_sales_view(spark, sf_dir):
    lines = sales_lines(spark, sf_dir)
    return rounded(lines.withColumns({c: F.to_date(c) for c in ("ship_date", "order_date")}), 4, ["sales", "profit"])


_TYPES = {c: "string" for c in TEXT} | {c: "double" for c in NUMERIC} | {
    "order_id": "bigint", "product_id": "bigint", "supplier_id": "bigint", "customer_id": "bigint",
    "line_number": "int", "ship_date": "timestamp_ntz", "order_date": "timestamp_ntz", "remark": "string",
}
_INSPECTED = [*SALES_COLUMNS, "remark"]


@query("eda_inspect", f"""WITH {GAPS}
SELECT 'shape' AS section, 'rows' AS name, CAST(count(*) AS VARCHAR) AS value FROM gaps
UNION ALL SELECT 'shape', 'columns', '{len(_INSPECTED)}'
UNION ALL SELECT 'duplicates', 'rows',
  CAST((SELECT count(*) FROM gaps) - (SELECT count(*) FROM (SELECT DISTINCT * FROM gaps)) AS VARCHAR)
UNION ALL {_each("SELECT 'missing', '{c}', CAST(count(*) - count({c}) AS VARCHAR) FROM gaps", _INSPECTED)}
UNION ALL {" UNION ALL ".join(f"SELECT 'dtype', '{c}', '{_TYPES[c]}'" for c in _INSPECTED)}""")
def eda_inspect(spark, sf_dir):
    return profile.inspect(sales_with_gaps(spark, sf_dir))


@query("eda_head", f"""WITH {SALES}
SELECT order_id, line_number, product_id, supplier_id, CAST(ship_date AS DATE) AS ship_date, customer_id, sales
FROM (SELECT * REPLACE (round(sales, 4) AS sales) FROM sales
      ORDER BY order_id, line_number, product_id, supplier_id, ship_date LIMIT 5)""")
def eda_head(spark, sf_dir):
    first = profile.head(sales_lines(spark, sf_dir, [*ROW_KEY, "customer_id", "sales"]), ROW_KEY, 5)
    return rounded(first.withColumn("ship_date", F.to_date("ship_date")))


def _info_sql(column):
    kind = _TYPES[column]
    text = kind in ("string", "timestamp_ntz")
    if kind == "timestamp_ntz":
        shown = f"strftime({column}, '%Y-%m-%d %H:%M:%S')"
    elif text:
        shown = column
    elif kind in ("bigint", "int"):
        shown = f"CAST({column} AS VARCHAR)"
    else:
        shown = f"printf('%.2f', CAST({column} AS DOUBLE))"
    return f"""SELECT '{column}' AS "column", '{kind}' AS dtype, count({column}) AS non_null,
  count(*) - count({column}) AS nulls, count(DISTINCT {column}) AS distinct_values,
  (SELECT string_agg(s, ', ' ORDER BY v) FROM (SELECT DISTINCT {column} AS v, {shown} AS s FROM gaps
   WHERE {column} IS NOT NULL ORDER BY v LIMIT 3)) AS sample_values FROM gaps"""


@query("eda_column_info", f"WITH {GAPS} " + " UNION ALL ".join(_info_sql(c) for c in _INSPECTED))
def eda_column_info(spark, sf_dir):
    return profile.column_info(sales_with_gaps(spark, sf_dir))


def _overview_sql(column):
    kind = _TYPES[column]
    x = {"string": None, "timestamp_ntz": f"CAST(epoch({column}) AS DOUBLE)"}.get(kind, f"CAST({column} AS DOUBLE)")
    moments = f"round(avg({x}), 4) AS mean, round(stddev_samp({x}), 4) AS std" if x else "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std"
    shown = "strftime({0}, '%Y-%m-%d %H:%M:%S')" if kind == "timestamp_ntz" else "CAST({0} AS VARCHAR)"
    ends = [shown.format(f"{f}({column})") if kind != "double" else "CAST(NULL AS VARCHAR)" for f in ("min", "max")]
    return f"""SELECT '{column}' AS "column", '{kind}' AS dtype, count(*) AS rows, count(*) - count({column}) AS nulls, {moments},
  {ends[0]} AS smallest, {ends[1]} AS largest FROM gaps"""


@query("eda_overview", f"WITH {GAPS} " + " UNION ALL ".join(_overview_sql(c) for c in _INSPECTED))
def eda_overview(spark, sf_dir):
    table = rounded(profile.overview(sales_with_gaps(spark, sf_dir)), 4, ["mean", "std"])
    # Sketched columns, and doubles as text, which engines write differently, are left to the tests.
    whole = F.when(F.col("dtype") != "double", F.struct("smallest", "largest"))
    return table.select("column", "dtype", "rows", "nulls", "mean", "std", whole["smallest"].alias("smallest"), whole["largest"].alias("largest"))


@query("eda_summary_stats", f"""WITH {SALES}
SELECT count(*) AS n_lines, count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS total_customers,
       round(sum(sales), 2) AS total_sales, round(sum(profit), 2) AS total_profit,
       CAST(min(order_date) AS DATE) AS first_order_date, CAST(max(order_date) AS DATE) AS last_order_date
FROM sales""")
def eda_summary_stats(spark, sf_dir):
    stats = profile.summary_stats(sales_lines(spark, sf_dir, _COUNTED))
    dates = {c: F.to_date(c) for c in ("first_order_date", "last_order_date")}
    return rounded(stats.withColumns(dates), 2)


def _describe_sql(column, expression=None):
    x = expression or f"CAST({column} AS DOUBLE)"
    return f"""SELECT '{column}' AS "column", count({x}) AS count, round(avg({x}), 4) AS mean,
  round(stddev_samp({x}), 4) AS std, round(min({x}), 4) AS min, round(quantile_cont({x}, 0.25), 4) AS q25,
  round(quantile_cont({x}, 0.5), 4) AS q50, round(quantile_cont({x}, 0.75), 4) AS q75, round(max({x}), 4) AS max
  FROM gaps"""


@query("eda_describe", f"WITH {GAPS} " + " UNION ALL ".join(
    [_describe_sql(c) for c in NUMERIC] + [_describe_sql("order_date", "CAST(epoch(order_date) AS DOUBLE)")]))
def eda_describe(spark, sf_dir):
    lines = sales_with_gaps(spark, sf_dir, [*NUMERIC, "order_date"])
    return rounded(profile.describe(lines, [*NUMERIC, "order_date"]))


@query("eda_missing", f"WITH {GAPS} SELECT * FROM (" + _each(
    "SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, "
    "round((count(*) - count({c})) * 100.0 / count(*), 4) AS percent FROM gaps", _INSPECTED) + ") WHERE missing > 0")
def eda_missing(spark, sf_dir):
    return rounded(profile.missing_table(sales_with_gaps(spark, sf_dir)))


@query("eda_category_topn", f"""WITH {SALES}
SELECT sub_category AS value, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM sales), 4) AS percent
FROM sales GROUP BY sub_category ORDER BY n DESC, value LIMIT 10""")
def eda_category_topn(spark, sf_dir):
    return rounded(profile.category_counts(sales_lines(spark, sf_dir, ["sub_category"]), "sub_category", 10))


@query("eda_histogram", f"""WITH {SALES}, span AS (SELECT min(sales) AS lo, max(sales) AS hi FROM sales),
counted AS (SELECT least(CAST(floor((sales - lo) * 30 / (hi - lo)) AS INTEGER), 29) AS bin, count(*) AS n
            FROM sales, span GROUP BY ALL)
SELECT b.bin, round(lo + b.bin * ((hi - lo) / 30), 4) AS lower, round(lo + (b.bin + 1) * ((hi - lo) / 30), 4) AS upper,
       coalesce(n, 0) AS n
FROM (SELECT CAST(unnest(range(30)) AS INTEGER) AS bin) b CROSS JOIN span LEFT JOIN counted USING (bin)""")
def eda_histogram(spark, sf_dir):
    return rounded(profile.histogram(sales_lines(spark, sf_dir, ["sales"]), "sales", 30))


@query("eda_correlation", f"WITH {GAPS} " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 4) AS corr FROM gaps" for a in NUMERIC for b in NUMERIC))
def eda_correlation(spark, sf_dir):
    return rounded(profile.correlation(sales_with_gaps(spark, sf_dir, NUMERIC)))


def _sum_by_sql(key):
    return f"WITH {SALES} SELECT {key}, round(sum(sales), 2) AS total_sales FROM sales GROUP BY {key}"


@query("eda_sales_by_category", _sum_by_sql("category"))
def eda_sales_by_category(spark, sf_dir):
    return rounded(profile.sum_by(sales_lines(spark, sf_dir, ["category", "sales"]), "category"), 2)


@query("eda_sales_by_sub_category", _sum_by_sql("sub_category"))
def eda_sales_by_sub_category(spark, sf_dir):
    return rounded(profile.sum_by(sales_lines(spark, sf_dir, ["sub_category", "sales"]), "sub_category"), 2)


@query("eda_sales_by_region", _sum_by_sql("region"))
def eda_sales_by_region(spark, sf_dir):
    return rounded(profile.sum_by(sales_lines(spark, sf_dir, ["region", "sales"]), "region"), 2)


@query("eda_monthly_sales", f"""WITH {SALES}
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, round(sum(sales), 2) AS total_sales
FROM sales GROUP BY 1""")
def eda_monthly_sales(spark, sf_dir):
    return rounded(profile.monthly_totals(sales_lines(spark, sf_dir, ["order_date", "sales"])), 2)


@query("eda_top_values", f"WITH {SALES} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", (SELECT count(DISTINCT {c}) FROM sales) AS distinct_values, rank, value, n FROM (
      SELECT {c} AS value, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) AS INTEGER) AS rank
      FROM sales GROUP BY {c}) WHERE rank <= 5""" for c in TEXT))
def eda_top_values(spark, sf_dir):
    return profile.top_values(sales_lines(spark, sf_dir, TEXT))
