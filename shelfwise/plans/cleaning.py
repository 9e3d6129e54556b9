"""Cleaning, encoding, scaling and date queries."""

from pyspark.sql import functions as F

from shelfwise.functions.storage import cut
from shelfwise.operators import clean, encode
from shelfwise.plans.common import GAPS, rounded, sales_with_gaps
from shelfwise.plans.registry import SALES, query
from shelfwise.sources.tables import ROW_KEY, sales_lines, table

_ID = ["order_id", "line_number", "product_id", "supplier_id", "ship_date"]
_ID_SQL = "order_id, line_number, product_id, supplier_id, CAST(ship_date AS DATE) AS ship_date"
_ORDER_SQL = "order_id, line_number, product_id, supplier_id, ship_date"


def _dated(df):
    return df.withColumn("ship_date", F.to_date("ship_date"))


@query("cln_drop_sparse_columns", f"""WITH {GAPS}
SELECT {_ID_SQL}, round(discount, 4) AS discount, ship_mode FROM gaps""")
def cln_drop_sparse_columns(spark, sf_dir):
    lines = cut(sales_with_gaps(spark, sf_dir, [*_ID, "discount", "ship_mode", "remark"]))  # joined once, read twice
    return _dated(clean.drop_sparse_columns(lines))


def _fill_query(strategy, value_sql):
    @query(f"cln_fill_numeric_{strategy}", f"""WITH {GAPS}
SELECT {_ID_SQL}, round(coalesce(discount, ({value_sql.format(c="discount")})), 4) AS discount,
       round(coalesce(profit, ({value_sql.format(c="profit")})), 4) AS profit FROM gaps""")
    def run(spark, sf_dir):
        lines = cut(sales_with_gaps(spark, sf_dir, [*_ID, "discount", "profit"]))
        return rounded(_dated(clean.handle_missing(lines, numeric_strategy=strategy)))


_MODE_SQL = "SELECT {c} FROM gaps WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1"
_fill_query("median", "SELECT quantile_cont({c}, 0.5) FROM gaps")
_fill_query("mean", "SELECT avg({c}) FROM gaps")
_fill_query("mode", _MODE_SQL)


@query("cln_fill_categorical", f"""WITH {GAPS}
SELECT {_ID_SQL}, coalesce(ship_mode, ({_MODE_SQL.format(c="ship_mode")})) AS by_mode,
       coalesce(ship_mode, 'Unknown') AS by_constant FROM gaps""")
def cln_fill_categorical(spark, sf_dir):
    lines = cut(sales_with_gaps(spark, sf_dir, [*_ID, "ship_mode"]))  # joined once, read by every pass
    both = lines.select(*_ID, F.col("ship_mode").alias("by_mode"), F.struct("ship_mode").alias("_kept"))
    filled = clean.handle_missing(both, categorical_strategy="mode")  # leaves the struct alone
    constant = filled.withColumn("by_constant", F.col("_kept.ship_mode")).drop("_kept")
    return _dated(clean.handle_missing(constant, categorical_strategy="constant"))


def _dedup_query(name, keep, condition):
    @query(f"cln_dedup_{name}", f"""WITH {SALES}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY order_id, product_id ORDER BY {_ORDER_SQL}) AS up,
         count(*) OVER (PARTITION BY order_id, product_id) AS size FROM sales)
SELECT {_ID_SQL}, quantity, round(sales, 4) AS sales FROM ranked WHERE {condition}""")
    def run(spark, sf_dir):
        lines = sales_lines(spark, sf_dir, [*ROW_KEY, "quantity", "sales"])
        return rounded(_dated(clean.drop_duplicates(lines, ["order_id", "product_id"], keep, ROW_KEY)))


_dedup_query("first", "first", "up = 1")
_dedup_query("last", "last", "up = size")
_dedup_query("none", False, "size = 1")


@query("cln_dedup_counts", f"""WITH {SALES}, sizes AS (
  SELECT count(*) AS n FROM sales GROUP BY order_id, product_id)
SELECT 'first' AS keep, CAST(sum(n - 1) AS BIGINT) AS duplicates_removed FROM sizes
UNION ALL SELECT 'none', CAST(sum(n) FILTER (n > 1) AS BIGINT) FROM sizes""")
def cln_dedup_counts(spark, sf_dir):
    lines = sales_lines(spark, sf_dir, ["order_id", "product_id"])
    subset = ["order_id", "product_id"]
    return clean.duplicates_removed(lines, subset).withColumn("keep", F.lit("first")).unionByName(
        clean.duplicates_removed(lines, subset, False).withColumn("keep", F.lit("none")))


# IQR with threshold 0.5 on order lines: at 1.5 these columns have no outliers.
def _iqr_sql(source, c):
    return f"""SELECT quantile_cont({c}, 0.25) - 0.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo,
  quantile_cont({c}, 0.75) + 0.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi FROM {source}"""


_BOUNDS = f"s AS ({_iqr_sql('gaps', 'sales')}), p AS ({_iqr_sql('gaps', 'profit')})"
_VALUES = [*_ID, "sales", "profit"]


@query("cln_iqr_clip", f"""WITH {GAPS}, {_BOUNDS}
SELECT {_ID_SQL}, round(greatest(least(sales, s.hi), s.lo), 4) AS sales,
       round(CASE WHEN profit IS NOT NULL THEN greatest(least(profit, p.hi), p.lo) END, 4) AS profit FROM gaps, s, p""")
def cln_iqr_clip(spark, sf_dir):
    return rounded(_dated(clean.outliers_iqr(sales_with_gaps(spark, sf_dir, _VALUES), ["sales", "profit"], 0.5, "clip")))


_REMOVE = f"""s AS ({_iqr_sql('gaps', 'sales')}),
kept AS (SELECT gaps.* FROM gaps, s WHERE sales BETWEEN s.lo AND s.hi), p AS ({_iqr_sql('kept', 'profit')})"""


@query("cln_iqr_remove", f"""WITH {GAPS}, {_REMOVE}
SELECT {_ID_SQL}, round(sales, 4) AS sales, round(profit, 4) AS profit FROM kept, p WHERE profit BETWEEN p.lo AND p.hi""")
def cln_iqr_remove(spark, sf_dir):
    return rounded(_dated(clean.outliers_iqr(sales_with_gaps(spark, sf_dir, _VALUES), ["sales", "profit"], 0.5, "remove")))


@query("cln_iqr_null", f"""WITH {GAPS}, {_BOUNDS}
SELECT {_ID_SQL}, round(CASE WHEN sales BETWEEN s.lo AND s.hi THEN sales END, 4) AS sales,
       round(CASE WHEN profit BETWEEN p.lo AND p.hi THEN profit END, 4) AS profit FROM gaps, s, p""")
def cln_iqr_null(spark, sf_dir):
    return rounded(_dated(clean.outliers_iqr(sales_with_gaps(spark, sf_dir, _VALUES), ["sales", "profit"], 0.5, "NaN")))


@query("cln_outlier_counts", f"""WITH {GAPS}, {_REMOVE}, pg AS ({_iqr_sql('gaps', 'profit')})
SELECT 'clip' AS method, 'sales' AS "column", count(*) FILTER (sales < s.lo OR sales > s.hi) AS outliers FROM gaps, s
UNION ALL SELECT 'clip', 'profit', count(*) FILTER (profit < pg.lo OR profit > pg.hi) FROM gaps, pg
UNION ALL SELECT 'remove', 'sales', count(*) FILTER (NOT coalesce(sales BETWEEN s.lo AND s.hi, false)) FROM gaps, s
UNION ALL SELECT 'remove', 'profit', count(*) FILTER (NOT coalesce(profit BETWEEN p.lo AND p.hi, false)) FROM kept, p""")
def cln_outlier_counts(spark, sf_dir):
    lines = sales_with_gaps(spark, sf_dir, _VALUES)
    tables = [
        clean.iqr_outlier_counts(lines, ["sales", "profit"], 0.5, m).withColumn("method", F.lit(m)) for m in ("clip", "remove")
    ]
    return tables[0].unionByName(tables[1])


# Event values have real outliers; some are blanked to show how nulls are treated.
_EVENTS = """ev AS (SELECT event_id, CASE WHEN user_id % 7 = 0 THEN NULL ELSE value END AS value,
                    user_id + 0.0 AS weight FROM events),
z AS (SELECT avg(coalesce(value, 0)) AS m, stddev_pop(coalesce(value, 0)) AS sd, avg(value) AS mean,
             stddev_samp(value) AS std FROM ev)"""


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("user_id") % 7 == 0, None).otherwise(F.col("value")).alias("value"),
        F.col("user_id").cast("double").alias("weight"),
    )


@query("cln_zscore_clip", f"""WITH {_EVENTS}
SELECT event_id, round(CASE WHEN value IS NOT NULL THEN greatest(least(value, mean + 3 * std), mean - 3 * std) END, 4)
  AS value FROM ev, z""")
def cln_zscore_clip(spark, sf_dir):
    return rounded(clean.outliers_zscore(_events(spark, sf_dir).drop("weight"), ["value"], 3, "clip"))


_Z_REMOVE = """kept AS (SELECT ev.* FROM ev, z WHERE abs(coalesce(value, 0) - m) / sd <= 3),
zw AS (SELECT avg(weight) AS m, stddev_pop(weight) AS sd FROM kept)"""


@query("cln_zscore_remove", f"""WITH {_EVENTS}, {_Z_REMOVE}
SELECT event_id, value, CAST(weight AS DOUBLE) AS weight FROM kept, zw WHERE abs(weight - zw.m) / zw.sd <= 1.5""")
def cln_zscore_remove(spark, sf_dir):
    first = clean.outliers_zscore(_events(spark, sf_dir), ["value"], 3, "remove")
    return clean.outliers_zscore(first, ["weight"], 1.5, "remove")


@query("cln_zscore_null", f"""WITH {_EVENTS}
SELECT event_id, CASE WHEN abs(coalesce(value, 0) - m) / sd <= 3 THEN value END AS value FROM ev, z""")
def cln_zscore_null(spark, sf_dir):
    return clean.outliers_zscore(_events(spark, sf_dir).drop("weight"), ["value"], 3, "NaN")


@query("cln_zscore_counts", f"""WITH {_EVENTS}
SELECT 'value' AS "column", count(*) FILTER (abs(coalesce(value, 0) - m) / sd > 3) AS outliers FROM ev, z""")
def cln_zscore_counts(spark, sf_dir):
    return clean.zscore_outlier_counts(_events(spark, sf_dir), ["value"], 3)


# Texts of which some cannot be read as numbers or times.
@query("cln_convert_types", f"""WITH {SALES}
SELECT {_ID_SQL}, TRY_CAST(CASE WHEN order_id % 23 = 0 THEN concat('x', quantity) ELSE concat('', quantity) END AS DOUBLE) AS amount,
       CAST(TRY_CAST(CASE WHEN order_id % 29 = 0 THEN 'soon' ELSE strftime(order_date, '%Y-%m-%d') END AS TIMESTAMP) AS DATE) AS ordered,
       segment, CAST(quantity AS INTEGER) AS pieces FROM sales""")
def cln_convert_types(spark, sf_dir):
    lines = sales_lines(spark, sf_dir, [*ROW_KEY, "quantity", "order_date", "segment"])
    texts = lines.select(
        *ROW_KEY,
        F.when(F.col("order_id") % 23 == 0, F.concat(F.lit("x"), "quantity")).otherwise(F.col("quantity").cast("string")).alias("amount"),
        F.when(F.col("order_id") % 29 == 0, "soon").otherwise(F.date_format("order_date", "yyyy-MM-dd")).alias("ordered"),
        "segment",
        F.col("quantity").alias("pieces"),
    )
    typed = clean.convert_types(
        texts, {"amount": "numeric", "ordered": "datetime", "segment": "category", "pieces": "int", "absent": "int"})
    return _dated(typed.withColumn("ordered", F.to_date("ordered")))


_STAGES = f"""filled AS (SELECT * EXCLUDE (remark) REPLACE (
    coalesce(discount, (SELECT quantile_cont(discount, 0.5) FROM gaps)) AS discount,
    coalesce(profit, (SELECT quantile_cont(profit, 0.5) FROM gaps)) AS profit,
    coalesce(ship_mode, ({_MODE_SQL.format(c="ship_mode")})) AS ship_mode) FROM gaps),
uniq AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id, product_id ORDER BY {_ORDER_SQL}) AS rn
         FROM filled) WHERE rn = 1),
b AS (SELECT quantile_cont(profit, 0.25) - 1.5 * (quantile_cont(profit, 0.75) - quantile_cont(profit, 0.25)) AS lo,
             quantile_cont(profit, 0.75) + 1.5 * (quantile_cont(profit, 0.75) - quantile_cont(profit, 0.25)) AS hi FROM uniq)"""
_USED = [*_ID, "order_date", "ship_mode", "discount", "sales", "profit", "remark"]


@query("cln_full_preprocessing", f"""WITH {GAPS}, {_STAGES},
clipped AS (SELECT uniq.* REPLACE (greatest(least(profit, b.hi), b.lo) AS profit) FROM uniq, b),
codes AS (SELECT ship_mode, CAST(row_number() OVER (ORDER BY k) - 1 AS INTEGER) AS ship_mode_encoded FROM (
  SELECT ship_mode, min(({_ORDER_SQL})) AS k FROM clipped GROUP BY ship_mode)),
st AS (SELECT avg(sales) AS ms, stddev_pop(sales) AS ss, avg(profit) AS mp, stddev_pop(profit) AS sp FROM clipped)
SELECT {_ID_SQL}, CAST(order_date AS DATE) AS order_date, clipped.ship_mode, round(discount, 4) AS discount,
       round(sales, 4) AS sales, round(profit, 4) AS profit,
       CAST(year(order_date) AS INTEGER) AS order_date_year, CAST(month(order_date) AS INTEGER) AS order_date_month,
       CAST(quarter(order_date) AS INTEGER) AS order_date_quarter, CAST(day(order_date) AS INTEGER) AS order_date_day,
       CAST(isodow(order_date) - 1 AS INTEGER) AS order_date_dayofweek,
       CAST(isodow(order_date) >= 6 AS INTEGER) AS order_date_is_weekend, ship_mode_encoded,
       round((sales - ms) / ss, 4) AS sales_scaled, round((profit - mp) / sp, 4) AS profit_scaled
FROM clipped JOIN codes USING (ship_mode), st""")
def cln_full_preprocessing(spark, sf_dir):
    result = clean.preprocess(
        sales_with_gaps(spark, sf_dir, _USED), ["sales", "profit"], ["ship_mode"], ["order_date"], ["profit"], order=ROW_KEY)
    return rounded(_dated(result.withColumn("order_date", F.to_date("order_date"))))


@query("cln_report", f"""WITH {GAPS}, {_STAGES}
SELECT 'original_shape' AS metric, 'rows' AS name, count(*) AS value FROM gaps
UNION ALL SELECT 'original_shape', 'columns', {len(_USED)}
UNION ALL SELECT 'final_shape', 'rows', count(*) FROM uniq
UNION ALL SELECT 'final_shape', 'columns', {len(_USED) - 1}
UNION ALL SELECT 'duplicates_removed', 'rows', (SELECT count(*) FROM filled) - (SELECT count(*) FROM uniq)
UNION ALL SELECT 'missing_handled', 'cells',
  4 * count(*) - count(discount) - count(profit) - count(ship_mode) - count(remark) FROM gaps
UNION ALL SELECT 'outliers_handled', 'profit', count(*) FILTER (profit < lo OR profit > hi) FROM uniq, b
UNION ALL SELECT 'encoded', 'ship_mode', 1""")
def cln_report(spark, sf_dir):
    return clean.cleaning_report(sales_with_gaps(spark, sf_dir, _USED), ["ship_mode"], ["profit"], order=ROW_KEY)


@query("enc_label", f"""WITH {GAPS}, codes AS (
  SELECT ship_mode, CAST(row_number() OVER (ORDER BY k) - 1 AS INTEGER) AS code FROM (
    SELECT ship_mode, min(({_ORDER_SQL})) AS k FROM gaps WHERE ship_mode IS NOT NULL GROUP BY ship_mode))
SELECT {_ID_SQL}, g.ship_mode, coalesce(code, -1) AS ship_mode_encoded FROM gaps g LEFT JOIN codes c ON g.ship_mode = c.ship_mode""")
def enc_label(spark, sf_dir):
    lines = cut(sales_with_gaps(spark, sf_dir, [*_ID, "ship_mode"]))  # joined once, read for the codes and the rows
    return _dated(encode.encode_categorical(lines, ["ship_mode"], "label", ROW_KEY))


@query("enc_label_map", f"""WITH {SALES}
SELECT customer_name, CAST(row_number() OVER (ORDER BY k) - 1 AS INTEGER) AS code FROM (
  SELECT customer_name, min(({_ORDER_SQL})) AS k FROM sales GROUP BY customer_name)""")
def enc_label_map(spark, sf_dir):
    return encode.label_map(sales_lines(spark, sf_dir, [*ROW_KEY, "customer_name"]), "customer_name", ROW_KEY)


_MODES = ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("enc_onehot", f"WITH {GAPS} SELECT {_ID_SQL}, ship_mode, " + ", ".join(
    f"coalesce(ship_mode = '{m}', false) AS \"ship_mode_{m}\"" for m in _MODES) + " FROM gaps")
def enc_onehot(spark, sf_dir):
    lines = cut(sales_with_gaps(spark, sf_dir, [*_ID, "ship_mode"]))  # joined once, read for the codes and the rows
    return _dated(encode.encode_categorical(lines, ["ship_mode"], "onehot"))


@query("enc_frequency", f"""WITH {GAPS}, f AS (SELECT ship_mode, count(*) / (SELECT count(ship_mode) FROM gaps) AS share
  FROM gaps WHERE ship_mode IS NOT NULL GROUP BY ship_mode)
SELECT {_ID_SQL}, g.ship_mode, round(share, 4) AS ship_mode_freq FROM gaps g LEFT JOIN f ON g.ship_mode = f.ship_mode""")
def enc_frequency(spark, sf_dir):
    return rounded(_dated(encode.encode_frequency(sales_with_gaps(spark, sf_dir, [*_ID, "ship_mode"]), ["ship_mode"])))


def _scale_query(method, start, by):
    def column(c):
        return f"round(({c} - (SELECT {start.format(c=c)} FROM gaps)) / (SELECT {by.format(c=c)} FROM gaps), 4) AS {c}_scaled"

    @query(f"scl_{method}", f"WITH {GAPS} SELECT {_ID_SQL}, {column('sales')}, {column('profit')} FROM gaps")
    def run(spark, sf_dir):
        scaled = encode.scale(sales_with_gaps(spark, sf_dir, _VALUES), ["sales", "profit"], method)
        return rounded(_dated(scaled.drop("sales", "profit")))


_scale_query("standard", "avg({c})", "stddev_pop({c})")
_scale_query("minmax", "min({c})", "max({c}) - min({c})")
_scale_query("robust", "quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)")


def _part(function, alias, source="order_date"):
    return f"CAST({function}({source}) AS INTEGER) AS {alias}"


@query("dat_process_dates", f"""WITH {SALES}
SELECT {_ID_SQL}, CAST(order_date AS DATE) AS order_date, {_part('year', 'order_date_year')},
  {_part('month', 'order_date_month')}, {_part('quarter', 'order_date_quarter')}, {_part('day', 'order_date_day')},
  CAST(isodow(order_date) - 1 AS INTEGER) AS order_date_dayofweek,
  CAST(isodow(order_date) >= 6 AS INTEGER) AS order_date_is_weekend FROM sales""")
def dat_process_dates(spark, sf_dir):
    lines = sales_lines(spark, sf_dir, [*ROW_KEY, "order_date"])
    texts = lines.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd"))
    return _dated(encode.process_dates(texts, ["order_date"]).withColumn("order_date", F.to_date("order_date")))


@query("dat_time_features", f"""WITH {SALES}
SELECT {_ID_SQL}, {_part('year', 'year')}, {_part('month', 'month')}, {_part('quarter', 'quarter')}, {_part('day', 'day')},
  CAST(isodow(order_date) - 1 AS INTEGER) AS day_of_week, {_part('week', 'week_of_year')},
  round(sin(month(order_date) * 2 * pi() / 12), 4) AS month_sin, round(cos(month(order_date) * 2 * pi() / 12), 4) AS month_cos,
  round(sin((isodow(order_date) - 1) * 2 * pi() / 7), 4) AS day_of_week_sin,
  round(cos((isodow(order_date) - 1) * 2 * pi() / 7), 4) AS day_of_week_cos,
  CAST(isodow(order_date) >= 6 AS INTEGER) AS is_weekend,
  CASE WHEN month(order_date) IN (12, 1, 2) THEN 'Winter' WHEN month(order_date) IN (3, 4, 5) THEN 'Spring'
       WHEN month(order_date) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
  CAST(month(order_date) IN (11, 12) AS INTEGER) AS is_holiday_season FROM sales""")
def dat_time_features(spark, sf_dir):
    features = encode.time_features(sales_lines(spark, sf_dir, [*ROW_KEY, "order_date"]))
    return rounded(_dated(features.drop("order_date")))
