"""Report and file queries."""

from pyspark.sql import functions as F

from shelfwise.functions.storage import scratch_path
from shelfwise.operators import cluster, profile, report, timeseries
from shelfwise.operators.metrics import classification_metrics
from shelfwise.plans import basket, clusters, metrics, series
from shelfwise.plans.common import GAPS, RFM, rfm_table, rounded, sales_with_gaps
from shelfwise.plans.registry import SALES, query
from shelfwise.sources import files
from shelfwise.sources.tables import NUMERIC, ROW_KEY, TEXT, sales_lines

_CSV_COLUMNS = [*ROW_KEY, "order_date", "customer_id", "segment", "region", "sub_category", "product_name", "sales", "quantity"]


@query("src_csv_roundtrip", f"""WITH {SALES}
SELECT order_id, line_number, product_id, supplier_id, CAST(ship_date AS DATE) AS ship_date, CAST(order_date AS DATE) AS order_date,
  customer_id, segment, region, sub_category, product_name, round(sales, 4) AS sales, quantity FROM sales""")
def src_csv_roundtrip(spark, sf_dir):
    lines = sales_lines(spark, sf_dir, _CSV_COLUMNS)
    folder = scratch_path(spark, "csv")
    files.save_csv(lines, f"{folder}/lines.csv")
    back = files.load_csv(spark, folder, "lines.csv", lines.schema)
    return rounded(back.withColumns({c: F.to_date(c) for c in ("ship_date", "order_date")}))


@query("src_csv_baskets", f"""WITH {basket._BASKETS}
SELECT order_id, array_to_string(items, ', ') AS items, CAST(item_count AS INTEGER) AS item_count FROM basket""")
def src_csv_baskets(spark, sf_dir):
    folder = scratch_path(spark, "csv")
    files.save_csv(basket._baskets(spark, sf_dir), f"{folder}/baskets.csv")
    return files.load_csv(spark, folder, "baskets.csv", "order_id long, items string, item_count int")


_REPORTED = [*NUMERIC, *TEXT]


def _numeric_sql(c):
    stats = {
        "count": f"count({c})", "mean": f"avg({c})", "std": f"stddev_samp({c})", "min": f"min({c})",
        "q25": f"quantile_cont({c}, 0.25)", "q50": f"quantile_cont({c}, 0.5)", "q75": f"quantile_cont({c}, 0.75)", "max": f"max({c})",
    }
    return " UNION ALL ".join(
        f"SELECT 'numeric_statistics', '{c}', '{n}', round(CAST({e} AS DOUBLE), 4), NULL FROM gaps" for n, e in stats.items())


def _text_sql(c):
    return f"""SELECT 'categorical_statistics', '{c}', 'unique_values', CAST(count(DISTINCT {c}) AS DOUBLE), NULL FROM gaps
UNION ALL SELECT 'categorical_statistics', '{c}', 'top_' || rk, CAST(n AS DOUBLE), {c} FROM (
  SELECT {c}, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {c}) AS rk FROM gaps WHERE {c} IS NOT NULL GROUP BY {c}) WHERE rk <= 5"""


_EDA_SQL = f"""WITH {GAPS}
SELECT 'shape' AS section, CAST(NULL AS VARCHAR) AS "column", 'n_rows' AS name, CAST(count(*) AS DOUBLE) AS number, CAST(NULL AS VARCHAR) AS text FROM gaps
UNION ALL SELECT 'shape', NULL, 'n_columns', {len(_REPORTED)}.0::DOUBLE, NULL
UNION ALL SELECT 'shape', NULL, 'duplicate_rows', CAST((SELECT count(*) FROM gaps)
  - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(_REPORTED)} FROM gaps)) AS DOUBLE), NULL
UNION ALL """ + " UNION ALL ".join(
    f"SELECT 'missing_values', '{c}', 'missing', CAST(count(*) - count({c}) AS DOUBLE), '{'numeric' if c in NUMERIC else 'categorical'}' FROM gaps"
    for c in _REPORTED) + " UNION ALL " + " UNION ALL ".join(_numeric_sql(c) for c in NUMERIC) + " UNION ALL " + " UNION ALL ".join(
    _text_sql(c) for c in TEXT)


@query("rep_eda", _EDA_SQL)
def rep_eda(spark, sf_dir):
    return rounded(report.eda_report(sales_with_gaps(spark, sf_dir, _REPORTED)))


@query("rep_eda_json", _EDA_SQL)
def rep_eda_json(spark, sf_dir):
    path = scratch_path(spark, "report")
    files.save_report(report.eda_report(sales_with_gaps(spark, sf_dir, _REPORTED)), f"{path}.csv")
    schema = 'section string, "column" string, name string, number double, text string'.replace('"', "`")
    return rounded(spark.read.schema(schema).json(f"{path}.json"))


@query("rep_eda_insights", f"""WITH {GAPS}
SELECT 1 AS seq, 'The table has ' || count(*) || ' rows in {len(_REPORTED)} columns' AS text FROM gaps
UNION ALL SELECT 2, ((SELECT count(*) FROM gaps) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(_REPORTED)} FROM gaps)))
  || ' rows repeat another one'""")
def rep_eda_insights(spark, sf_dir):
    return report.eda_insights(sales_with_gaps(spark, sf_dir, _REPORTED))


# Weekly sales of all lines, the last 12 weeks held out.
_WEEKLY = f"{series.series_sql('W', drop_zero_runs=True)}, {series.split_sql(12)}, {series._BOTH}, " \
    "maes AS (SELECT model, avg(abs(y - yhat)) AS mae FROM fc GROUP BY model)"


def _maes(spark, sf_dir):
    parts = timeseries.split(series.prepared(spark, sf_dir, "W"), 12)
    return timeseries.compare_forecasts(series._both(parts)).select("model", "mae")


def _advice_sql(source="rfm"):
    shares = " UNION ALL ".join(
        f"SELECT {i} AS seq, 'segment' AS kind, printf('{s}: %.1f%% of customers - {a}', count(*) * 100.0 / (SELECT count(*) FROM {source})) AS text "
        f"FROM {source} WHERE segment = '{s}' HAVING count(*) > 0" for i, (s, a) in enumerate(report.SEGMENT_ADVICE.items(), 1))
    general = " UNION ALL ".join(f"SELECT {8 + i}, 'general', '{t}'" for i, t in enumerate(report.GENERAL_ADVICE))
    return f"{shares} UNION ALL {general}"


# The RFM, rule and series texts each start from the same sales CTE, which may be named only once.
_RULE_CTES = basket.RULES_SQL[len(SALES):]
_POINT_CTES = clusters._POINTS[len(SALES):]


@query("rep_insights", f"""WITH {SALES}{_POINT_CTES}{_RULE_CTES}, {clusters._PROFILE}, {_WEEKLY}
{_advice_sql()}
UNION ALL SELECT 4, 'rule', printf('Offer %s next to %s (lift %.2f)',
  array_to_string(consequent, ', '), array_to_string(antecedent, ', '), lift) FROM {basket._best('lift', 1)}
UNION ALL (SELECT 5, 'cluster', 'Cluster ' || cluster || ' spends most: make it the premium offers' FROM prof ORDER BY m DESC, cluster LIMIT 1)
UNION ALL (SELECT 6, 'cluster', 'Cluster ' || cluster || ' orders most often: propose a subscription' FROM prof ORDER BY f DESC, cluster LIMIT 1)
UNION ALL (SELECT 7, 'forecast', printf('The best forecast, %s, is off by %.2f on average', model, mae) FROM maes ORDER BY mae, model LIMIT 1)""")
def rep_insights(spark, sf_dir):
    labelled = clusters.segmented(spark, sf_dir)
    return report.actionable_insights(
        labelled, basket.mined_rules(spark, sf_dir), cluster.profiles(labelled, clusters.RAW), _maes(spark, sf_dir))


@query("rep_insights_text", f"""WITH {RFM}, advice AS ({_advice_sql()}
UNION ALL SELECT 11, 'note', 'Insights cover every order line')
SELECT seq || '. ' || text AS line FROM advice""")
def rep_insights_text(spark, sf_dir):
    advice = report.add_insight(report.actionable_insights(rfm_table(spark, sf_dir)), "note", "Insights cover every order line")
    path = scratch_path(spark, "insights")
    files.save_insights(advice, path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("rep_final", f"""WITH {SALES}{RFM[len(SALES):]}, {_WEEKLY}, {metrics._PREDICTIONS}{metrics._PER_CLASS}, {metrics._MACRO},
advice AS ({_advice_sql()})
SELECT 'summary' AS section, 1 AS seq, 'Orders: ' || count(DISTINCT order_id) AS text FROM sales
UNION ALL SELECT 'summary', 2, 'Customers: ' || count(DISTINCT customer_id) FROM sales
UNION ALL SELECT 'summary', 3, 'Sales: $' || format('{{:,.2f}}', round(sum(sales), 2)) FROM sales
UNION ALL SELECT 'summary', 4, 'Profit: $' || format('{{:,.2f}}', round(sum(profit), 2)) FROM sales
UNION ALL SELECT 'findings', seq, text FROM advice
UNION ALL SELECT 'recommendations', seq, text FROM advice
UNION ALL SELECT 'classification', 1, printf('%s: macro F1 %.4f', model, f) FROM acc
UNION ALL SELECT 'forecasting', 1, printf('%s: mean absolute error %.2f', model, mae) FROM maes""")
def rep_final(spark, sf_dir):
    summary = profile.summary_stats(sales_lines(spark, sf_dir, ["order_id", "customer_id", "sales", "profit"]))
    f1 = classification_metrics(metrics.predictions(spark, sf_dir), by=["model"]).where("metric = 'f1_macro'")
    advice = report.actionable_insights(rfm_table(spark, sf_dir))
    return report.final_report(
        rounded(summary, 2), advice, actions=advice,
        classification=f1.select("model", "value"),
        forecasting=_maes(spark, sf_dir).select("model", F.col("mae").alias("value")),
    )


@query("rfm_score_histogram", " UNION ALL ".join(
    (f"WITH {RFM} " if c == "r_score" else "") + f"""SELECT '{c}' AS score, bin, round(lo + bin * ((hi - lo) / 5.0), 4) AS lower,
  round(lo + (bin + 1) * ((hi - lo) / 5.0), 4) AS upper, (SELECT count(*) FROM rfm WHERE least(CAST(floor(({c} - lo) * 5 / (hi - lo)) AS INTEGER), 4) = bin) AS n
  FROM (SELECT CAST(unnest(range(5)) AS INTEGER) AS bin), (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM rfm)"""
    for c in ("r_score", "f_score", "m_score")))
def rfm_score_histogram(spark, sf_dir):
    rfm = rfm_table(spark, sf_dir)
    tables = [profile.histogram(rfm, c, 5).withColumn("score", F.lit(c)) for c in ("r_score", "f_score", "m_score")]
    return rounded(tables[0].unionByName(tables[1]).unionByName(tables[2]))
