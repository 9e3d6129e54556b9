"""Profiles and cleaning reports read the order lines once."""

import time

import numpy as np
import pytest

import __spark_entry__ as entry
from shelfwise.functions import quantiles
from shelfwise.operators import profile, report
from shelfwise.plans.common import sales_with_gaps
from shelfwise.sources.tables import NUMERIC, TEXT

SF_DIR = "/root/testdata/sf0.001"


def line_scans(spark, run):
    """How many executed plans' scans read the lines, eager passes included."""
    store = spark._jsparkSession.sharedState().statusStore()
    bus = spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty(30_000)
    known = {store.executionsList().apply(i).executionId() for i in range(store.executionsList().size())}
    run()
    bus.waitUntilEmpty(30_000)
    time.sleep(0.5)
    executions, found = store.executionsList(), 0
    for i in range(executions.size()):
        id = executions.apply(i).executionId()
        if id not in known:
            nodes = store.planGraph(id).allNodes()
            found += sum("Scan parquet" in nodes.apply(j).name() and "lineitem.parquet" in nodes.apply(j).desc() for j in range(nodes.size()))
    return found


@pytest.mark.parametrize("name", ["eda_inspect", "eda_column_info", "eda_describe", "eda_overview", "rep_eda", "cln_report", "cln_full_preprocessing"])
def test_lines_are_read_once(spark, name):
    assert line_scans(spark, lambda: entry.queries()[name](spark, SF_DIR).collect()) == 1


def test_scans_are_counted(spark):
    lines = sales_with_gaps(spark, SF_DIR, ["quantity"])
    assert line_scans(spark, lambda: (lines.count(), lines.agg({"quantity": "sum"}).collect())) == 2


def test_overview_sketches(spark):
    lines = sales_with_gaps(spark, SF_DIR)
    got = {r["column"]: r for r in profile.overview(lines).collect()}
    pdf = lines.toPandas()
    assert set(got) == set(lines.columns)
    for c in ("quantity", "sales", "profit", "discount"):
        ranks = pdf[c].dropna().rank(pct=True)
        for q, share in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
            at = ranks[pdf[c].dropna() == got[c][q]]
            assert len(at) and abs(at - share).min() < 0.25 if c in ("quantity", "discount") else abs(at - share).min() < 0.01
        assert float(got[c]["smallest"]) == pdf[c].min() and float(got[c]["largest"]) == pdf[c].max()
    for c in lines.columns:
        assert abs(got[c]["distinct"] - pdf[c].nunique()) <= 0.08 * pdf[c].nunique() + 1
        assert got[c]["nulls"] == pdf[c].isna().sum()
    assert got["category"]["mean"] is None and got["category"]["q50"] is None
    nothing = {r["column"]: r for r in profile.overview(lines.where("false")).collect()}
    assert nothing["sales"]["rows"] == 0 and nothing["sales"]["mean"] is None and np.all([r["nulls"] == 0 for r in nothing.values()])


def test_values_are_counted_once(spark):
    plan = profile.column_info(sales_with_gaps(spark, SF_DIR))
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    final = text[: text.index("== Initial Plan ==")]
    assert final.count("Generate inline") == 1 and "ReusedExchange" in final


def test_report_counts_values_once_and_writes_them_once(spark, monkeypatch):
    wrote = []
    for module in (profile, quantiles, report):
        monkeypatch.setattr(module, "cut", lambda df, cut=module.cut: wrote.append(df.columns) or cut(df))
    monkeypatch.setattr(quantiles.exact_quantiles, "__kwdefaults__", {**quantiles.exact_quantiles.__kwdefaults__, "small": 500})
    lines = sales_with_gaps(spark, SF_DIR, [*NUMERIC, *TEXT])
    plan = report.eda_report(lines)
    assert [*NUMERIC, *TEXT] in wrote and [*NUMERIC] not in wrote
    top = profile.top_values(lines)
    top.collect()
    text = top._jdf.queryExecution().executedPlan().toString()
    final = text[: text.index("== Initial Plan ==")]
    assert final.count("Generate inline") == 1 and "ReusedExchange" in final
    quartiles = {r["column"]: r["number"] for r in plan.where("name = 'q50'").collect()}
    medians = lines.toPandas()[NUMERIC].median()
    assert all(quartiles[c] == pytest.approx(medians[c]) for c in NUMERIC)
