"""The registry and the plans of its queries."""

import re

import __spark_entry__ as entry
from conftest import SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 130


def test_flagship_query(spark):
    df = entry.entry(spark)
    assert df.columns == ["hour", "weekday", "sales", "label"]
    assert df.count() == 168


def test_plans_stay_in_the_jvm_without_cartesian_products(spark):
    names = ["kpis", "hour_dow_heatmap", "recommend_hour", "window_samples", "trends", "seasonal_forecast", "lag_profile", "histogram_raw"]
    for name in names:
        text = plan(entry.queries()[name](spark, SMALL))
        assert not re.search("CartesianProduct|BatchEvalPython|ArrowEvalPython|MapInArrow|NestedLoop", text), name


def test_scans_read_only_what_a_query_needs(spark):
    text = plan(entry.queries()["rows_per_station"](spark, SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas and all("value" not in s and "props" not in s for s in schemas)


def test_bracket_sizes_come_from_written_files(spark):
    text = plan(entry.queries()["station_value_median"](spark, SMALL))
    assert "brackets-" in text
