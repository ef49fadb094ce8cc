"""Queries over data quality."""

from pyspark.sql import functions as F

from forecourt import roles
from forecourt.operators import features, quality
from forecourt.sources import standins
from workload import base, sql
from workload.registry import query, rounded

NULL_COLUMNS = list(sql.MERGED_TYPES)


def nulls_sql(fill=False):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_null FROM merged" for c in NULL_COLUMNS
    )


@query("null_report", sql.merged(f"SELECT * FROM ({nulls_sql()}) WHERE n_null > 0"))
def null_report(spark, folder):
    return quality.null_report(base.merged(spark, folder))


@query(
    "null_change",
    sql.merged(
        f"""SELECT "column", n_null AS n_before, CASE WHEN "column" IN ('ad_channel', 'holiday_name') THEN 0 ELSE n_null END AS n_after
        FROM ({nulls_sql()}) WHERE n_null > 0"""
    ),
)
def null_change(spark, folder):
    before = base.merged(spark, folder)
    return quality.null_change(before, features.fill_missing(before))


PROFILED = sql.MERGED_TYPES


def _examples(c, n):
    return f"""(SELECT string_agg(v, ', ' ORDER BY rk) FROM (SELECT substring(CAST({c} AS VARCHAR), 1, 22) AS v,
      row_number() OVER (ORDER BY min((timestamp, station_id)), CAST({c} AS VARCHAR)) AS rk FROM merged WHERE {c} IS NOT NULL GROUP BY {c}) WHERE rk <= {n})"""


def _profile():
    parts = []
    for i, (c, kind) in enumerate(PROFILED.items()):
        if kind == "string":
            span = f"{_examples(c, 3)} || CASE WHEN count(DISTINCT {c}) > 3 THEN ', ...' ELSE '' END"
        else:
            span = f"'[' || CAST(min({c}) AS VARCHAR) || ', ' || CAST(max({c}) AS VARCHAR) || ']'"
        parts.append(
            f"""SELECT {i + 1} AS position, '{c}' AS "column", '{kind}' AS dtype, count(DISTINCT {c}) AS n_distinct,
            count(*) - count({c}) AS n_null, {span} AS span FROM merged"""
        )
    return sql.merged(" UNION ALL ".join(parts))


@query("column_profile", _profile())
def column_profile(spark, folder):
    return quality.column_profile(base.merged_table(spark, folder))


CATALOG = list(sql.MERGED_TYPES)
DESCRIPTIONS = {"timestamp": "hour of the row", "station_id": "station key", "ad_channel": "advertising channel", "season": "season of the month"}


@query(
    "column_catalog",
    sql.merged(
        " UNION ALL ".join(
            f"""SELECT {i + 1} AS position, '{c}' AS "column", '{DESCRIPTIONS.get(c, '-')}' AS description,
            {_examples(c, 3)} || CASE WHEN count(DISTINCT {c}) > 3 THEN ', ...' ELSE '' END AS examples FROM merged"""
            for i, c in enumerate(CATALOG)
        )
    ),
)
def column_catalog(spark, folder):
    return quality.column_catalog(base.merged_table(spark, folder), DESCRIPTIONS)


TOTALS = {
    "total_pumps": roles.PUMPS,
    "total_fuel_sales": roles.FUEL_TARGETS,
    "shop_total_revenue": roles.SHOP_TARGETS,
    "total_traffic": roles.TRAFFIC,
}


def _gap(total, parts):
    return f"abs(CAST({total} AS DOUBLE) - {sql.total(parts)})"


@query(
    "totals_reconciled",
    sql.hub(
        " UNION ALL ".join(
            f"""SELECT '{t}' AS total, count({t}) AS n_rows, count(CASE WHEN {_gap(t, p)} > 1e-6 THEN 1 END) AS n_mismatch,
            {sql.r(f'coalesce(sum(CASE WHEN {_gap(t, p)} > 1e-6 THEN {_gap(t, p)} END), 0)', 'gap_sum')}, {sql.r(f'max({_gap(t, p)})', 'gap_max')} FROM hub"""
            for t, p in TOTALS.items()
        )
    ),
)
def totals_reconciled(spark, folder):
    return rounded(quality.reconcile(base.hub(spark, folder), TOTALS))


_CLASSES = ["road_type", "direction", "settlement_size", "season", "weather_condition", "ad_channel", "holiday_name", "station_id"]


@query(
    "class_counts",
    sql.merged(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_classes FROM merged" for c in _CLASSES)),
)
def class_counts(spark, folder):
    return quality.class_counts(base.merged(spark, folder), _CLASSES)


@query(
    "gap_report",
    sql.hourly(
        """SELECT station_id, count(*) AS n_hours, date_diff('hour', min(timestamp), max(timestamp)) + 1 AS expected_hours,
        date_diff('hour', min(timestamp), max(timestamp)) + 1 - count(*) AS missing_hours FROM busy GROUP BY station_id"""
    ),
)
def gap_report(spark, folder):
    from forecourt.functions.expressions import hour_start
    from forecourt.operators.series import gap_report as report

    events = standins.table(spark, folder, "events")
    hours = events.select(
        standins.station_of("user_id").alias("station_id"), hour_start("ts").alias("timestamp")
    ).distinct()
    return report(hours)


@query(
    "hourly_spine",
    sql.hourly("SELECT station_id, timestamp, total_traffic, ad_channel FROM facts"),
)
def hourly_spine(spark, folder):
    """Gaps cut into the facts and filled again."""
    from forecourt.operators.series import hourly_spine as fill

    facts = base.hourly(spark, folder).select("station_id", "timestamp", "total_traffic", "ad_channel")
    edges = facts.groupBy("station_id").agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b"))
    cut = facts.join(edges, "station_id").where(
        (F.col("total_traffic") > 0) | F.col("timestamp").isin(F.col("a"), F.col("b"))
    )
    return fill(cut.drop("a", "b"), ["total_traffic"])
