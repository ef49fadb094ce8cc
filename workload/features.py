"""Queries over projections and derived columns."""

from pyspark.sql import functions as F

from forecourt import roles
from forecourt.functions import calendar, labels
from forecourt.operators import features, joins
from workload import base, sql
from workload.registry import query, rounded

IDS = ["station_id", "timestamp"]


_LEFT = [c for c in sql.MERGED_TYPES if c not in roles.REDUNDANT]


@query(
    "redundant_columns_dropped",
    sql.merged(f"SELECT {', '.join(sql.r(c, c) if sql.MERGED_TYPES[c] == 'double' else c for c in _LEFT)} FROM merged"),
)
def redundant_columns_dropped(spark, folder):
    return rounded(features.drop_redundant(base.merged(spark, folder)))


@query(
    "nulls_filled",
    sql.merged(
        f"SELECT station_id, timestamp, coalesce(holiday_name, '{roles.NO_HOLIDAY}') AS holiday_name, "
        f"coalesce(ad_channel, '{roles.NO_ADVERT}') AS ad_channel FROM merged"
    ),
)
def nulls_filled(spark, folder):
    return features.fill_missing(base.merged(spark, folder)).select(*IDS, "holiday_name", "ad_channel")


@query(
    "shop_open_flag",
    sql.hourly("SELECT station_id, timestamp, CAST(hour BETWEEN 5 AND 21 AS INTEGER) AS is_shop_open FROM facts"),
)
def shop_open_flag(spark, folder):
    return calendar.with_shop_open(base.hourly(spark, folder)).select(*IDS, "is_shop_open")


@query(
    "row_sums",
    sql.hub(
        f"""SELECT station_id, timestamp, {sql.r('total_fuel_sales', 'total_fuel_sales')},
        {sql.r('shop_total_revenue', 'shop_total_revenue')}, total_traffic,
        {sql.r('total_sales', 'total_sales')}, {sql.r('total_shop_sales', 'total_shop_sales')},
        {sql.r(sql.total(roles.TRUCKS), 'trucks')} FROM hub"""
    ),
)
def row_sums(spark, folder):
    hub = features.with_row_sum(base.hub(spark, folder), "trucks", roles.TRUCKS)
    cols = ["total_fuel_sales", "shop_total_revenue", "total_traffic", "total_sales", "total_shop_sales"]
    return rounded(hub.select(*IDS, *cols, "trucks"))


@query(
    "price_ratios",
    sql.hub(f"SELECT station_id, timestamp, {', '.join(sql.r(c, c) for c in roles.PRICE_RATIOS)} FROM hub"),
)
def price_ratios(spark, folder):
    return rounded(base.hub(spark, folder).select(*IDS, *roles.PRICE_RATIOS))


_CYCLES = ", ".join(
    f"{sql.r(f'sin({c} * (2 * pi()) / {p})', c + '_sin')}, {sql.r(f'cos({c} * (2 * pi()) / {p})', c + '_cos')}"
    for c, p in roles.CYCLE_PERIODS.items()
)


@query("cyclical_columns", sql.hourly(f"SELECT station_id, timestamp, {_CYCLES} FROM facts"))
def cyclical_columns(spark, folder):
    names = [f"{c}_{f}" for c in roles.CYCLE_PERIODS for f in ("sin", "cos")]
    return rounded(features.add_cyclical(base.hourly(spark, folder)).select(*IDS, *names))


@query(
    "cyclical_columns_daily",
    sql.daily(f"SELECT station_id, timestamp, {_CYCLES} FROM daily"),
)
def cyclical_columns_daily(spark, folder):
    names = [f"{c}_{f}" for c in roles.CYCLE_PERIODS for f in ("sin", "cos")]
    return rounded(features.add_cyclical(base.daily(spark, folder)).select(*IDS, *names))


@query(
    "log_targets",
    sql.hourly(
        "SELECT station_id, timestamp, "
        + ", ".join(f"{sql.r(f'ln(1 + {t})', t)}, {sql.r(t, t + '_orig')}" for t in roles.TARGETS)
        + " FROM facts"
    ),
)
def log_targets(spark, folder):
    both = [*roles.TARGETS, *[t + "_orig" for t in roles.TARGETS]]
    return rounded(features.log_targets(base.hourly(spark, folder)).select(*IDS, *both))


@query(
    "log_targets_inverted",
    sql.hourly(
        "SELECT station_id, timestamp, "
        + ", ".join(sql.r(f"exp(greatest(ln(1 + {t}) - 1, 0)) - 1", t) for t in roles.TARGETS)
        + " FROM facts"
    ),
)
def log_targets_inverted(spark, folder):
    logs = features.log_targets(base.hourly(spark, folder))
    shifted = logs.withColumns({t: F.col(t) - 1 for t in roles.TARGETS})
    return rounded(features.exp_targets(shifted).select(*IDS, *roles.TARGETS))


@query(
    "order_calendar",
    """SELECT o_orderkey, CAST(hour(o_orderdate) AS INTEGER) AS hour, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS day_of_week,
    CAST(weekofyear(o_orderdate) AS INTEGER) AS week_of_year, CAST(month(o_orderdate) AS INTEGER) AS month,
    CAST(day(o_orderdate) AS INTEGER) AS day, CAST(o_orderdate AS DATE) AS date FROM orders""",
)
def order_calendar(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_orderdate")
    return calendar.with_calendar(orders, "o_orderdate").drop("o_orderdate")


@query(
    "calendar_flags",
    """SELECT event_id, CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend,
    CAST(hour(ts) IN (7, 8, 9, 17, 18, 19) AS INTEGER) AS is_rush_hour,
    CAST(hour(ts) < 6 OR hour(ts) >= 22 AS INTEGER) AS is_night FROM events""",
)
def calendar_flags(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet").select("event_id", "ts")
    flags = calendar.with_calendar_flags(calendar.with_calendar(events, "ts"))
    return flags.select("event_id", "is_weekend", "is_rush_hour", "is_night")


@query(
    "order_seasons",
    """SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter'
    WHEN month(o_orderdate) IN (3, 4, 5) THEN 'spring' WHEN month(o_orderdate) IN (6, 7, 8) THEN 'summer'
    ELSE 'autumn' END AS season, CAST(quarter(o_orderdate) AS INTEGER) AS quarter, dayname(o_orderdate) AS day_name FROM orders""",
)
def order_seasons(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_orderdate")
    return calendar.with_season(orders, "o_orderdate").drop("o_orderdate")


@query(
    "code_labels",
    sql.daily(
        f"""SELECT DISTINCT month, day_of_week, season, {sql.case_label('month', labels.MONTH)} AS month_label,
        {sql.case_label('day_of_week', {k: v for k, v in labels.WEEKDAY.items() if k < 6})} AS weekday_label,
        {sql.case_label('season', labels.SEASON)} AS season_label FROM daily"""
    ),
)
def code_labels(spark, folder):
    """Sunday has no label here, so it keeps its code."""
    df = base.daily(spark, folder).select("month", "day_of_week", "season").distinct()
    df = labels.with_label(df, "month", labels.MONTH, "month_label")
    six = {k: v for k, v in labels.WEEKDAY.items() if k < 6}
    df = labels.with_label(df, "day_of_week", six, "weekday_label")
    return labels.with_label(df, "season", labels.SEASON, "season_label")


@query(
    "targets_long",
    sql.hourly(
        f"SELECT station_id, timestamp, target, {sql.r('y', 'y')} FROM (SELECT station_id, timestamp, {', '.join(roles.TARGETS)} FROM facts) "
        f"UNPIVOT (y FOR target IN ({', '.join(roles.TARGETS)}))"
    ),
)
def targets_long(spark, folder):
    return rounded(features.to_long(base.hourly(spark, folder), IDS, roles.TARGETS, "target", "y"))


@query(
    "suffix_rename",
    sql.hourly(
        "SELECT station_id, timestamp, "
        + ", ".join(sql.r(t, t + "_actual") for t in roles.TARGETS)
        + " FROM facts"
    ),
)
def suffix_rename(spark, folder):
    facts = base.hourly(spark, folder).select(*IDS, *roles.TARGETS)
    return rounded(features.suffix(facts, roles.TARGETS, "_actual"))


@query(
    "normalised_types",
    sql.merged(
        """SELECT timestamp, CAST(station_id AS VARCHAR) AS station_id, CAST(is_rain AS VARCHAR) AS is_rain, direction,
        CAST(CAST(k AS BIGINT) AS VARCHAR) AS whole, CAST(total_traffic AS DOUBLE) AS total_traffic FROM
        (SELECT *, total_traffic AS k FROM merged)"""
    ),
)
def normalised_types(spark, folder):
    df = base.merged(spark, folder).withColumn("whole", F.col("total_traffic").cast("double").cast("string"))
    df = df.select("timestamp", "station_id", "is_rain", "direction", "whole", "total_traffic")
    return features.normalise_types(df, ["station_id"], ["is_rain", "direction", "whole"], ["total_traffic"])


_CLASSED = [c for c in sql.NUMERIC if c != "station_id"]
_CLASSES = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", bool_and({c} IN (0, 1) OR {c} IS NULL) AS is_binary,
    (SELECT bool_and(same) FROM (SELECT coalesce(max({c}) = min({c}), TRUE) AS same FROM merged GROUP BY station_id)) AS is_constant
    FROM merged"""
    for c in _CLASSED
)


@query("column_classes", sql.merged(_CLASSES))
def column_classes(spark, folder):
    return features.classify_columns(base.merged(spark, folder))


@query(
    "clamped_category",
    sql.merged(
        "SELECT station_id, timestamp, CASE WHEN weather_condition IN ('clear', 'rain', 'fog') THEN weather_condition "
        "ELSE (SELECT min(weather_condition) FROM merged WHERE weather_condition IN ('clear', 'rain', 'fog')) END "
        "AS weather_condition FROM merged"
    ),
)
def clamped_category(spark, folder):
    df = base.merged(spark, folder).select(*IDS, "weather_condition")
    known = df.where(F.col("weather_condition").isin("clear", "rain", "fog"))
    known = known.select(F.col("weather_condition").alias("value")).distinct()
    return joins.clamp_category(df, "weather_condition", known)


@query(
    "category_derived_by_month",
    sql.daily(
        "SELECT d.station_id, d.timestamp, coalesce(f.settlement_size, 'none') AS settlement_size "
        "FROM daily d LEFT JOIN first f USING (month)",
        ", first AS (SELECT month, arg_min(settlement_size, (timestamp, station_id)) AS settlement_size FROM daily "
        "WHERE year(timestamp) < 1998 GROUP BY month)",
    ),
)
def category_derived_by_month(spark, folder):
    df = base.daily(spark, folder).select(*IDS, "settlement_size")
    early = df.where(F.year("timestamp") < 1998)
    return joins.derive_by_month(df.drop("settlement_size"), early, "settlement_size", "none")


@query(
    "price_delta",
    sql.merged(
        f"SELECT station_id, timestamp, {sql.r('CASE WHEN base_price_AI95 <> 0 THEN (price_AI95 - base_price_AI95) / base_price_AI95 * 100 END', 'price_delta_pct')} FROM merged"
    ),
)
def price_delta(spark, folder):
    df = features.with_price_delta(base.merged(spark, folder), "price_AI95", "base_price_AI95")
    return rounded(df.select(*IDS, "price_delta_pct"))


@query(
    "error_column",
    sql.hourly(f"SELECT station_id, timestamp, {sql.r('sales_AI95 - sales_AI92', 'error')} FROM facts"),
)
def error_column(spark, folder):
    df = features.with_error(base.hourly(spark, folder), "sales_AI95", "sales_AI92")
    return rounded(df.select(*IDS, "error"))
