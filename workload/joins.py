"""Queries over joins and lookups."""

from pyspark.sql import functions as F

from forecourt import roles
from forecourt.functions.expressions import hours
from forecourt.operators import encoding, joins, series
from forecourt.operators.features import suffix
from forecourt.operators.scaling import fit_scalers
from forecourt.sources import scratch, standins
from forecourt.sources.schemas import CONDITIONS
from workload import base, sql
from workload.registry import query, rounded

IDS = ["station_id", "timestamp"]
INDEXED = ", idx AS (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY timestamp) - 1 AS time_idx FROM facts)"


def indexed_sql(body, extra=""):
    return f"WITH {sql.HOURLY}{INDEXED}{extra} {body}"


@query(
    "facts_with_passport",
    sql.merged(f"SELECT station_id, timestamp, total_traffic, {', '.join(sql.EXTRA)} FROM merged"),
)
def facts_with_passport(spark, folder):
    return base.merged(spark, folder).select(*IDS, "total_traffic", *sql.EXTRA)


@query(
    "duplicate_passport_keys",
    "SELECT o_custkey AS station_id, count(*) AS n_rows FROM orders GROUP BY o_custkey HAVING count(*) > 1",
)
def duplicate_passport_keys(spark, folder):
    orders = standins.table(spark, folder, "orders").select(F.col("o_custkey").alias("station_id"))
    return joins.duplicate_keys(orders)


@query(
    "predictions_with_actuals",
    sql.hourly(
        f"""SELECT p.station_id, p.timestamp, {sql.r('p.sales_AI92', 'sales_AI92_pred')}, {sql.r('a.sales_AI92', 'sales_AI92_actual')}
        FROM (SELECT station_id, timestamp + INTERVAL 24 HOUR AS timestamp, sales_AI92 FROM facts) p
        LEFT JOIN facts a USING (station_id, timestamp)"""
    ),
)
def predictions_with_actuals(spark, folder):
    """Yesterday's sales as forecast; hours past the data have no actual value."""
    facts = base.hourly(spark, folder).select(*IDS, "sales_AI92")
    later = facts.withColumn("timestamp", F.col("timestamp") + hours(24))
    pred, actual = suffix(later, ["sales_AI92"], "_pred"), suffix(facts, ["sales_AI92"], "_actual")
    return rounded(pred.join(actual, IDS, "left"))


@query(
    "origin_timestamps",
    indexed_sql("SELECT station_id, time_idx, timestamp FROM idx WHERE time_idx >= 84"),
)
def origin_timestamps(spark, folder):
    facts = base.indexed(base.hourly(spark, folder).select(*IDS))
    origins = facts.where(F.col("time_idx") >= 84)
    return joins.resolve_origin_ts(origins.select("station_id", "time_idx"), facts)


@query(
    "codes_decoded",
    sql.merged("SELECT station_id, timestamp, weather_condition FROM merged"),
)
def codes_decoded(spark, folder):
    df = base.merged(spark, folder).select(*IDS, "weather_condition")
    labels = scratch.materialise(encoding.fit_labels(df, ["weather_condition"]), "labels")
    coded = encoding.apply_labels(df, labels, ["weather_condition"]).drop("weather_condition")
    return joins.decode(coded, "weather_condition", labels).drop("weather_condition_enc")


@query(
    "holiday_lookup",
    f"""WITH {sql.DAILY_FACTS}, cal AS (SELECT month(timestamp) AS m, day(timestamp) AS d,
      arg_min(holiday_name, (timestamp, station_id)) AS holiday_name FROM daily_facts WHERE is_holiday = 1 GROUP BY 1, 2)
    SELECT o_orderkey, CAST(c.holiday_name IS NOT NULL AS INTEGER) AS is_holiday,
    coalesce(c.holiday_name, '{roles.NO_HOLIDAY}') AS holiday_name
    FROM orders LEFT JOIN cal c ON month(o_orderdate) = m AND day(o_orderdate) = d""",
)
def holiday_lookup(spark, folder):
    calendar = joins.holiday_calendar(standins.daily_facts(spark, folder))
    orders = standins.table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").alias("timestamp"))
    return joins.with_holiday(orders, calendar).select("o_orderkey", "is_holiday", "holiday_name")


@query(
    "season_lookup",
    f"""WITH {sql.DAILY_FACTS}, by_month AS (SELECT month, arg_min(season, (timestamp, station_id)) AS season
      FROM daily_facts GROUP BY month)
    SELECT o_orderkey, season FROM orders LEFT JOIN by_month ON month(o_orderdate) = month""",
)
def season_lookup(spark, folder):
    by_month = joins.first_by_month(standins.daily_facts(spark, folder), "season")
    orders = standins.table(spark, folder, "orders").select("o_orderkey", F.col("o_orderdate").alias("timestamp"))
    return joins.with_season_code(orders, by_month).select("o_orderkey", "season")


_STATS = [("temperature", "temperature"), ("total_traffic", "total_traffic"), ("price_AI92", "price_AI92")]


@query(
    "override_normalised",
    sql.hourly(
        "SELECT station_id, timestamp, column_name AS \"column\", round(value, 6) AS value, round(CASE WHEN std IS NULL THEN NULL WHEN std = 0 THEN 0 ELSE (value - mean) / std END, 6) AS z FROM ("
        + " UNION ALL ".join(
            f"""SELECT f.station_id, f.timestamp, '{c}' AS column_name, CAST(f.{c} AS DOUBLE) AS value, s.mean, s.std FROM facts f LEFT JOIN
            (SELECT station_id, avg({c}) AS mean, stddev_samp({c}) AS std FROM facts
             WHERE timestamp <= TIMESTAMP '{standins.TRAIN_END}' GROUP BY station_id) s USING (station_id) WHERE f.{c} IS NOT NULL"""
            for c, _ in _STATS
        )
        + f""" UNION ALL SELECT station_id, timestamp, 'unknown' AS column_name, CAST(hour AS DOUBLE) AS value, NULL AS mean, NULL AS std FROM facts
        )"""
    ),
)
def override_normalised(spark, folder):
    """Raw values of four columns as overrides; one has no scaler, one has no spread."""
    facts = base.hourly(spark, folder)
    cols = [c for c, _ in _STATS]
    scalers = fit_scalers(facts, cols, standins.TRAIN_END)
    values = facts.select(*IDS, *[F.col(c).cast("double") for c in cols], F.col("hour").cast("double").alias("unknown"))
    long = values.unpivot(IDS, [*cols, "unknown"], "column", "value").where(F.col("value").isNotNull())
    return rounded(joins.normalise_override(long, scalers))


# Conditions of two scenarios; the second lists fewer days than the frame has.
CONDITIONS_ROWS = [
    (1, 0, "frost", 150, 1, 0, 0),
    (1, 1, "snowfall", 100, 0, 1, 0),
    (1, 2, "thaw", 75, 0, 0, 1),
    (2, 0, "normal", 50, 0, 0, 0),
    (2, 1, "storm", 125, 1, 1, 1),
]
CONDITIONS_SQL = (
    "conditions(scenario_id, day, weather, traffic_pct, promo_fuel, promo_shop, ad_active) AS (VALUES "
    + ", ".join(str(r) for r in CONDITIONS_ROWS)
    + ")"
)


def conditions(spark):
    return spark.createDataFrame(CONDITIONS_ROWS, CONDITIONS)


@query(
    "conditions_by_day",
    f"""WITH {sql.HOURLY}, {CONDITIONS_SQL}, frame AS (SELECT station_id, timestamp,
      CAST(date_diff('day', TIMESTAMP '2024-01-28 00:00:00', date_trunc('day', timestamp)) AS INTEGER) AS day
      FROM facts WHERE timestamp >= TIMESTAMP '2024-01-28 00:00:00'),
    ends AS (SELECT CAST(scenario_id AS BIGINT) AS scenario_id, max(day) AS last FROM conditions GROUP BY scenario_id)
    SELECT f.station_id, f.timestamp, f.day, e.scenario_id, c.weather, c.traffic_pct, c.promo_fuel, c.promo_shop, c.ad_active AS _ad
    FROM frame f CROSS JOIN ends e JOIN conditions c ON c.scenario_id = e.scenario_id AND c.day = least(f.day, e.last)""",
)
def conditions_by_day(spark, folder):
    start = F.lit("2024-01-28 00:00:00").cast("timestamp_ntz")
    facts = base.hourly(spark, folder).where(F.col("timestamp") >= start)
    day = F.datediff(F.to_date("timestamp"), F.to_date(start)).alias("day")
    return joins.apply_conditions(facts.select(*IDS, day), conditions(spark))


PRESETS_SQL = (
    f"presets(weather, {', '.join(roles.PRESET_FIELDS)}) AS (VALUES "
    + ", ".join(
        "(" + repr(n) + ", " + ", ".join(f"{x}::DOUBLE" if isinstance(x, float) else str(x) for x in v) + ")"
        for n, v in roles.WEATHER_PRESETS.items()
    )
    + ")"
)


@query(
    "weather_presets",
    f"""WITH {sql.HOURLY}, {PRESETS_SQL}, named AS (SELECT station_id, timestamp,
      CASE hour % 5 WHEN 0 THEN 'frost' WHEN 1 THEN 'snowfall' WHEN 2 THEN 'thaw' WHEN 3 THEN 'normal' ELSE 'storm' END AS weather FROM facts)
    SELECT n.station_id, n.timestamp, n.weather, {', '.join('p.' + f for f in roles.PRESET_FIELDS)} FROM named n
    JOIN presets p ON p.weather = CASE WHEN n.weather IN (SELECT weather FROM presets) THEN n.weather ELSE '{roles.DEFAULT_PRESET}' END""",
)
def weather_presets(spark, folder):
    """A name that is no preset gets the usual weather."""
    facts = base.hourly(spark, folder)
    names = F.array(*[F.lit(n) for n in ("frost", "snowfall", "thaw", "normal", "storm")])
    named = facts.select(*IDS, *roles.PRESET_FIELDS, names[F.col("hour") % 5].alias("weather"))
    return joins.with_preset(named, joins.preset_table(spark))


@query(
    "station_labels",
    sql.merged(
        """SELECT station_name, min(station_id) AS station_id, min(road_type) AS road_type,
        station_name || '  ·  ' || min(road_type) AS label FROM merged GROUP BY station_name"""
    ),
)
def station_labels(spark, folder):
    return joins.station_labels(base.merged(spark, folder))


@query(
    "horizon_expanded",
    indexed_sql(
        """SELECT station_id, time_idx AS origin_idx, h AS horizon_h, timestamp + to_hours(h - 1) AS timestamp
        FROM (SELECT *, CAST(unnest(range(1, 25)) AS INTEGER) AS h FROM idx WHERE time_idx >= 84)"""
    ),
)
def horizon_expanded(spark, folder):
    facts = base.indexed(base.hourly(spark, folder).select(*IDS)).where(F.col("time_idx") >= 84)
    steps = joins.expand_horizon(facts)
    return steps.select(
        "station_id",
        F.col("time_idx").alias("origin_idx"),
        "horizon_h",
        (F.col("timestamp") + hours(F.col("horizon_h") - 1)).alias("timestamp"),
    )


@query(
    "encoder_history",
    indexed_sql(
        f"""SELECT station_id, timestamp, CAST(count(*) OVER w AS INTEGER) AS encoder_length, {sql.r('avg(total_traffic) OVER w', 'total_traffic_mean')},
        last(total_traffic) OVER w AS total_traffic_last, {sql.r('avg(sales_AI92) OVER w', 'sales_AI92_mean')}, {sql.r('last(sales_AI92) OVER w', 'sales_AI92_last')} FROM idx
        WINDOW w AS (PARTITION BY station_id ORDER BY time_idx ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING)"""
    ),
)
def encoder_history(spark, folder):
    facts = base.indexed(base.hourly(spark, folder).select(*IDS, "total_traffic", "sales_AI92"))
    stats = series.encoder_stats(facts, ["total_traffic", "sales_AI92"])
    names = [f"{c}_{s}" for c in ("total_traffic", "sales_AI92") for s in ("mean", "last")]
    return rounded(stats.select(*IDS, "encoder_length", *names))


@query(
    "encoder_rows_by_origin",
    indexed_sql(
        f"""SELECT o.station_id, o.time_idx AS origin_idx, count(*) AS n_rows, {sql.r('sum(h.total_traffic * (o.time_idx - h.time_idx))', 'weighted_traffic')}
        FROM idx o JOIN idx h ON h.station_id = o.station_id AND h.time_idx BETWEEN o.time_idx - 168 AND o.time_idx - 1
        WHERE o.time_idx >= 84 GROUP BY ALL"""
    ),
)
def encoder_rows_by_origin(spark, folder):
    facts = base.indexed(base.hourly(spark, folder).select(*IDS, "total_traffic"))
    rows = series.encoder_rows(facts, facts.where(F.col("time_idx") >= 84))
    out = rows.groupBy("station_id", "origin_idx").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("total_traffic") * F.col("lag_h")).cast("double").alias("weighted_traffic"),
    )
    return rounded(out)
