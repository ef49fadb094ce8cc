"""Queries over future frames, scenarios and rolling forecasts."""

from pyspark.sql import functions as F

from forecourt import roles
from forecourt.operators.features import with_price_delta
from forecourt.plans import forecast as fc
from forecourt.plans import recommend
from forecourt.plans import scenario as sc
from forecourt.sources import scratch, standins
from workload import base, sql
from workload.joins import CONDITIONS_SQL, PRESETS_SQL, conditions
from workload.registry import query, rounded

START = standins.TEST_START
DAYS = 7
TRAIN = f"timestamp <= TIMESTAMP '{standins.TRAIN_END}'"
Q = roles.QUANTILE_NAMES
TARGETS = roles.TARGETS
DRIVERS = ["total_traffic", "promotion_fuel_active", "promotion_shop_active", "ad_active", "temperature"]
PRICE_PCT = {1: 110, 2: 95}



def future_sql(days):
    return f""", past AS (SELECT * FROM facts WHERE timestamp < TIMESTAMP '{START}'),
  tmpl AS (SELECT * FROM past QUALIFY row_number() OVER (PARTITION BY station_id, hour ORDER BY timestamp DESC) = 1),
  hol AS (SELECT month, day(timestamp) AS d, arg_min(holiday_name, (timestamp, station_id)) AS holiday_name FROM facts WHERE is_holiday = 1 GROUP BY 1, 2),
  sea AS (SELECT month, arg_min(season, (timestamp, station_id)) AS season FROM facts GROUP BY month),
  hrs AS (SELECT station_id, n, CAST(unnest(range(0, {days * 24})) AS INTEGER) AS h FROM (SELECT station_id, count(*) AS n FROM past GROUP BY station_id)),
  cal AS (SELECT station_id, n + h AS time_idx, CAST(h // 24 AS INTEGER) AS day, TIMESTAMP '{START}' + to_hours(h) AS timestamp FROM hrs),
  frame AS (SELECT t.* EXCLUDE (timestamp, day_of_week, week_of_year, month, is_weekend, is_rush_hour, is_night, is_holiday, holiday_name, season),
    c.time_idx, c.day, c.timestamp, CAST(isodow(c.timestamp) - 1 AS INTEGER) AS day_of_week, CAST(weekofyear(c.timestamp) AS INTEGER) AS week_of_year,
    CAST(month(c.timestamp) AS INTEGER) AS month, CAST(isodow(c.timestamp) >= 6 AS INTEGER) AS is_weekend,
    CAST(t.hour IN (7, 8, 9, 17, 18, 19) AS INTEGER) AS is_rush_hour, CAST(t.hour < 6 OR t.hour >= 22 AS INTEGER) AS is_night,
    CAST(t.hour BETWEEN 5 AND 21 AS INTEGER) AS is_shop_open, CAST(hol.holiday_name IS NOT NULL AS INTEGER) AS is_holiday,
    coalesce(hol.holiday_name, '{roles.NO_HOLIDAY}') AS holiday_name, coalesce(sea.season, t.season) AS season
    FROM cal c JOIN tmpl t ON t.station_id = c.station_id AND t.hour = hour(c.timestamp)
    LEFT JOIN hol ON hol.month = month(c.timestamp) AND hol.d = day(c.timestamp) LEFT JOIN sea ON sea.month = month(c.timestamp))"""


FRAME = future_sql(DAYS)
_TRAFFIC = roles.TRAFFIC + ["total_traffic"]
APPLIED = f""", {CONDITIONS_SQL}, {PRESETS_SQL},
  ends AS (SELECT CAST(scenario_id AS BIGINT) AS scenario_id, max(day) AS last FROM conditions GROUP BY scenario_id),
  applied AS (SELECT e.scenario_id, f.station_id, f.timestamp, f.day, f.hour, f.is_weekend, c.weather,
    {', '.join(f'f.{t} * (c.traffic_pct / 100.0::DOUBLE) AS {t}' for t in _TRAFFIC)},
    c.promo_fuel AS promotion_fuel_active, c.promo_shop AS promotion_shop_active, c.ad_active,
    {', '.join('p.' + x for x in roles.PRESET_FIELDS)},
    {', '.join(f"f.{x} * (CASE e.scenario_id WHEN 1 THEN 110 ELSE 95 END) / 100 AS {x}" for x in roles.PRICES)}
    FROM frame f CROSS JOIN ends e JOIN conditions c ON c.scenario_id = e.scenario_id AND c.day = least(f.day, e.last)
    JOIN presets p ON p.weather = CASE WHEN c.weather IN (SELECT weather FROM presets) THEN c.weather ELSE '{roles.DEFAULT_PRESET}' END)"""

_LIST = ", ".join(TARGETS)
MODEL = f""", long AS (SELECT * FROM (SELECT station_id, timestamp, is_weekend, hour, {', '.join(DRIVERS)}, {_LIST} FROM facts WHERE {TRAIN}) UNPIVOT (y FOR target IN ({_LIST}))),
  model AS (SELECT station_id, is_weekend, hour, target, {', '.join(f'q[{i + 1}] AS {n}' for i, n in enumerate(Q))} FROM (
    SELECT station_id, is_weekend, hour, target, quantile_cont(ln(1 + y), {roles.QUANTILES}) AS q FROM long GROUP BY ALL)),
  fitted AS (SELECT l.*, ln(1 + y) - q50 AS rest FROM long l JOIN model USING (station_id, is_weekend, hour, target)),
  eff AS (SELECT station_id, target, {', '.join(f"coalesce({sql.null_nan(f'regr_slope(rest, CAST({d} AS DOUBLE))')}, 0) AS s_{d}, coalesce(avg({d}), 0) AS c_{d}" for d in DRIVERS)}
    FROM fitted GROUP BY station_id, target)"""


def _forecast(name, source, extra):
    shift = " + ".join(f"coalesce(e.s_{d} * (CAST(f.{d} AS DOUBLE) - e.c_{d}), 0)" for d in DRIVERS)
    return f""", {name} AS (SELECT {extra} f.station_id, f.timestamp, f.day, m.target,
      {', '.join(f'exp(greatest(m.{n} + {shift}, 0)) - 1 AS {p}' for n, p in (('q10', 'p10'), ('q50', 'p50'), ('q90', 'p90')))}
      FROM {source} f JOIN model m USING (station_id, is_weekend, hour) JOIN eff e ON e.station_id = f.station_id AND e.target = m.target)"""


RUNS = _forecast("result", "applied", "f.scenario_id,") + _forecast("base", "frame", "")


def frame_sql(body, *parts):
    return f"WITH {sql.HOURLY}{FRAME}{''.join(parts)} {body}"


def run_sql(body):
    return frame_sql(body, APPLIED, MODEL, RUNS)


def priced(spark):
    pct = F.when(F.col("scenario_id") == 1, PRICE_PCT[1]).otherwise(PRICE_PCT[2])
    return conditions(spark).withColumn("price_pct", pct)


def parts(spark, folder):
    """Facts, future frame and scenario frame; the facts are written once."""
    facts = scratch.materialise(base.hourly(spark, folder), "facts")
    frame = sc.future_frame(facts, START, DAYS * 24)
    return facts, frame, sc.apply_scenario(frame, priced(spark))


def runs(spark, folder):
    """Scenario forecasts and the base forecast, in natural units."""
    facts, frame, applied = parts(spark, folder)
    train = base.train_rows(facts)
    model = scratch.materialise(fc.fit_seasonal(train, TARGETS), "model")
    effects = scratch.materialise(fc.fit_effects(train, model, DRIVERS), "effects")
    result = fc.forecast_seasonal(model, applied, effects, DRIVERS, ("scenario_id", "day"))
    usual = fc.forecast_seasonal(model, frame, effects, DRIVERS, ("day",))
    return sc.natural_units(result), sc.natural_units(usual)


_CAL = ["time_idx", "day", "hour", "day_of_week", "week_of_year", "month", "is_weekend", "is_rush_hour", "is_night", "is_shop_open", "is_holiday", "holiday_name", "season", "total_traffic", "ad_channel"]


@query(
    "future_frame",
    frame_sql(
        f"SELECT station_id, timestamp, {', '.join(_CAL)}, {sql.r('temperature', 'temperature')}, {sql.r('price_AI92', 'price_AI92')}, 0.0::DOUBLE AS sales_AI92 FROM frame"
    ),
)
def future_frame(spark, folder):
    frame = sc.future_frame(base.hourly(spark, folder), START, DAYS * 24)
    return rounded(frame.select("station_id", "timestamp", *_CAL, "temperature", "price_AI92", "sales_AI92"))


@query(
    "scenario_applied",
    frame_sql(
        "SELECT scenario_id, station_id, timestamp, weather, promotion_fuel_active, promotion_shop_active, ad_active, "
        + ", ".join(sql.r(c, c) for c in [*_TRAFFIC, *roles.PRICES, *roles.WEATHER_REALS])
        + f", {', '.join(roles.WEATHER_FLAGS)} FROM applied",
        APPLIED,
    ),
)
def scenario_applied(spark, folder):
    frame = sc.future_frame(base.hourly(spark, folder), START, DAYS * 24)
    applied = sc.apply_scenario(frame, priced(spark))
    cols = ["scenario_id", "station_id", "timestamp", "weather", "promotion_fuel_active", "promotion_shop_active", "ad_active"]
    return rounded(applied.select(*cols, *_TRAFFIC, *roles.PRICES, *roles.WEATHER_REALS, *roles.WEATHER_FLAGS))


@query(
    "scenario_price_delta",
    frame_sql(
        f"SELECT scenario_id, station_id, {sql.r('(max(a.price_AI92) - max(f.price_AI92)) / max(f.price_AI92) * 100', 'price_delta_pct')} FROM applied a JOIN frame f USING (station_id, timestamp) GROUP BY 1, 2",
        APPLIED,
    ),
)
def scenario_price_delta(spark, folder):
    _, frame, applied = parts(spark, folder)
    usual = frame.groupBy("station_id").agg(F.max("price_AI92").alias("base_price"))
    chosen = applied.groupBy("scenario_id", "station_id").agg(F.max("price_AI92").alias("price"))
    out = with_price_delta(chosen.join(usual, "station_id"), "price", "base_price")
    return rounded(out.select("scenario_id", "station_id", "price_delta_pct"))


@query(
    "driver_effects",
    frame_sql(
        " UNION ALL ".join(
            f"SELECT station_id, target, '{d}' AS driver, {sql.r(f's_{d}', 'slope')}, {sql.r(f'c_{d}', 'center')} FROM eff" for d in DRIVERS
        ),
        MODEL,
    ),
)
def driver_effects(spark, folder):
    train = scratch.materialise(base.train_rows(base.hourly(spark, folder)), "train")
    return rounded(fc.fit_effects(train, fc.fit_seasonal(train, TARGETS), DRIVERS))


@query(
    "scenario_forecast",
    run_sql(f"SELECT scenario_id, station_id, timestamp, day, target, {sql.r('p10', 'p10')}, {sql.r('p50', 'p50')}, {sql.r('p90', 'p90')} FROM result"),
)
def scenario_forecast(spark, folder):
    return rounded(runs(spark, folder)[0])


_SUMMARY = """SELECT scenario_id, station_id, target, avg(p50) AS mean_p50, max(p50) AS peak_p50,
  arg_min(timestamp, (-round(p50, 9), timestamp)) AS peak_ts FROM result GROUP BY ALL"""


@query(
    "scenario_summary",
    run_sql(f"SELECT scenario_id, station_id, target, {sql.r('mean_p50', 'mean_p50')}, {sql.r('peak_p50', 'peak_p50')}, peak_ts FROM ({_SUMMARY})"),
)
def scenario_summary(spark, folder):
    result = runs(spark, folder)[0].withColumn("p50", F.round("p50", 9))
    return rounded(sc.scenario_summary(result))


@query(
    "scenario_days",
    run_sql(
        f"""SELECT scenario_id, station_id, target, day + 1 AS day, strftime(min(timestamp), '%d.%m') AS date, {sql.r('avg(p10)', 'p10')},
        {sql.r('avg(p50)', 'p50')}, {sql.r('avg(p90)', 'p90')}, {sql.r('max(p50)', 'peak')} FROM result GROUP BY scenario_id, station_id, target, day"""
    ),
)
def scenario_days(spark, folder):
    return rounded(sc.scenario_days(runs(spark, folder)[0]))


DELTA = """SELECT r.scenario_id, r.station_id, r.target, avg(r.p50) AS mean_p50, avg(b.p50) AS base_p50
  FROM result r JOIN base b USING (station_id, timestamp, target) GROUP BY ALL"""


@query(
    "scenario_delta",
    run_sql(
        f"""SELECT scenario_id, station_id, target, {sql.r('mean_p50', 'mean_p50')}, {sql.r('base_p50', 'base_p50')},
        {sql.r('CASE WHEN base_p50 <> 0 THEN (mean_p50 - base_p50) / base_p50 * 100 END', 'delta_pct')} FROM ({DELTA})"""
    ),
)
def scenario_delta(spark, folder):
    return rounded(sc.scenario_delta(*runs(spark, folder)))


STIMULI = """concat_ws(', ', CASE WHEN max(promo_fuel) = 1 THEN 'fuel promotion' END, CASE WHEN max(promo_shop) = 1 THEN 'shop promotion' END,
  CASE WHEN max(ad_active) = 1 THEN 'advertising' END)"""


@query(
    "scenario_recommendations",
    run_sql(
        f"""SELECT s.scenario_id, s.station_id, s.target, {sql.r('s.mean_p50', 'mean_p50')}, {sql.r('s.peak_p50', 'peak_p50')}, s.peak_ts,
        c.active_stimuli, CASE s.scenario_id WHEN 1 THEN 10.0::DOUBLE ELSE -5.0::DOUBLE END AS price_delta_pct,
        CASE s.scenario_id WHEN 1 THEN 'price raised' ELSE 'price cut' END AS price_effect
        FROM ({_SUMMARY}) s JOIN (SELECT scenario_id, {STIMULI} AS active_stimuli FROM conditions GROUP BY scenario_id) c USING (scenario_id)"""
    ),
)
def scenario_recommendations(spark, folder):
    result = runs(spark, folder)[0].withColumn("p50", F.round("p50", 9))
    given = priced(spark)
    prices = given.groupBy("scenario_id").agg((F.max("price_pct") - 100).cast("double").alias("price_delta_pct"))
    return rounded(recommend.scenario(sc.scenario_summary(result), sc.stimuli(given), prices))
