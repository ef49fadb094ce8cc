"""Queries over interpretation, recommendations and training runs."""


from pyspark.sql import functions as F

from forecourt import roles
from forecourt.operators import stats
from forecourt.plans import accuracy as acc
from forecourt.plans import interpret, recommend, runs
from forecourt.plans import scenario as sc
from forecourt.sources import scratch, standins
from workload import base, scenario, sql
from workload.forecast import METRICS, PRED, RAW, model_sql, predictions
from workload.joins import indexed_sql
from workload.registry import query, rounded
from workload.sources import _RANK, _TAG

PERIODS = {"test": ("2024-01-28", "2024-01-30"), "validation": ("2024-01-25", "2024-01-27")}


@query(
    "training_run_summary",
    f"""WITH {_TAG}, per_tag AS (SELECT run, tag, count(*) AS n, arg_max(value, (step, wall_time)) AS last, min(value) AS best,
      arg_min(step, (value, step)) AS best_step, arg_max(wall_time, (step, wall_time)) - arg_min(wall_time, (step, wall_time)) AS span FROM log GROUP BY run, tag),
    t AS (SELECT * FROM per_tag WHERE {_RANK} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY run ORDER BY {_RANK}) = 1),
    v AS (SELECT * FROM per_tag WHERE tag = 'val_loss'),
    j AS (SELECT r.run, t.tag AS train_tag, coalesce(t.n, 0) AS n_train, coalesce(v.n, 0) AS n_val, t.last AS last_train_loss, v.best AS best_val_loss,
      v.best_step AS best_val_step, CASE WHEN coalesce(t.n, 0) >= 2 THEN t.span WHEN coalesce(v.n, 0) >= 2 THEN v.span END AS seconds
      FROM (SELECT DISTINCT run FROM log) r LEFT JOIN t USING (run) LEFT JOIN v USING (run))
    SELECT run, CASE WHEN n_val > 0 THEN 'finished' WHEN n_train > 0 THEN 'interrupted' ELSE 'no data' END AS status, train_tag, n_train, n_val, seconds,
    CASE WHEN seconds IS NULL OR seconds <= 0 THEN '-' WHEN seconds >= 3600 THEN printf('%dh %02dm', CAST(seconds AS BIGINT) // 3600, CAST(seconds AS BIGINT) % 3600 // 60)
      WHEN seconds >= 60 THEN printf('%dm %02ds', CAST(seconds AS BIGINT) // 60, CAST(seconds AS BIGINT) % 60) ELSE printf('%ds', CAST(seconds AS BIGINT)) END AS duration,
    last_train_loss, best_val_loss, best_val_step, CAST(run = (SELECT max(run) FROM log) AS INTEGER) AS is_newest FROM j""",
)
def training_run_summary(spark, folder):
    return runs.run_summary(standins.training_scalars(spark, folder))


def _strengths():
    return ", ".join(f"abs({sql.corr(f, 'total_sales')}) AS v{i}" for i, f in enumerate(roles.FACTORS))


@query(
    "factor_importance",
    sql.hub(
        f"""SELECT factor, round(share, 6) AS share_pct, round(sum(share) OVER (), 6) AS covered_pct FROM (
          SELECT factor, s * 100 / sum(s) OVER () AS share FROM ({' UNION ALL '.join(f"SELECT '{f}' AS factor, v{i} AS s FROM wide" for i, f in enumerate(roles.FACTORS))})
          ORDER BY share DESC NULLS LAST, factor LIMIT 10)""",
        f", wide AS (SELECT {_strengths()} FROM hub)",
    ),
)
def factor_importance(spark, folder):
    strengths = stats.rank_factors(base.hub(spark, folder), roles.FACTORS)
    return rounded(interpret.importance(strengths, 10))


_LAGS = """, pairs AS (SELECT a.station_id, CAST(a.time_idx - b.time_idx AS INTEGER) AS lag_h, corr(b.y, a.y) AS r FROM (SELECT station_id, time_idx, total_traffic AS y FROM idx) a
  JOIN (SELECT station_id, time_idx, total_traffic AS y FROM idx) b ON b.station_id = a.station_id AND b.time_idx BETWEEN a.time_idx - 168 AND a.time_idx - 1 GROUP BY 1, 2)"""


@query(
    "lag_profile",
    indexed_sql(
        f"""SELECT station_id, lag_h, {sql.r('r', 'r')}, {sql.r('abs(r) * 100 / sum(abs(r)) OVER (PARTITION BY station_id)', 'share_pct')}
        FROM (SELECT station_id, lag_h, {sql.null_nan('r')} AS r FROM pairs)""",
        _LAGS,
    ),
)
def lag_profile(spark, folder):
    df = base.indexed(base.hourly(spark, folder).select("station_id", "timestamp", "total_traffic"))
    return rounded(interpret.lag_profile(df, "total_traffic"))


@query(
    "lag_verdict",
    indexed_sql(
        """SELECT station_id, t[1] AS lag_1, t[2] AS lag_2, t[3] AS lag_3,
        CASE WHEN abs(t[1] - 24) <= 3 THEN 'daily' WHEN abs(t[1] - 168) <= 6 THEN 'weekly' ELSE 'other' END AS verdict
        FROM (SELECT station_id, list(lag_h ORDER BY round(abs(r), 9) DESC, lag_h) AS t FROM pairs GROUP BY station_id)""",
        _LAGS,
    ),
)
def lag_verdict(spark, folder):
    df = base.indexed(base.hourly(spark, folder).select("station_id", "timestamp", "total_traffic"))
    return interpret.lag_verdict(interpret.lag_profile(df, "total_traffic"))


@query(
    "period_slice",
    sql.hourly(
        """SELECT station_id, timestamp, total_traffic FROM facts
        WHERE timestamp >= TIMESTAMP '2024-01-25 00:00:00' - INTERVAL 168 HOUR AND timestamp <= TIMESTAMP '2024-01-27 23:00:00'"""
    ),
)
def period_slice(spark, folder):
    facts = base.hourly(spark, folder).select("station_id", "timestamp", "total_traffic")
    return interpret.period_slice(facts, "validation", periods=PERIODS)


# Recommendations -------------------------------------------------------------------

LONG = f""", long AS (SELECT * FROM (SELECT station_name, timestamp, hour, day_of_week, ad_channel, total_traffic, promotion_fuel_active, promotion_shop_active,
  {', '.join(roles.TARGETS)} FROM hub) UNPIVOT (y FOR target IN ({', '.join(roles.TARGETS)})))"""


def tenths(x):
    return f"CAST(CAST(round({x}, 1) AS DECIMAL(18,1)) AS VARCHAR)"


PROMO = f"""SELECT station_name, target, 'promotion' AS kind, {tenths('p_on')} AS subject, {tenths('p_off')} AS other, lift AS value,
  CASE WHEN lift > 0 THEN 'promotion raises sales by ' ELSE 'promotion lowers sales by ' END || {tenths('abs(lift)')} || ' %' AS text FROM (
    SELECT *, (p_on - p_off) / p_off * 100 AS lift FROM (SELECT station_name, target, avg(CASE WHEN a = 1 THEN y END) AS p_on, avg(CASE WHEN a = 0 THEN y END) AS p_off FROM (
      SELECT *, CASE WHEN target LIKE 'sales\\_%' ESCAPE '\\' THEN promotion_fuel_active ELSE promotion_shop_active END AS a FROM long) GROUP BY station_name, target)
    WHERE p_off > 0 AND p_on IS NOT NULL)"""


def extremes(key, kind, words):
    return f"""SELECT station_name, target, '{kind}' AS kind, CAST(best AS VARCHAR) AS subject, CAST(worst AS VARCHAR) AS other,
      CASE WHEN low > 0 THEN (top - low) / low * 100 ELSE 0 END AS value,
      '{words}' || CAST(best AS VARCHAR) || ' (' || {tenths('top')} || '), worst ' || CAST(worst AS VARCHAR) || ' (' || {tenths('low')} || ')' AS text
      FROM (SELECT station_name, target, arg_min(k, (-m, k)) AS best, arg_min(k, (m, k)) AS worst, max(m) AS top, min(m) AS low FROM (
        SELECT station_name, target, {key} AS k, avg(y) AS m FROM long WHERE {key} IS NOT NULL GROUP BY 1, 2, 3) GROUP BY station_name, target)"""


CHANNEL = extremes("ad_channel", "ad_channel", "best channel ")
HOUR = extremes("hour", "hour", "peak hour ")
WEEKDAY = extremes("day_of_week", "weekday", "best weekday ")
TRAFFIC = f"""SELECT station_name, target, 'traffic' AS kind, CASE WHEN r > 0.5 THEN 'strong' ELSE 'moderate' END AS subject, NULL::VARCHAR AS other, r AS value,
  CASE WHEN r > 0.5 THEN 'strong' ELSE 'moderate' END || ' link with traffic' AS text FROM (
  SELECT station_name, target, {sql.corr('total_traffic', 'y')} AS r FROM long GROUP BY station_name, target) WHERE abs(r) > 0.25"""
RELIABILITY = """SELECT station_name, target, 'reliability' AS kind, band AS subject, NULL::VARCHAR AS other, mape AS value,
  CASE band WHEN 'good' THEN 'reliable, use for planning' WHEN 'fair' THEN 'approximate, keep a margin' ELSE 'unstable, indicative only' END AS text FROM (
  SELECT *, CASE WHEN mape <= 10 THEN 'good' WHEN mape <= 20 THEN 'fair' ELSE 'poor' END AS band FROM (
    SELECT 'Station-' || lpad(CAST(station_id AS VARCHAR), 6, '0') AS station_name, target, avg("MAPE_%") AS mape FROM metrics GROUP BY 1, 2) WHERE mape IS NOT NULL)"""


def rec_sql(*bodies):
    rows = " UNION ALL ".join(f"SELECT * FROM ({b})" for b in bodies)
    return sql.hub(f"SELECT station_name, target, kind, subject, other, {sql.r('value', 'value')}, text FROM ({rows})", LONG)


@query("recommend_promotion", rec_sql(PROMO))
def recommend_promotion(spark, folder):
    return rounded(recommend.promo(base.hub(spark, folder)))


@query("recommend_channel", rec_sql(CHANNEL))
def recommend_channel(spark, folder):
    return rounded(recommend.channel(base.hub(spark, folder)))


@query("recommend_hour", rec_sql(HOUR))
def recommend_hour(spark, folder):
    return rounded(recommend.hour(base.hub(spark, folder)))


@query("recommend_weekday", rec_sql(WEEKDAY))
def recommend_weekday(spark, folder):
    return rounded(recommend.weekday(base.hub(spark, folder)))


@query("recommend_traffic", rec_sql(TRAFFIC))
def recommend_traffic(spark, folder):
    return rounded(recommend.traffic(base.hub(spark, folder)))


@query(
    "recommend_reliability",
    model_sql(f"SELECT station_name, target, kind, subject, other, {sql.r('value', 'value')}, text FROM ({RELIABILITY})", RAW, PRED, METRICS),
)
def recommend_reliability(spark, folder):
    metrics = acc.accuracy(predictions(spark, folder))
    stations = base.hourly(spark, folder).select("station_id", "station_name").distinct()
    return rounded(recommend.reliability(metrics, stations))


_FIVE = " UNION ALL ".join(f"SELECT * FROM ({b})" for b in (PROMO, CHANNEL, HOUR, WEEKDAY, TRAFFIC))
_SCENARIOS = f"""SELECT 'Station-' || lpad(CAST(station_id AS VARCHAR), 6, '0') AS station_name, target, 'scenario' AS kind, CAST(scenario_id AS VARCHAR) AS subject,
  active_stimuli AS other, delta_pct AS value, coalesce(CASE WHEN delta_pct >= 0 THEN 'scenario raises the mean by ' ELSE 'scenario lowers the mean by ' END
  || {tenths('abs(delta_pct)')} || ' %', 'scenario') || ' (' || {tenths('mean_p50')} || ' against ' || {tenths('base_p50')} || '), ' ||
  CASE scenario_id WHEN 1 THEN 'price raised by 10.0 %' ELSE 'price cut by 5.0 %' END AS text
  FROM (SELECT d.*, CASE WHEN base_p50 <> 0 THEN (mean_p50 - base_p50) / base_p50 * 100 END AS delta_pct FROM ({scenario.DELTA}) d)
  JOIN (SELECT scenario_id, {scenario.STIMULI} AS active_stimuli FROM conditions GROUP BY scenario_id) USING (scenario_id)"""


@query(
    "recommendations_all",
    "SELECT * FROM ("
    + sql.hub(f"SELECT station_name, target, kind, subject, other, {sql.r('value', 'value')}, text FROM ({_FIVE})", LONG)
    + ") UNION ALL SELECT * FROM ("
    + model_sql(f"SELECT station_name, target, kind, subject, other, {sql.r('value', 'value')}, text FROM ({RELIABILITY})", RAW, PRED, METRICS)
    + ") UNION ALL SELECT * FROM ("
    + scenario.run_sql(f"SELECT station_name, target, kind, subject, other, {sql.r('value', 'value')}, text FROM ({_SCENARIOS})")
    + ")",
)
def recommendations_all(spark, folder):
    """Seven rules for every station and target."""
    stations = base.hourly(spark, folder).select("station_id", "station_name").distinct()
    metrics = acc.accuracy(predictions(spark, folder))
    given = scenario.priced(spark)
    prices = given.groupBy("scenario_id").agg((F.max("price_pct") - 100).cast("double").alias("price_delta_pct"))
    delta = sc.scenario_delta(*scenario.runs(spark, folder))
    told = recommend.scenario_rows(delta, sc.stimuli(given), stations, prices)
    return rounded(recommend.recommendations(base.hub(spark, folder), metrics, stations=stations, scenarios=told))
