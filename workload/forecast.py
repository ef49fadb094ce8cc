"""Queries over forecasts and their accuracy."""

from pyspark.sql import functions as F

from forecourt import roles
from forecourt.operators import series
from forecourt.plans import accuracy as acc
from forecourt.plans import forecast as fc
from forecourt.sources import scratch, standins
from workload import base, sql
from workload.registry import query, rounded

TARGETS = roles.TARGETS
TRAIN = f"timestamp <= TIMESTAMP '{standins.TRAIN_END}'"
Q = roles.QUANTILE_NAMES
LEVELS = roles.QUANTILES

IDX = ", idx AS (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY timestamp) - 1 AS time_idx FROM facts)"
LONG = f""", long AS (SELECT station_id, timestamp, time_idx, is_weekend, hour, target, y FROM
  (SELECT station_id, timestamp, time_idx, is_weekend, hour, {', '.join(TARGETS)} FROM idx) UNPIVOT (y FOR target IN ({', '.join(TARGETS)})))"""
MODEL = f""", model AS (SELECT station_id, is_weekend, hour, target, {', '.join(f'q[{i + 1}] AS {n}' for i, n in enumerate(Q))} FROM (
  SELECT station_id, is_weekend, hour, target, quantile_cont(ln(1 + y), {LEVELS}) AS q FROM long WHERE {TRAIN} GROUP BY ALL))"""
PERIOD = f"timestamp BETWEEN TIMESTAMP '{standins.TEST_START}' AND TIMESTAMP '{standins.TEST_END}'"
RAW = f""", steps AS (SELECT station_id, time_idx AS origin_idx, timestamp AS origin_ts, h AS horizon_h, timestamp + to_hours(h - 1) AS timestamp
    FROM (SELECT *, CAST(unnest(range(1, 25)) AS INTEGER) AS h FROM idx WHERE time_idx >= 84 AND {PERIOD})),
  err AS (SELECT l.station_id, l.target, l.time_idx + 1 AS origin_idx, ln(1 + y) - q50 AS e FROM long l JOIN model USING (station_id, is_weekend, hour, target)),
  raw AS (SELECT s.station_id, s.origin_ts, s.horizon_h, s.timestamp, m.target, {', '.join(f'm.{n} + coalesce(e, 0) * pow(0.5::DOUBLE, horizon_h) AS {n}' for n in Q)}
    FROM steps s JOIN model m ON m.station_id = s.station_id AND m.hour = hour(s.timestamp) AND m.is_weekend = CAST(isodow(s.timestamp) >= 6 AS INTEGER)
    LEFT JOIN err r ON r.station_id = s.station_id AND r.target = m.target AND r.origin_idx = s.origin_idx)"""


def _unlog(n):
    return f"exp(greatest({n}, 0)) - 1"


PRED = f""", pred AS (SELECT b.station_id, b.timestamp, b.target, b.horizon_h, {', '.join('b.' + n for n in Q)}, b.q50 AS pred, l.y AS actual FROM (
    SELECT station_id, timestamp, target, horizon_h, {', '.join(f'{_unlog(n)} AS {n}' for n in Q)} FROM raw
    WHERE {PERIOD} QUALIFY row_number() OVER (PARTITION BY station_id, timestamp, target ORDER BY horizon_h) = 1) b
  LEFT JOIN long l USING (station_id, timestamp, target))"""
METRICS = """, metrics AS (SELECT station_id, target, round(avg(abs(pred - actual)), 3) AS MAE, round(sqrt(avg((pred - actual) * (pred - actual))), 3) AS RMSE,
  round(avg(CASE WHEN actual > 0.01 THEN abs(pred - actual) / actual END) * 100, 2) AS "MAPE_%", count(*) AS n
  FROM pred WHERE pred IS NOT NULL AND actual IS NOT NULL GROUP BY station_id, target)"""


def model_sql(body, *parts):
    return f"WITH {sql.HOURLY}{IDX}{LONG}{MODEL}{''.join(parts)} {body}"


def metrics_sql(body):
    return model_sql(body, RAW, PRED, METRICS)


def facts(spark, folder):
    cols = ["station_id", "timestamp", "is_weekend", "hour", *TARGETS]
    return base.indexed(base.hourly(spark, folder).select(*cols))


def seasonal_model(spark, folder):
    return fc.fit_seasonal(base.train_rows(base.hourly(spark, folder)))


def test_origins(df):
    period = F.col("timestamp").between(
        F.lit(standins.TEST_START).cast("timestamp_ntz"), F.lit(standins.TEST_END).cast("timestamp_ntz")
    )
    return series.window_index(df.select("station_id", "timestamp", "time_idx")).where(period)


def raw_forecasts(spark, folder):
    df = scratch.materialise(facts(spark, folder), "facts")
    model = scratch.materialise(fc.fit_seasonal(base.train_rows(df)), "model")
    return fc.rolling_origin(model, df, test_origins(df), nearest=True), df


def predictions(spark, folder):
    raw, df = raw_forecasts(spark, folder)
    return fc.assemble_predictions(raw, df, standins.TEST_START, standins.TEST_END)


def metrics(spark, folder):
    return acc.accuracy(predictions(spark, folder))


@query(
    "seasonal_model",
    model_sql(f"SELECT station_id, is_weekend, hour, target, {', '.join(sql.r(n, n) for n in Q)} FROM model"),
)
def seasonal_model_query(spark, folder):
    return rounded(seasonal_model(spark, folder))


@query(
    "seasonal_forecast",
    model_sql(
        f"""SELECT station_id, timestamp, target, {', '.join(sql.r(n, n) for n in Q)} FROM
        (SELECT station_id, timestamp, is_weekend, hour FROM facts WHERE timestamp > TIMESTAMP '{standins.VAL_END}') JOIN model USING (station_id, is_weekend, hour)"""
    ),
)
def seasonal_forecast(spark, folder):
    df = base.hourly(spark, folder)
    test = df.where(base.split_col() == "test")
    return rounded(fc.forecast_seasonal(fc.fit_seasonal(base.train_rows(df)), test))


@query(
    "rolling_origin_forecast",
    model_sql(
        f"""SELECT station_id, origin_ts, horizon_h, target, {sql.r('q10', 'q10')}, {sql.r('q50', 'q50')}, {sql.r('q90', 'q90')} FROM raw""",
        RAW,
    ),
)
def rolling_origin_forecast(spark, folder):
    df = facts(spark, folder)
    model = fc.fit_seasonal(base.train_rows(df))
    raw = fc.rolling_origin(model, df, test_origins(df))
    return rounded(raw.select("station_id", "origin_ts", "horizon_h", "target", "q10", "q50", "q90"))


@query(
    "predictions_assembled",
    model_sql(
        f"""SELECT station_id, timestamp, target, horizon_h, {sql.r('pred', 'pred')}, {sql.r('q10', 'q10')}, {sql.r('q90', 'q90')},
        {sql.r('actual', 'actual')} FROM pred""",
        RAW, PRED,
    ),
)
def predictions_assembled(spark, folder):
    cols = ["station_id", "timestamp", "target", "horizon_h", "pred", "q10", "q90", "actual"]
    return rounded(predictions(spark, folder).select(*cols))


@query(
    "predictions_wide",
    model_sql(
        "SELECT station_id, timestamp, horizon_h, "
        + ", ".join(
            sql.r(f"max(CASE WHEN target = '{t}' THEN {c} END)", f"{t}_{c}") for t in TARGETS for c in ("pred", "q10", "q90", "actual")
        )
        + " FROM pred GROUP BY station_id, timestamp, horizon_h",
        RAW, PRED,
    ),
)
def predictions_wide(spark, folder):
    return rounded(fc.wide_predictions(predictions(spark, folder)))


@query("accuracy_by_series", metrics_sql("SELECT * FROM metrics"))
def accuracy_by_series(spark, folder):
    return metrics(spark, folder)


@query(
    "accuracy_summary",
    metrics_sql(
        f"""SELECT target, {sql.r('avg(MAE)', 'MAE')}, {sql.r('avg(RMSE)', 'RMSE')}, {sql.r('avg("MAPE_%")', '"MAPE_%"')} FROM metrics GROUP BY target"""
    ),
)
def accuracy_summary(spark, folder):
    return rounded(acc.accuracy_summary(metrics(spark, folder)))


_R2 = """SELECT target, CASE WHEN count(*) > 1 AND var_pop(actual) > 0 THEN 1 - sum((pred - actual) * (pred - actual)) / (var_pop(actual) * count(*)) END AS r2
  FROM pred WHERE pred IS NOT NULL AND actual IS NOT NULL GROUP BY target"""


@query("r2_by_target", model_sql(f"SELECT target, {sql.r('r2', 'r2')} FROM ({_R2})", RAW, PRED))
def r2_by_target(spark, folder):
    return rounded(acc.r2(predictions(spark, folder)))


@query(
    "accuracy_kpis",
    metrics_sql(
        f"""SELECT count(DISTINCT target) AS n_targets, count(*) AS n_series, count(CASE WHEN "MAPE_%" <= 15 THEN 1 END) AS n_good,
        {sql.r('median("MAPE_%")', 'median_mape')}, round((SELECT median(r2) FROM ({_R2})), 6) AS median_r2 FROM metrics"""
    ),
)
def accuracy_kpis(spark, folder):
    pred = scratch.materialise(predictions(spark, folder), "predictions")
    return rounded(acc.accuracy_kpis(pred, acc.accuracy(pred)))


@query(
    "mape_bands",
    metrics_sql(
        f"""SELECT station_id, target, {sql.r('avg("MAPE_%")', 'mape')}, CASE WHEN avg("MAPE_%") <= 10 THEN 'good' WHEN avg("MAPE_%") <= 20 THEN 'fair'
        WHEN avg("MAPE_%") IS NOT NULL THEN 'poor' END AS band FROM metrics GROUP BY station_id, target"""
    ),
)
def mape_bands(spark, folder):
    return rounded(acc.mape_bands(metrics(spark, folder)))


@query(
    "mape_matrix",
    metrics_sql(
        "SELECT station_id, "
        + ", ".join(sql.r(f"avg(CASE WHEN target = '{t}' THEN \"MAPE_%\" END)", t) for t in TARGETS)
        + " FROM metrics GROUP BY station_id"
    ),
)
def mape_matrix(spark, folder):
    return rounded(acc.mape_matrix(metrics(spark, folder)))


@query(
    "prediction_band",
    model_sql(
        f"""SELECT station_id, timestamp, {sql.r('actual', 'actual')}, {sql.r('pred', 'pred')}, {sql.r('q10', 'q10')}, {sql.r('q90', 'q90')}
        FROM pred WHERE target = 'sales_AI95'""",
        RAW, PRED,
    ),
)
def prediction_band(spark, folder):
    return rounded(acc.prediction_band(predictions(spark, folder), "sales_AI95"))


@query(
    "ideal_line",
    model_sql(
        f"""SELECT target, {sql.r('least(min(pred), min(actual))', 'low')}, {sql.r('greatest(max(pred), max(actual))', 'high')}
        FROM pred WHERE pred IS NOT NULL AND actual IS NOT NULL GROUP BY target""",
        RAW, PRED,
    ),
)
def ideal_line(spark, folder):
    return rounded(acc.ideal_line(predictions(spark, folder)))


@query(
    "quantile_loss",
    model_sql(
        " UNION ALL ".join(
            f"""SELECT target, {p}::DOUBLE AS level, {sql.r(f'avg(greatest((actual - {n}) * {p}::DOUBLE, (actual - {n}) * ({p}::DOUBLE - 1)))', 'loss')}
            FROM pred WHERE actual IS NOT NULL GROUP BY target"""
            for n, p in zip(Q, LEVELS, strict=True)
        ),
        RAW, PRED,
    ),
)
def quantile_loss(spark, folder):
    return rounded(acc.pinball(predictions(spark, folder)))


REGRESSION_DRIVERS = ["is_weekend", "is_shop_open", "total_traffic", "promotion_fuel_active", "ad_active"]


def regression_parts(spark, folder, target="sales_AI92", kind="linear"):
    from forecourt.functions.calendar import with_shop_open

    df = base.indexed(with_shop_open(base.hourly(spark, folder)))
    rows = scratch.materialise(fc.regression_frame(df, target, REGRESSION_DRIVERS), "regression")
    model, spread = fc.fit_regression(base.train_rows(rows), REGRESSION_DRIVERS, kind)
    return rows, model, scratch.materialise(spread, "spread")


def _regression(spark, folder, kind):
    rows, model, spread = regression_parts(spark, folder, kind=kind)
    test = rows.where(base.split_col() == "test").dropna(subset=[f"log_y_lag{n}" for n in fc.LAGS])
    pred = fc.forecast_regression(model, spread, test, ("log_y",))
    natural = pred.select(
        "station_id",
        F.lit("sales_AI92").alias("target"),
        fc.unlog(F.col("q50")).alias("pred"),
        F.expm1("log_y").alias("actual"),
    )
    return acc.accuracy(natural)


@query("boosted_model_accuracy")
def boosted_model_accuracy(spark, folder):
    """Hold-out accuracy of MLlib boosted trees for one fuel."""
    return _regression(spark, folder, "trees")


@query(
    "seasonal_naive_accuracy",
    sql.hourly(
        f"""SELECT station_id, target, round(avg(abs(p - y)), 3) AS MAE, round(sqrt(avg((p - y) * (p - y))), 3) AS RMSE,
        round(avg(CASE WHEN y > 0.01 THEN abs(p - y) / y END) * 100, 2) AS "MAPE_%", count(*) AS n FROM (
          SELECT a.station_id, a.target, a.y, b.y AS p, a.timestamp FROM long a JOIN long b ON b.station_id = a.station_id AND b.target = a.target
          AND b.time_idx = a.time_idx - 168) WHERE timestamp > TIMESTAMP '{standins.VAL_END}' GROUP BY station_id, target"""
    ).replace(" SELECT station_id, target, round(avg(abs(p - y))", f"{IDX}{LONG} SELECT station_id, target, round(avg(abs(p - y))"),
)
def seasonal_naive_accuracy(spark, folder):
    """The floor a forecast has to beat: the same hour a week before."""
    from forecourt.operators.stats import long_targets

    df = facts(spark, folder)
    long = long_targets(df, ["station_id", "timestamp", "time_idx"])
    week = long.select("station_id", "target", (F.col("time_idx") + 168).alias("time_idx"), F.col("y").alias("pred"))
    both = long.withColumnRenamed("y", "actual").join(week, ["station_id", "target", "time_idx"])
    return acc.accuracy(both.where(base.split_col() == "test"))
