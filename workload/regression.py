"""Queries over the linear models of all series and the forecasts that feed on themselves."""

import math

from pyspark.sql import functions as F

from forecourt import roles
from forecourt.functions.calendar import with_shop_open
from forecourt.plans import accuracy as acc
from forecourt.plans import forecast as fc
from forecourt.plans import regression as reg
from forecourt.plans import scenario as sc
from forecourt.sources import scratch, standins
from workload import base, sql
from workload.forecast import IDX, REGRESSION_DRIVERS, TRAIN
from workload.joins import conditions
from workload.registry import query, rounded
from workload.scenario import APPLIED, START, future_sql

DRIVERS, TARGETS = REGRESSION_DRIVERS, roles.TARGETS
FEATURES = fc.regression_features(DRIVERS)
K = len(FEATURES)
#: The columns of a model and, last, log sales.
_X = [*(f"x{i}" for i in range(K)), "ly"]
_PAIRS = {pair: n + 1 for n, pair in enumerate((i, j) for i in range(K + 1) for j in range(i, K + 1))}


def _cycles(col, period):
    return [f"{f}({col} * {2 * math.pi!r}::DOUBLE / {period})" for f in ("sin", "cos")]


def _fixed(table):
    """The columns that need no history, in the order of FEATURES."""
    own = {"is_shop_open": f"CAST({table}.hour BETWEEN 5 AND 21 AS INTEGER)"}
    cycles = _cycles(f"{table}.hour", 24) + _cycles(f"(isodow({table}.timestamp) - 1)", 7)
    return cycles + [own.get(d, f"{table}.{d}") for d in DRIVERS]


def _cov(i, j):
    i, j = min(i, j), max(i, j)
    return f"(p[{_PAIRS[i, j]}] / n - s[{i + 1}] / n * (s[{j + 1}] / n))"


def _flat(i):
    return f"{_cov(i, i)} <= {reg.FLAT} * (1 + p[{_PAIRS[i, i]}] / n)"


def _cell(i, j):
    if i == j:
        return f"CASE WHEN {_flat(i)} THEN 1.0 ELSE {_cov(i, i)} * (1 + {reg.RIDGE}) END"
    return f"CASE WHEN {_flat(i)}{'' if j == K else f' OR {_flat(j)}'} THEN 0.0 ELSE {_cov(i, j)} END"


_ROWS = ", ".join(
    "[" + ", ".join([_cell(i, j) for j in range(K + 1)] + [f"{float(i == j)}" for j in range(K)]) + "]::DOUBLE[]" for i in range(K)
)
_VALUE = " + ".join(f"w[{i + 1}] * {x}" for i, x in enumerate(_X[:-1]))

#: Gauss-Jordan elimination of [A | c | I], one column a step: weights and the inverse stand where c and I stood.
MODELS = f""", points AS (
    SELECT r.station_id, r.timestamp, r.time_idx, r.hour, target, y, ln(1 + y) AS ly, {', '.join(f'{x} AS x{i}' for i, x in enumerate(_fixed('r')))}
    FROM (SELECT station_id, timestamp, time_idx, hour, {', '.join(d for d in DRIVERS if d != 'is_shop_open')}, {', '.join(TARGETS)} FROM idx)
    UNPIVOT (y FOR target IN ({', '.join(TARGETS)})) r),
  reg AS (SELECT *, lag(ly, 24) OVER w AS x{K - 2}, lag(ly, 168) OVER w AS x{K - 1} FROM points WINDOW w AS (PARTITION BY station_id, target ORDER BY time_idx)),
  gram AS (SELECT station_id, target, count(*)::DOUBLE AS n, [{', '.join(f'sum({x}::DOUBLE)' for x in _X)}] AS s,
    [{', '.join(f'sum({_X[i]}::DOUBLE * {_X[j]})' for i, j in _PAIRS)}] AS p FROM reg WHERE x{K - 1} IS NOT NULL AND {TRAIN} GROUP BY 1, 2),
  every AS (SELECT * FROM gram WHERE n >= {reg.LEAST_ROWS} UNION ALL
    SELECT NULL, target, sum(n), [{', '.join(f'sum(s[{i + 1}])' for i in range(K + 1))}], [{', '.join(f'sum(p[{n}])' for n in _PAIRS.values())}] FROM gram GROUP BY target),
  steps AS (SELECT station_id, target, n, s, 1 AS stp, [{_ROWS}] AS m FROM every UNION ALL
    SELECT station_id, target, n, s, stp + 1, list_transform(m, lambda line, i: CASE WHEN i = stp THEN list_transform(line, lambda v: v / m[stp][stp])
      ELSE list_transform(line, lambda v, j: v - line[stp] * m[stp][j] / m[stp][stp]) END) FROM steps WHERE stp <= {K}),
  solved AS (SELECT station_id, target, n, list_transform(m, lambda line: line[{K + 1}]) AS w, m,
    s[{K + 1}] / n - ({' + '.join(f'm[{i + 1}][{K + 1}] * s[{i + 1}] / n' for i in range(K))}) AS b FROM steps WHERE stp = {K + 1}),
  series AS (SELECT a.station_id, a.target, coalesce(o.b, e.b) AS b, coalesce(o.w, e.w) AS w FROM (SELECT DISTINCT station_id, target FROM points) a
    LEFT JOIN solved o ON o.station_id = a.station_id AND o.target = a.target LEFT JOIN solved e ON e.station_id IS NULL AND e.target = a.target),
  fitted AS (SELECT r.station_id, r.timestamp, r.target, y, ly, b + {_VALUE} AS prediction FROM reg r JOIN series q ON q.station_id = r.station_id AND q.target = r.target),
  spread AS (SELECT station_id, target, quantile_cont(ly - prediction, [0.1, 0.5, 0.9]) AS d FROM fitted
    WHERE {TRAIN} AND prediction IS NOT NULL GROUP BY 1, 2)"""


def models_sql(body, *more):
    return f"WITH RECURSIVE {sql.HOURLY}{IDX}{MODELS}{''.join(more)} {body}"


def points(spark, folder, facts=None):
    df = base.indexed(with_shop_open(base.hourly(spark, folder) if facts is None else facts))
    return scratch.materialise(reg.regression_rows(df, DRIVERS), "points")


def models(rows):
    train = base.train_rows(rows)
    model = scratch.materialise(reg.fit_series(train, DRIVERS), "models")
    return model, scratch.materialise(reg.residual_quantiles(train, model, DRIVERS), "spread")


@query(
    "series_models",
    models_sql(
        f"SELECT station_id, target, CAST(n AS BIGINT) AS n, {sql.r('b', 'intercept')}, "
        + ", ".join(sql.r(f"w[{i + 1}]", f) for i, f in enumerate(FEATURES))
        + " FROM solved"
    ),
)
def series_models(spark, folder):
    """The weights of every series, and of all stations together."""
    model = reg.fit_series(base.train_rows(points(spark, folder)), DRIVERS)
    return rounded(model.select("station_id", "target", "n", "intercept", *[F.col("weights")[i].alias(f) for i, f in enumerate(FEATURES)]))


@query(
    "linear_model_accuracy",
    models_sql(
        f"""SELECT station_id, target, round(avg(abs(pred - actual)), 3) AS MAE, round(sqrt(avg((pred - actual) * (pred - actual))), 3) AS RMSE,
        round(avg(CASE WHEN actual > 0.01 THEN abs(pred - actual) / actual END) * 100, 2) AS "MAPE_%", count(*) AS n
        FROM (SELECT f.station_id, f.target, exp(greatest(prediction + coalesce(d[2], 0), 0)) - 1 AS pred, y AS actual
          FROM fitted f LEFT JOIN spread s ON s.station_id = f.station_id AND s.target = f.target
          WHERE prediction IS NOT NULL AND timestamp > TIMESTAMP '{standins.VAL_END}') GROUP BY station_id, target"""
    ),
)
def linear_model_accuracy(spark, folder):
    """Hold-out accuracy of the linear models of all stations and targets."""
    rows = points(spark, folder)
    model, spread = models(rows)
    test = rows.where(base.split_col() == "test")
    return acc.accuracy(reg.accuracy_rows(test, model, spread, DRIVERS))


_LOST = " UNION ALL ".join(
    f"SELECT target, '{f}' AS factor, sum(n * w[{i + 1}] * w[{i + 1}] / m[{i + 1}][{K + 2 + i}]) AS lost FROM solved WHERE station_id IS NOT NULL GROUP BY target"
    for i, f in enumerate(FEATURES)
)


@query(
    "model_importance",
    models_sql(f"SELECT target, factor, {sql.r('lost', 'lost')}, {sql.r('lost * 100 / nullif(sum(lost) OVER (PARTITION BY target), 0)', 'share_pct')} FROM ({_LOST})"),
)
def model_importance(spark, folder):
    """What the models of each target would lose without a factor, from the sums of the fit."""
    model = reg.fit_series(base.train_rows(points(spark, folder)), DRIVERS)
    return rounded(reg.joint_importance(model, FEATURES))


def _rolling_sql(days):
    lags = f"w[{K - 1}] * vals[len(vals) - 24 + i + 1] + w[{K}] * vals[len(vals) - 168 + i + 1]"
    value = " + ".join(f"w[{i + 1}] * ({x})" for i, x in enumerate(_fixed("a")))
    return models_sql(
        f"""SELECT scenario_id, station_id, CAST(ts[i] AS TIMESTAMP) AS timestamp, CAST((i - 1) // 24 AS INTEGER) AS day, target,
          {', '.join(sql.r(f'exp(greatest(vals[168 + i] - d[2] + d[{k}], 0)) - 1', p, 4) for k, p in ((1, 'p10'), (2, 'p50'), (3, 'p90')))},
          CAST(gaps[144 + i] + gaps[i] AS INTEGER) AS lags_filled
        FROM (SELECT *, unnest(range(1, {days * 24 + 1})) AS i FROM rolled WHERE stp = {days})""",
        future_sql(days), APPLIED,
        f""", logs AS (SELECT station_id, timestamp, target, ly, hour FROM points WHERE timestamp < TIMESTAMP '{START}'),
      hours AS (SELECT station_id, target, hour, arg_max(ly, timestamp) AS ly FROM logs GROUP BY 1, 2, 3),
      means AS (SELECT station_id, target, avg(ly) AS ly FROM logs GROUP BY 1, 2),
      overall AS (SELECT target, avg(ly) AS ly FROM logs GROUP BY 1),
      grid AS (SELECT m.station_id, m.target, m.ly AS mean, TIMESTAMP '{START}' - to_hours(CAST(168 - k AS INTEGER)) AS timestamp, k FROM means m, range(168) r(k)),
      past AS (SELECT g.station_id, g.target, list(coalesce(l.ly, h.ly, g.mean, o.ly) ORDER BY k) AS vals, list(CAST(l.ly IS NULL AS INTEGER) ORDER BY k) AS gaps
        FROM grid g LEFT JOIN logs l ON l.station_id = g.station_id AND l.target = g.target AND l.timestamp = g.timestamp
        LEFT JOIN hours h ON h.station_id = g.station_id AND h.target = g.target AND h.hour = hour(g.timestamp)
        LEFT JOIN overall o ON o.target = g.target GROUP BY 1, 2),
      fixed AS (SELECT a.scenario_id, a.station_id, q.target, q.w, list(b + {value} ORDER BY a.timestamp) AS f, list(a.timestamp ORDER BY a.timestamp) AS ts
        FROM applied a JOIN series q ON q.station_id = a.station_id GROUP BY 1, 2, 3, 4),
      rolled AS (SELECT x.scenario_id, x.station_id, x.target, x.w, x.f, x.ts, coalesce(s.d, [0.0, 0.0, 0.0]) AS d, 0 AS stp, y.vals,
          list_concat(y.gaps, list_transform(range({days * 24}), lambda z: 0)) AS gaps
        FROM fixed x JOIN past y ON y.station_id = x.station_id AND y.target = x.target LEFT JOIN spread s ON s.station_id = x.station_id AND s.target = x.target
        UNION ALL SELECT scenario_id, station_id, target, w, f, ts, d, stp + 1,
          list_concat(vals, list_transform(range(24), lambda i: f[stp * 24 + i + 1] + {lags} + d[2])), gaps FROM rolled WHERE stp < {days})""",
    ).replace(", past AS (SELECT * FROM facts", ", before AS (SELECT * FROM facts").replace("FROM past QUALIFY", "FROM before QUALIFY").replace("FROM past GROUP BY station_id)", "FROM before GROUP BY station_id)")


def _rolling(spark, folder, days):
    facts = scratch.materialise(base.hourly(spark, folder), "facts")
    model, spread = models(points(spark, folder, facts))
    frame = sc.apply_scenario(sc.future_frame(facts, START, days * 24), conditions(spark))
    keep = ["scenario_id", "station_id", "timestamp", "day", "hour", "day_of_week", *DRIVERS]
    frame = scratch.materialise(frame.select(*dict.fromkeys(keep)), "frame")
    return rounded(reg.rolling_forecast(model, spread, facts, frame, DRIVERS, START), 4)


@query("rolling_forecast_day", _rolling_sql(1))
def rolling_forecast_day(spark, folder):
    """One day of all targets."""
    return _rolling(spark, folder, 1)


@query("rolling_forecast_week", _rolling_sql(7))
def rolling_forecast_week(spark, folder):
    """Seven days of all targets, each day fed with the medians of the days before."""
    return _rolling(spark, folder, 7)


@query("rolling_forecast_month", _rolling_sql(30))
def rolling_forecast_month(spark, folder):
    """Thirty days of all targets."""
    return _rolling(spark, folder, 30)
