"""Linear models of log sales for every station and target, and forecasts that feed on themselves.

A model comes from sums: one hash aggregate adds up the products of all columns of a series, and the normal equations
of each series are solved from them, many at a time, in Arrow batches. The sums also tell what a model would lose
without one of its columns, so no column needs a further fit. Series with few rows take the model of all stations.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import roles
from forecourt.functions.expressions import hours_between, moment
from forecourt.operators.features import add_cyclical, present, unlog
from forecourt.operators.series import IDX, KEY, lagged
from forecourt.plans.forecast import LAGS, NAMES, regression_features
from forecourt.sources import scratch

#: Part of a column's variance that is added to it; a column without spread gets no weight.
RIDGE = 0.01
FLAT = 1e-9
#: A series with fewer rows takes the model of all stations.
LEAST_ROWS = 48
#: Hours of history that a forecast looks at, and days it may run.
HISTORY, MOST_DAYS = max(LAGS), 30

SERIES = [KEY, "target"]


def regression_rows(df: DataFrame, drivers: list[str], targets: list[str] = roles.TARGETS) -> DataFrame:
    """One row per station, hour and target: ``y, log_y``, calendar cycles, drivers and the lags of ``log_y``."""
    names = present(df, targets)
    logs = {f"_{t}": F.log1p(F.col(t).cast("double")) for t in names}
    cols = dict.fromkeys([KEY, "timestamp", IDX, "hour", "day_of_week", *drivers])
    wide = add_cyclical(lagged(df.withColumns(logs).select(*cols, *names, *logs), list(logs), LAGS))
    cells = [
        F.struct(
            F.lit(t).alias("target"),
            F.col(t).cast("double").alias("y"),
            F.col(f"_{t}").alias("log_y"),
            *[F.col(f"_{t}_lag{n}").alias(f"log_y_lag{n}") for n in LAGS],
        )
        for t in names
    ]
    fixed = [c for c in regression_features(drivers) if not c.startswith("log_y_lag")]
    return wide.select(*dict.fromkeys([KEY, "timestamp", "hour", *fixed]), F.inline(F.array(*cells)))


def gram(rows: DataFrame, features: list[str], keys: list[str] = SERIES, y: str = "log_y") -> DataFrame:
    """``n`` and ``sums`` of each series: of all columns (``y`` last), then of all products of two, row by row."""
    x = [F.col(c).cast("double") for c in [*features, y]]
    sums = [F.sum(c) for c in x] + [F.sum(a * b) for i, a in enumerate(x) for b in x[i:]]
    known = rows.dropna(subset=[*features, y])
    return known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.array(*sums).alias("sums"))


def _solve(k: int):
    """Weights of ``k`` columns from batches of sums."""
    upper = np.triu_indices(k + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column("n").to_numpy().astype(float)
            sums = np.array(batch.column("sums").to_pylist(), float)
            mean = sums[:, : k + 1] / n[:, None]
            second = np.zeros((len(n), k + 1, k + 1))
            second[:, upper[0], upper[1]] = sums[:, k + 1 :] / n[:, None]
            second[:, upper[1], upper[0]] = second[:, upper[0], upper[1]]
            cov = second - mean[:, :, None] * mean[:, None, :]
            a, c, total = cov[:, :k, :k].copy(), cov[:, :k, k].copy(), cov[:, k, k]
            at = np.arange(k)
            flat = a[:, at, at] <= FLAT * (1 + second[:, at, at])
            a[np.repeat(flat[:, :, None], k, 2) | np.repeat(flat[:, None, :], k, 1)] = 0
            a[:, at, at] = np.where(flat, 1.0, cov[:, at, at] * (1 + RIDGE))
            c[flat] = 0
            inverse = np.linalg.inv(a)
            weights = (inverse @ c[:, :, None])[:, :, 0]
            lost = n[:, None] * weights**2 / inverse[:, at, at]
            rest = n * (total - 2 * (weights * c).sum(1) + np.einsum("gi,gij,gj->g", weights, cov[:, :k, :k], weights))
            intercept = mean[:, k] - (weights * mean[:, :k]).sum(1)
            lists = [pa.array(list(x), pa.list_(pa.float64())) for x in (weights, lost)]
            columns = [*batch.drop_columns(["sums"]).columns, pa.array(intercept), *lists, pa.array(rest), pa.array(n * total)]
            names = [*[c for c in batch.schema.names if c != "sums"], "intercept", "weights", "lost", "rss", "tss"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


_SOLVED = "intercept double, weights array<double>, lost array<double>, rss double, tss double"


def solve(sums: DataFrame, k: int) -> DataFrame:
    """``intercept, weights`` of each row of ``gram``, ``lost`` (what the penalised error gains without a column), ``rss, tss``."""
    kept = sums.drop("sums")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return sums.mapInArrow(_solve(k), f"{schema}, {_SOLVED}")


def fit_series(rows: DataFrame, drivers: list[str]) -> DataFrame:
    """A model for every station and target, and one per target for all stations (station null).

    ``rows`` comes from ``regression_rows``; rows with a null column are left out. Series of fewer than
    ``LEAST_ROWS`` rows have no model of their own.
    """
    features = regression_features(drivers)
    sums = scratch.materialise(gram(rows, features), "gram")
    size = (len(features) + 1) * (len(features) + 4) // 2
    every = sums.groupBy("target").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(size)]).alias("sums")
    )
    every = every.select(F.lit(None).cast("long").alias(KEY), "target", "n", "sums")
    return solve(sums.where(F.col("n") >= LEAST_ROWS).select(*every.columns).unionByName(every), len(features))


def with_series_model(rows: DataFrame, model: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with ``columns`` of their series' model, or of the target's where the series has none."""
    own = model.where(F.col(KEY).isNotNull()).select(*SERIES, *columns)
    pooled = model.where(F.col(KEY).isNull())
    # One entry per target, at most as many as there are target columns.
    every = pooled.agg(F.map_from_entries(F.collect_list(F.struct("target", F.struct(*columns))))).scalar()
    both = rows.join(own, SERIES, "left").withColumn("_all", F.try_element_at(every, F.col("target")))
    return both.withColumns({c: F.coalesce(c, F.col("_all")[c]) for c in columns}).drop("_all")


def linear(intercept, weights, features: list[str]):
    """The value of a model on a row."""
    value = intercept
    for i, c in enumerate(features):
        value = value + weights[i] * F.col(c).cast("double")
    return value


def predicted(rows: DataFrame, model: DataFrame, drivers: list[str]) -> DataFrame:
    """``rows`` with ``prediction`` in log units; null where a column is null."""
    both = with_series_model(rows, model, ["intercept", "weights"])
    value = linear(F.col("intercept"), F.col("weights"), regression_features(drivers))
    return both.withColumn("prediction", value).drop("intercept", "weights")


def residual_quantiles(rows: DataFrame, model: DataFrame, drivers: list[str]) -> DataFrame:
    """Quantiles of the residuals of each series, as columns named like those of a forecast.

    A series holds one row per hour, which bounds what an exact percentile keeps.
    """
    rest = predicted(rows, model, drivers).withColumn("_rest", F.col("log_y") - F.col("prediction"))
    found = rest.where("_rest IS NOT NULL").groupBy(*SERIES).agg(F.percentile("_rest", roles.QUANTILES).alias("q"))
    return found.select(*SERIES, *[F.col("q")[i].alias(n) for i, n in enumerate(NAMES)])


def joint_importance(model: DataFrame, features: list[str]) -> DataFrame:
    """``target, factor, lost, share_pct``: what the models of all series of a target would lose without a factor."""
    parts = F.inline(F.arrays_zip(F.array(*[F.lit(f) for f in features]).alias("factor"), F.col("lost").alias("lost")))
    rows = model.where(F.col(KEY).isNotNull()).select("target", parts)
    sums = rows.groupBy("target", "factor").agg(F.sum("lost").alias("lost"))
    total = sums.groupBy("target").agg(F.sum("lost").alias("_total"))
    share = F.try_divide(F.col("lost") * 100, F.col("_total"))
    return sums.join(total, "target").withColumn("share_pct", share).drop("_total")


# Forecasts that feed on themselves ----------------------------------------------------


def history_arrays(history: DataFrame, start: str, stations: DataFrame, targets: list[str] = roles.TARGETS) -> DataFrame:
    """``KEY, past, usual`` of ``stations``: log sales of the last ``HISTORY`` hours before ``start``, hour by hour, and what stands in for a gap.

    Both hold one array per target. The stand-in of an hour of the day is its last known value, else the station's
    mean, else the mean of all.
    """
    names = present(history, targets)
    first = moment(start)
    logs = [F.log1p(F.col(t).cast("double")).alias(t) for t in names]
    known = history.where(F.col("timestamp") < first).select(KEY, "timestamp", *logs)
    overall = [F.coalesce(known.agg(F.avg(t)).scalar(), F.lit(0.0)) for t in names]
    ahead = hours_between("timestamp", first)
    recent = known.where(ahead <= HISTORY).select(KEY, (F.lit(HISTORY) - ahead).cast("int").alias("_at"), F.array(*names).alias("_y"))
    recent = recent.groupBy(KEY).agg(F.map_from_entries(F.collect_list(F.struct("_at", "_y"))).alias("_recent"))
    by_hour = known.groupBy(KEY, F.hour("timestamp").alias("_hour")).agg(
        F.array(*[F.max_by(t, F.when(F.col(t).isNotNull(), F.col("timestamp"))) for t in names]).alias("_y")
    )
    by_hour = by_hour.groupBy(KEY).agg(F.map_from_entries(F.collect_list(F.struct("_hour", "_y"))).alias("_hours"))
    means = known.groupBy(KEY).agg(F.array(*[F.avg(t) for t in names]).alias("_mean"))

    def hours(source: str, n: int, i: int):
        """Target i at hours 0 to n - 1 of a map from hours to all targets."""
        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.try_element_at(F.col(source), k)[i])

    def stand_in(i: int):
        return F.transform(hours("_hours", 24, i), lambda v: F.coalesce(v, F.col("_mean")[i]))

    rows = stations.select(KEY).join(means, KEY, "left").join(by_hour, KEY, "left").join(recent, KEY, "left")
    each = range(len(names))
    rows = rows.withColumn("_mean", F.array(*[F.coalesce(F.col("_mean")[i], overall[i]) for i in each]))
    past, usual = F.array(*[hours("_recent", HISTORY, i) for i in each]), F.array(*[stand_in(i) for i in each])
    return rows.select(KEY, past.alias("past"), usual.alias("usual"))


def _roll(features: int, names: list[str]):
    """Forecasts of scenarios and stations, each day after day."""

    def one(past, usual, weights, spread, x, start):
        past, usual = np.array(past, float), np.array(usual, float)
        w, s = np.array(weights, float), np.array(spread, float)
        steady = x @ w[:, 1 : 1 + features].T + w[:, 0]  # hour by hour, one column per target
        stand_in = usual[:, (start + np.arange(HISTORY + len(x))) % 24].T
        values = np.vstack((past.T, np.full((len(x), len(w)), np.nan)))
        gap = np.isnan(values[:HISTORY])
        filled = np.vstack((gap, np.zeros((len(x), len(w)), bool)))
        values[:HISTORY] = np.where(gap, stand_in[:HISTORY], values[:HISTORY])
        missing = np.zeros((len(x), len(w)), int)
        out = np.empty((len(x), len(w)))
        step = min(LAGS)
        for at in range(0, len(x), step):
            to = min(at + step, len(x))
            value = steady[at:to].copy()
            for k, lag in enumerate(LAGS):
                value += w[:, 1 + features + k] * values[HISTORY + at - lag : HISTORY + to - lag]
                missing[at:to] += filled[HISTORY + at - lag : HISTORY + to - lag]
            out[at:to] = value
            values[HISTORY + at : HISTORY + to] = value + s[:, 1]
        return out[:, :, None] + s[None, :, :], missing

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hours, rest = batch.column("steps"), batch.drop_columns(["steps"])
            for i in range(batch.num_rows):
                # The hours stay in Arrow: as Python objects they would take some ten times the memory.
                row, steps = rest.slice(i, 1).to_pylist()[0], hours[i].values
                x = steps.field("x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(steps), features)
                q, missing = one(row["past"], row["usual"], row["weights"], row["spread"], x, steps.field("hour")[0].as_py())
                n, t = missing.shape
                stamps, day = steps.field("timestamp").cast(pa.timestamp("us")), steps.field("day").cast(pa.int32())
                each = pa.array(np.repeat(np.arange(n), t))
                natural = np.expm1(np.maximum(q, 0.0)).reshape(n * t, 3)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["scenario_id"]] * (n * t), pa.int64()),
                        pa.array([row[KEY]] * (n * t), pa.int64()),
                        stamps.take(each),
                        day.take(each),
                        pa.array(names * n, pa.string()),
                        *[pa.array(natural[:, k]) for k in range(3)],
                        pa.array(missing.ravel(), pa.int32()),
                    ],
                    ["scenario_id", KEY, "timestamp", "day", "target", "p10", "p50", "p90", "lags_filled"],
                )

    return run


def rolling_forecast(
    model: DataFrame,
    spread: DataFrame,
    history: DataFrame,
    frame: DataFrame,
    drivers: list[str],
    start: str,
    targets: list[str] = roles.TARGETS,
) -> DataFrame:
    """p10, p50 and p90 of every scenario, station, hour and target of ``frame``; the median of a day is history for the next.

    ``frame`` holds consecutive hours from ``start`` on, for at most ``MOST_DAYS`` days. One scenario and station is one
    group, with ``HISTORY`` hours behind it, and carries its own state through all days; so a forecast of 30 days is one
    pass, and no group grows with the data. A lag that is not known takes the stand-in of ``history_arrays``, and
    ``lags_filled`` counts such lags. Series without a model take that of their target, and without residuals no band.
    """
    last_day = frame.agg(F.max("day")).first()[0]
    if last_day is not None and last_day >= MOST_DAYS:
        raise ValueError(f"{last_day + 1} days; at most {MOST_DAYS}")
    names = present(history, targets)
    fixed = [c for c in regression_features(drivers) if not c.startswith("log_y_lag")]
    hours = add_cyclical(frame)
    step = F.struct("timestamp", "day", "hour", F.array(*[F.col(c).cast("double") for c in fixed]).alias("x"))
    groups = hours.groupBy("scenario_id", KEY).agg(F.array_sort(F.collect_list(step)).alias("steps"))
    stations = frame.select(KEY).distinct()
    wanted = stations.select(KEY, F.explode(F.array(*[F.lit(t) for t in names])).alias("target"))
    band = [F.coalesce(n, F.lit(0.0)) for n in ("q10", "q50", "q90")]
    series = with_series_model(wanted, model, ["intercept", "weights"]).join(spread.select(*SERIES, "q10", "q50", "q90"), SERIES, "left")
    entry = F.struct(F.concat(F.array("intercept"), "weights").alias("w"), F.array(*band).alias("s"))
    series = series.groupBy(KEY).agg(F.map_from_entries(F.collect_list(F.struct("target", entry))).alias("m"))
    series = series.select(
        KEY,
        F.array(*[F.col("m")[t]["w"] for t in names]).alias("weights"),
        F.array(*[F.col("m")[t]["s"] for t in names]).alias("spread"),
    )
    # Spark takes a collected list for one entry, so without the hint it may send all groups through the driver.
    rows = groups.join(history_arrays(history, start, stations, names).hint("merge"), KEY).join(series.hint("merge"), KEY)
    schema = f"scenario_id long, {KEY} long, timestamp timestamp_ntz, day int, target string, p10 double, p50 double, p90 double, lags_filled int"
    return rows.mapInArrow(_roll(len(fixed), names), schema)


def accuracy_rows(rows: DataFrame, model: DataFrame, spread: DataFrame, drivers: list[str]) -> DataFrame:
    """``station_id, timestamp, target, pred, actual``: the model plus the median of its residuals, in natural units."""
    both = predicted(rows, model, drivers).join(spread.select(*SERIES, "q50"), SERIES, "left")
    value = unlog(F.col("prediction") + F.coalesce("q50", F.lit(0.0)))
    return both.select(KEY, "timestamp", "target", value.alias("pred"), F.col("y").alias("actual"))
