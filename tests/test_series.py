"""Series, forecasts, scenarios and recommendations against brute force."""

import datetime as dt
import math
import re
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from forecourt import roles
from forecourt.operators import joins, series
from forecourt.plans import accuracy, forecast, interpret, recommend, regression, runs, scenario
from forecourt.sources import tables
from forecourt.sources.schemas import CONDITIONS

SERIES = "station_id long, timestamp timestamp_ntz, y double"
START = dt.datetime(2023, 1, 20)


@pytest.fixture(scope="module")
def wave(spark):
    """Two stations of different length over a month's end, 1 value per hour."""
    g = np.random.default_rng(5)
    rows = []
    for station, n in ((1, 700), (2, 400)):
        for i in range(n):
            base = 10 + 5 * math.sin(2 * math.pi * i / 24) + g.normal()
            rows.append((station, START + dt.timedelta(hours=i), round(max(base, 0.0), 3)))
    return rows


@pytest.fixture(scope="module")
def df(spark, wave):
    return spark.createDataFrame(wave, SERIES).repartition(6, "y")


def test_time_idx_is_contiguous_over_months(df):
    got = series.with_time_idx(df).toPandas().sort_values(["station_id", "timestamp"])
    for _, part in got.groupby("station_id"):
        assert part["time_idx"].tolist() == list(range(len(part)))


def test_missing_hour_is_added_and_reported(spark, hours):
    rows = [r for i, r in enumerate(hours(1, "2023-01-31T20:00:00", [1.0, 2.0, 3.0, 4.0, 5.0])) if i != 2]
    df = spark.createDataFrame(rows, SERIES)
    gap = series.gap_report(df).first()
    assert (gap.n_hours, gap.expected_hours, gap.missing_hours) == (4, 5, 1)
    out = series.hourly_spine(df, ["y"]).orderBy("timestamp").collect()
    assert [r.y for r in out] == [1.0, 2.0, 0.0, 4.0, 5.0]


def test_fill_carries_over_months(spark):
    stamps = [dt.datetime(2023, m, 5) for m in (1, 2, 3, 4, 5)]
    rows = [(1, t, v) for t, v in zip(stamps, (None, 2.0, None, None, 5.0), strict=True)]
    rows += [(2, t, v) for t, v in zip(stamps, (7.0, None, None, None, None), strict=True)]
    rows += [(3, t, None) for t in stamps]
    out = series.fill_gaps(spark.createDataFrame(rows, SERIES), ["y"]).orderBy("station_id", "timestamp").collect()
    assert [r.y for r in out] == [2.0, 2.0, 2.0, 2.0, 5.0] + [7.0] * 5 + [None] * 5


def test_window_index_counts(df):
    index = series.window_index(series.with_time_idx(df))
    got = {r.station_id: r["count"] for r in index.groupBy("station_id").count().collect()}
    assert got == {1: 700 - 84, 2: 400 - 84}
    row = index.where("station_id = 2 AND time_idx = 399").first()
    assert (row.encoder_length, row.decoder_length) == (168, 1)
    assert series.window_samples(index).where("station_id = 2 AND time_idx = 399").count() == 1


@pytest.mark.parametrize("run_hours", [24, 100, 672])
def test_overlapping_runs_equal_one_long_window(df, wave, run_hours):
    runs_df = series.overlapping_runs(series.with_time_idx(df), 168, run_hours)
    w = series.run_window(168)
    got = runs_df.withColumns({"m": F.avg("y").over(w), "n": F.count("y").over(w)}).where("NOT is_halo").toPandas()
    assert len(got) == len(wave)
    pdf = pd.DataFrame(wave, columns=["station_id", "timestamp", "y"])
    pdf["m"] = pdf.groupby("station_id")["y"].transform(lambda s: s.shift().rolling(168, min_periods=1).mean())
    both = got.merge(pdf, on=["station_id", "timestamp"])
    assert np.allclose(both["m_x"].astype(float), both["m_y"].astype(float), equal_nan=True)


def test_encoder_arrays_are_ordered(df):
    row = series.encoder_arrays(series.with_time_idx(df), ["y"]).where("station_id = 1 AND time_idx = 690").first()
    assert [h.time_idx for h in row.history] == list(range(522, 690))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_encoder_rows_are_never_broadcast(spark):
    """Exploded hours count as the few rows before: joins with them must not go through the driver."""
    stations = spark.range(1, 4).selectExpr("CASE WHEN id < 3 THEN id END AS station_id", "element_at(array(400L, 90L, 5L), CAST(id AS INT)) AS n")
    hours = stations.select("station_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("time_idx"))
    twice = hours.union(hours.where("station_id = 1 AND time_idx IN (7, 335, 336)"))
    facts = twice.withColumn("y", F.col("time_idx") * 10)
    origins = hours.where("time_idx >= 84")
    rows = series.encoder_rows(facts, origins)
    got = sorted(map(tuple, rows.select("station_id", "origin_idx", "lag_h", "time_idx", "y").collect()))
    assert "Broadcast" not in plan_of(rows)
    copies = {(1, i): 2 for i in (7, 335, 336)}
    want = [
        (s, o, o - i, i, i * 10)
        for s, n in ((1, 400), (2, 90)) for o in range(84, n) for i in range(max(0, o - 168), o) for _ in range(copies.get((s, i), 1))
    ]
    assert got == sorted(want)


def test_lags_are_never_broadcast(spark):
    stations = spark.range(1, 3).selectExpr("id AS station_id", "id * 20 AS n")
    hours = stations.select("station_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("time_idx"))
    rows = series.lagged(hours.withColumn("y", F.col("time_idx") * 10), ["y"], (3, 24))
    got = sorted(map(tuple, rows.select("station_id", "time_idx", "y_lag3", "y_lag24").collect()))
    assert "Broadcast" not in plan_of(rows)
    late = lambda i, n: (i - n) * 10 if i >= n else None
    assert got == [(s, i, late(i, 3), late(i, 24)) for s in (1, 2) for i in range(s * 20)]


def test_lag_profile_equals_pandas(df, wave):
    got = interpret.lag_profile(series.with_time_idx(df), "y", 48).toPandas()
    pdf = pd.DataFrame(wave, columns=["station_id", "timestamp", "y"])
    for r in got.itertuples():
        y = pdf[pdf.station_id == r.station_id]["y"].reset_index(drop=True)
        assert math.isclose(r.r, y.corr(y.shift(r.lag_h)), abs_tol=1e-9)
    verdicts = {r.verdict for r in interpret.lag_verdict(interpret.lag_profile(series.with_time_idx(df), "y", 48)).collect()}
    assert verdicts <= {"daily", "other"}


def test_shortest_horizon_wins(spark):
    rows = [(1, START, 5, 50.0), (1, START, 2, 20.0), (1, START, 9, 90.0)]
    pred = spark.createDataFrame(rows, "station_id long, timestamp timestamp_ntz, horizon_h int, pred double")
    row = series.shortest_horizon(pred).collect()
    assert [(r.horizon_h, r.pred) for r in row] == [(2, 20.0)]


def hub_rows(spark, df):
    cols = df.withColumnRenamed("y", "sales_AI92")
    return series.with_time_idx(
        cols.withColumns({"hour": F.hour("timestamp"), "is_weekend": (F.weekday("timestamp") >= 5).cast("int")})
    )


def test_forecast_does_not_see_later_facts(spark, df):
    """Facts from the origin on are replaced; the forecast of the origin stays."""
    facts = hub_rows(spark, df)
    origin = 500
    model = forecast.fit_seasonal(facts.where(f"time_idx < {origin}"), ["sales_AI92"])
    origins = facts.where(f"station_id = 1 AND time_idx = {origin}")
    later = F.when(F.col("time_idx") >= origin, F.lit(1e6)).otherwise(F.col("sales_AI92"))
    changed = facts.withColumn("sales_AI92", later)

    def run(f):
        out = forecast.rolling_origin(model, f, origins, ["sales_AI92"])
        return [(r.horizon_h, r.q10, r.q50, r.q90) for r in out.orderBy("horizon_h").collect()]

    first = run(facts)
    assert len(first) == 24 and first == run(changed)


def test_seasonal_quantiles_equal_numpy(spark, df, wave):
    facts = hub_rows(spark, df)
    row = forecast.fit_seasonal(facts, ["sales_AI92"]).where("station_id = 1 AND is_weekend = 0 AND hour = 7").first()
    y = [v for s, t, v in wave if s == 1 and t.hour == 7 and t.weekday() < 5]
    want = np.quantile(np.log1p(y), roles.QUANTILES)
    assert np.allclose([row[n] for n in roles.QUANTILE_NAMES], want)


def test_assembled_predictions_and_metrics(spark, df):
    facts = hub_rows(spark, df)
    model = forecast.fit_seasonal(facts, ["sales_AI92"])
    raw = forecast.rolling_origin(model, facts, facts.where("time_idx >= 84 AND time_idx % 12 = 0"), ["sales_AI92"])
    pred = forecast.assemble_predictions(raw, facts, "2023-01-28 00:00:00", "2023-01-30 23:00:00")
    pdf = pred.toPandas()
    assert len(pdf) == 2 * 72 and pdf["horizon_h"].max() <= 12
    m = accuracy.accuracy(pred).where("station_id = 1").first()
    part = pdf[pdf.station_id == 1]
    assert math.isclose(m.MAE, (part.pred - part.actual).abs().mean(), abs_tol=6e-4)
    assert math.isclose(m.RMSE, math.sqrt(((part.pred - part.actual) ** 2).mean()), abs_tol=6e-4)
    wide = forecast.wide_predictions(pred, ["sales_AI92"])
    assert {"sales_AI92_pred", "sales_AI92_q10", "sales_AI92_q90", "sales_AI92_actual"} <= set(wide.columns)


def test_mape_ignores_tiny_actuals_and_may_be_null(spark):
    rows = [(1, "a", 2.0, 1.0), (1, "a", 5.0, 0.0), (1, "b", 1.0, 0.0), (1, "c", None, 1.0)]
    m = accuracy.accuracy(spark.createDataFrame(rows, "station_id long, target string, pred double, actual double"))
    got = {r.target: (r["MAPE_%"], r.n) for r in m.collect()}
    assert got == {"a": (100.0, 2), "b": (None, 1)}


def test_r2_needs_spread(spark):
    rows = [("a", 1.0, 1.0), ("a", 2.0, 3.0), ("b", 1.0, 2.0), ("b", 1.0, 2.0), ("c", 1.0, 1.0)]
    out = accuracy.r2(spark.createDataFrame(rows, "target string, pred double, actual double"))
    assert {r.target: r.r2 for r in out.collect()} == {"a": 0.5, "b": None, "c": None}


def scenario_history(spark):
    """Three weeks of one station; traffic grows by the hour of the whole series."""
    rows = []
    for i in range(504):
        t = dt.datetime(2023, 1, 2) + dt.timedelta(hours=i)
        y = 20 + 10 * math.sin(2 * math.pi * t.hour / 24) + (i * 7919 % 13) / 5
        rows.append((1, t, y, i, 1.0 + i % 3, 50.0, 0, 0, 0, "winter", int(t.day == 7), "christmas" if t.day == 7 else None))
    schema = (
        "station_id long, timestamp timestamp_ntz, sales_AI92 double, total_traffic long, temperature double, price_AI92 double, "
        "promotion_fuel_active int, promotion_shop_active int, ad_active int, season string, is_holiday int, holiday_name string"
    )
    return spark.createDataFrame(rows, schema)


def test_future_frame_repeats_the_same_hour_of_the_last_day(spark):
    past = scenario_history(spark)
    frame = scenario.future_frame(past, "2023-01-23 00:00:00", 48).orderBy("timestamp").collect()
    assert len(frame) == 48 and frame[0].time_idx == 504
    assert [r.total_traffic for r in frame] == list(range(480, 504)) * 2
    assert {r.sales_AI92 for r in frame} == {0.0} and {r.season for r in frame} == {"winter"}
    assert {r.day for r in frame} == {0, 1}


def test_scenario_changes_the_frame_and_traffic_does_not_compound(spark):
    past = scenario_history(spark)
    frame = scenario.future_frame(past, "2023-01-23 00:00:00", 72)
    given = spark.createDataFrame([(1, 0, "snowfall", 150, 1, 0, 1), (1, 1, "none such", 150, 0, 1, 0)], CONDITIONS)
    out = scenario.apply_scenario(frame, given.withColumn("price_pct", F.lit(110)))
    rows = out.orderBy("timestamp").collect()
    assert len(rows) == 72
    assert [r.total_traffic for r in rows[::24]] == [480 * 1.5] * 3
    assert [(r.temperature, r.is_snow) for r in rows[::24]] == [(-3.0, 1), (-5.0, 0), (-5.0, 0)]
    assert [(r.promotion_fuel_active, r.promotion_shop_active, r.ad_active) for r in rows[::24]] == [(1, 0, 1), (0, 1, 0), (0, 1, 0)]
    assert all(math.isclose(r.price_AI92, 55.0) for r in rows)


def series_fixture(spark):
    past = scenario_history(spark).withColumn("shop_coffee", F.col("sales_AI92") * 0.5 + F.col("total_traffic") % 3)
    drivers, targets = ["ad_active", "total_traffic"], ["sales_AI92", "shop_coffee"]
    past = past.withColumns({"hour": F.hour("timestamp"), "day_of_week": F.weekday("timestamp")})
    rows = regression.regression_rows(series.with_time_idx(past), drivers, targets)
    return past, rows, drivers, targets


def test_series_models_solve_the_normal_equations(spark):
    _, rows, drivers, targets = series_fixture(spark)
    features = forecast.regression_features(drivers)
    model = regression.fit_series(rows, drivers).collect()
    assert sorted((r.station_id or 0, r.target) for r in model) == sorted((k, t) for k in [0, *{r.station_id for r in rows.collect()}] for t in targets)
    whole = rows.toPandas().dropna(subset=[*features, "log_y"])
    for r in model:
        mine = whole[(whole.target == r.target) & ((whole.station_id == r.station_id) | (r.station_id is None))]
        x, y = mine[features].to_numpy(float), mine["log_y"].to_numpy(float)
        cov = np.cov(x.T, bias=True)
        flat = np.diag(cov) <= regression.FLAT * (1 + (x * x).mean(0))
        a = cov + np.diag(np.diag(cov)) * regression.RIDGE
        a[flat, :], a[:, flat] = 0, 0
        a[flat, flat] = 1
        c = np.where(flat, 0, ((x - x.mean(0)) * (y - y.mean())[:, None]).mean(0))
        w = np.linalg.solve(a, c)
        assert r.n == len(mine) and np.allclose(r.weights, w, atol=1e-8)
        rest = y - y.mean() - (x - x.mean(0)) @ w
        assert np.isclose(r.rss, (rest * rest).sum(), rtol=1e-6, atol=1e-9) and np.isclose(r.intercept, y.mean() - x.mean(0) @ w)
        for j in np.flatnonzero(~flat):  # a fit without the column
            others = np.arange(len(w)) != j
            less = np.linalg.solve(a[np.ix_(others, others)], c[others])
            full = len(y) * (w @ a @ w - 2 * w @ c)
            assert np.isclose(r.lost[j], len(y) * (less @ a[np.ix_(others, others)] @ less - 2 * less @ c[others]) - full, rtol=1e-5, atol=1e-8)


def test_rolling_forecast_feeds_medians_back(spark):
    """Hour by hour in Python: lags come from the history first and from forecasts later."""
    past, rows, drivers, targets = series_fixture(spark)
    model = regression.fit_series(rows, drivers)
    spread = regression.residual_quantiles(rows, model, drivers)
    start = "2023-01-23 00:00:00"
    frame = scenario.future_frame(past, start, 9 * 24)
    given = spark.createDataFrame([(1, 0, "normal", 100, 0, 0, 0), (2, 0, "normal", 120, 0, 0, 1)], CONDITIONS)
    applied = scenario.apply_scenario(frame, given)
    got = regression.rolling_forecast(model, spread, past, applied, drivers, start, targets).toPandas()
    assert len(got) == 2 * 9 * 24 * 2 and (got["lags_filled"] == 0).all()

    features, station = forecast.regression_features(drivers), past.first().station_id
    hours = applied.where("scenario_id = 2").orderBy("timestamp").collect()
    for target in targets:
        m = model.where((F.col("station_id") == station) & (F.col("target") == target)).first()
        s = spread.where((F.col("station_id") == station) & (F.col("target") == target)).first()
        known = {r.timestamp: math.log1p(r[target]) for r in past.collect()}
        for r in hours:
            t = r.timestamp
            x = {
                "hour_sin": math.sin(2 * math.pi * r.hour / 24), "hour_cos": math.cos(2 * math.pi * r.hour / 24),
                "day_of_week_sin": math.sin(2 * math.pi * r.day_of_week / 7), "day_of_week_cos": math.cos(2 * math.pi * r.day_of_week / 7),
                "ad_active": r.ad_active, "total_traffic": r.total_traffic,
                "log_y_lag24": known[t - dt.timedelta(hours=24)], "log_y_lag168": known[t - dt.timedelta(hours=168)],
            }
            known[t] = m.intercept + sum(w * x[f] for w, f in zip(m.weights, features)) + s.q50
        mine = got[(got.scenario_id == 2) & (got.target == target)].sort_values("timestamp")
        assert np.allclose(mine["p50"], [math.expm1(max(known[t], 0.0)) for t in mine["timestamp"]], rtol=1e-9)
        assert (mine["p10"] <= mine["p50"] + 1e-12).all() and (mine["p50"] <= mine["p90"] + 1e-12).all()

    hole = past.where("timestamp != TIMESTAMP_NTZ '2023-01-22 05:00:00'")
    patched = regression.rolling_forecast(model, spread, hole, applied, drivers, start, targets).toPandas()
    assert len(patched) == len(got) and patched["p50"].notna().all()
    assert patched["lags_filled"].sum() == 2 * 2 * 2  # both scenarios and targets: a day later and a week later

    # A station without model, residuals and history takes those of all.
    new = applied.withColumn("station_id", F.lit(99).cast("long"))
    alone = regression.rolling_forecast(model, spread, past, new, drivers, start, targets).toPandas()
    assert len(alone) == len(got) and alone["p50"].notna().all() and alone["lags_filled"].max() == 2
    long = applied.withColumn("day", F.col("day") + 30)
    with pytest.raises(ValueError):
        regression.rolling_forecast(model, spread, past, long, drivers, start, targets)


def test_forecast_groups_are_never_broadcast(spark):
    past, rows, drivers, targets = series_fixture(spark)
    model = regression.fit_series(rows, drivers)
    spread = regression.residual_quantiles(rows, model, drivers)
    start = "2023-01-23 00:00:00"
    steps = F.sequence(F.lit(0), F.lit(47))
    stamp = F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("h"))
    station = past.first().station_id
    frame = spark.range(station, station + 1).selectExpr("id AS station_id", "explode(array(1L, 2L)) AS scenario_id").withColumn("h", F.explode(steps))
    frame = frame.withColumns({"timestamp": stamp, "day": F.expr("CAST(h DIV 24 AS INT)"), "hour": F.col("h") % 24, "day_of_week": F.lit(0), "ad_active": F.lit(0), "total_traffic": F.col("h")})
    out = regression.rolling_forecast(model, spread, past, frame, drivers, start, targets)
    assert len(out.collect()) == 2 * 48 * len(targets)
    inner = [line for line in plan_of(out).split("\n") if re.search("(SortMerge|BroadcastHash)Join .* Inner", line) and "_month" not in line]
    assert inner and not [line for line in inner if "Broadcast" in line]  # those of the groups; _month: of the time index


def test_forecast_hours_stay_in_arrow():
    """A batch of many groups: only the group at hand may be Python objects."""
    n, groups, k, names = 720, 40, 18, ["a", "b"]
    first = dt.datetime(2023, 1, 23)
    steps = [{"timestamp": first + dt.timedelta(hours=h), "day": h // 24, "hour": h % 24, "x": [float(h % 7)] * k} for h in range(n)]
    kind = pa.list_(pa.struct([("timestamp", pa.timestamp("us")), ("day", pa.int32()), ("hour", pa.int32()), ("x", pa.list_(pa.float64()))]))
    one = pa.array([steps], kind)
    group = {
        "past": [[1.0] * regression.HISTORY] * 2, "usual": [[1.0] * 24] * 2, "weights": [[0.5] + [0.01] * k + [0.1, 0.2]] * 2, "spread": [[-0.1, 0.0, 0.1]] * 2,
    }
    batch = pa.RecordBatch.from_pydict(
        {"scenario_id": list(range(groups)), "station_id": [1] * groups, "steps": pa.concat_arrays([one] * groups), **{c: [v] * groups for c, v in group.items()}}
    )
    roll = regression._roll(k, names)
    whole = next(roll(iter([batch])))
    tracemalloc.start()
    found = [(b.num_rows, b.column("scenario_id")[0].as_py(), b.column("p50")[-1].as_py()) for b in roll(iter([batch]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(n * 2, i, whole.column("p50")[-1].as_py()) for i in range(groups)]
    assert whole.column("timestamp")[2].as_py() == first + dt.timedelta(hours=1) and whole.column("day")[-1].as_py() == 29
    assert peak < 4e6, peak


def test_station_without_training_rows_is_forecast(spark):
    cells = [(s, 0, h, "sales_AI92", *[float(s + h + k) for k in range(len(forecast.NAMES))]) for s in (1, 3) for h in (0, 1)]
    model = spark.createDataFrame(cells, ["station_id", "is_weekend", "hour", "target", *forecast.NAMES])
    rows = [(s, dt.datetime(2023, 1, 2, h), 0, h) for s in (1, 9) for h in (0, 1, 2)]
    frame = spark.createDataFrame(rows, "station_id long, timestamp timestamp_ntz, is_weekend int, hour int")
    got = forecast.forecast_seasonal(model, frame, keep=("level",)).collect()
    assert len(got) == len(rows)
    found = {(r.station_id, r.timestamp.hour): (r.level, r[forecast.NAMES[0]]) for r in got}
    assert found[1, 0] == ("station", 1.0) and found[9, 0] == ("hour", 2.0) and found[9, 1] == ("hour", 3.0)
    assert found[1, 2] == found[9, 2] == ("all", 2.5)


def test_run_summary_prefers_the_finest_tag(spark):
    rows = [
        (1, "train_loss_epoch", 1, 9.0, 0.0), (1, "train_loss_step", 1, 3.0, 10.0), (1, "train_loss_step", 2, 2.0, 75.0),
        (1, "val_loss", 1, 5.0, 1.0), (1, "val_loss", 2, 4.0, 2.0), (1, "val_loss", 3, 4.0, 3.0),
        (2, "train_loss", 1, 7.0, 0.0), (3, "lr", 1, 0.1, 0.0),
    ]
    df = spark.createDataFrame(rows, "run long, tag string, step long, value double, wall_time double")
    got = {r.run: r for r in runs.run_summary(df).collect()}
    assert (got[1].status, got[1].train_tag, got[1].last_train_loss) == ("finished", "train_loss_step", 2.0)
    assert (got[1].best_val_loss, got[1].best_val_step, got[1].duration) == (4.0, 2, "1m 05s")
    assert (got[2].status, got[2].duration, got[3].status, got[3].is_newest) == ("interrupted", "-", "no data", 1)
    kept = {(r.run, r.tag) for r in tables.read_scalars(df).collect()}
    assert kept == {(1, "train_loss_step"), (2, "train_loss")}


def test_recommendations_of_one_station(spark):
    rows = []
    for i in range(336):
        t = dt.datetime(2023, 1, 2) + dt.timedelta(hours=i)
        on = i % 2
        rows.append((1, "S", t, "radio" if on else "none", 10 * t.hour, on, 0, 10.0 + t.hour + on))
    schema = (
        "station_id long, station_name string, timestamp timestamp_ntz, ad_channel string, total_traffic long, "
        "promotion_fuel_active int, promotion_shop_active int, sales_AI92 double"
    )
    hub = spark.createDataFrame(rows, schema)
    metrics = spark.createDataFrame([(1, "sales_AI92", 12.0)], "station_id long, target string, `MAPE_%` double")
    got = {r.kind: r for r in recommend.recommendations(hub, metrics, ["sales_AI92"]).collect()}
    assert set(got) == {"promotion", "ad_channel", "hour", "weekday", "traffic", "reliability"}
    assert (got["hour"].subject, got["hour"].other) == ("23", "0")
    assert got["ad_channel"].subject == "radio" and got["promotion"].value > 0
    assert got["weekday"].value == 0.0 and got["weekday"].subject == "0"
    assert (got["traffic"].subject, got["reliability"].subject) == ("strong", "fair")


def test_station_labels(spark):
    rows = [(1, "A", START, None), (1, "A", START + dt.timedelta(hours=1), "road")]
    df = spark.createDataFrame(rows, "station_id long, station_name string, timestamp timestamp_ntz, road_type string")
    row = joins.station_labels(df).first()
    assert (row.road_type, row.label) == ("road", "A  ·  road")
