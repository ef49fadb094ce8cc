"""Statistics against pandas and numpy on small frames."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from forecourt.operators import quality, stats
from forecourt.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def sample():
    g = np.random.default_rng(3)
    n = 3000
    df = pd.DataFrame({"g": g.integers(0, 3, n), "x": g.exponential(5, n).round(2), "z": 4.0})
    df["y"] = (df["x"] * 2 + g.normal(size=n)).round(3)
    df.loc[g.random(n) < 0.1, "x"] = np.nan
    df.loc[g.random(n) < 0.2, "y"] = np.nan
    return df


@pytest.fixture(scope="module")
def frame(spark, sample):
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in sample.itertuples(index=False, name=None)]
    return spark.createDataFrame(rows, "g long, x double, z double, y double").repartition(5)


PROBS = [0.0, 0.02, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("limits", [(10_000, 20_000), (100, 100)])
def test_quantiles_equal_pandas(frame, sample, limits):
    got = exact_quantiles(frame, ["x", "y"], PROBS, accuracy=limits[0], small=limits[1])
    for r in got.collect():
        assert np.isclose(r.value, sample[r.column].quantile(r.prob)), r


@pytest.mark.parametrize("limits", [(10_000, 20_000), (100, 100)])
def test_grouped_quantiles_equal_pandas(frame, sample, limits):
    got = exact_quantiles(frame, ["y"], PROBS, ["g"], *limits)
    rows = got.collect()
    assert len(rows) == 3 * len(PROBS)
    for r in rows:
        assert np.isclose(r.value, sample[sample.g == r.g]["y"].quantile(r.prob)), r


def test_quantiles_with_one_dominant_value_and_group(spark):
    rows = [(1, 5.0)] * 4000 + [(1, float(i)) for i in range(2000)] + [(2, 1.0), (2, 2.0), (2, 4.0)]
    df = spark.createDataFrame(rows, "g long, x double")
    pdf = pd.DataFrame(rows, columns=["g", "x"])
    for r in exact_quantiles(df, ["x"], [0.1, 0.5, 0.9], ["g"], 200, 200).collect():
        assert np.isclose(r.value, pdf[pdf.g == r.g].x.quantile(r.prob))


def test_correlation_is_pairwise_complete(frame, sample):
    want = sample[["x", "y", "z"]].corr()
    for r in stats.corr_matrix(frame, ["x", "y", "z"], None).collect():
        w = want.loc[r.row_name, r.col_name]
        if r.row_name == "z" or r.col_name == "z":
            assert r.r is None
        else:
            assert np.isclose(r.r, w, atol=1e-9)


def test_correlation_block_equals_matrix(frame, sample):
    cell = {r.col_name: r.r for r in stats.corr_block(frame, ["x"], ["y", "z"]).collect()}
    assert np.isclose(cell["y"], sample[["x", "y"]].corr().iloc[0, 1], atol=1e-9)
    assert cell["z"] is None


def test_correlation_does_not_depend_on_units_or_on_other_columns(frame, sample):
    scaled = frame.selectExpr("x", "y", "z", "y * 1e-12 AS small", "y * 1e12 AS large", "1e9 + y * 0 AS flat")
    want = sample[["x", "y"]].corr().iloc[0, 1]
    for cols in (["small"], ["y", "small", "large", "flat", "z"]):
        got = {r.col_name: r.r for r in stats.corr_block(scaled, ["x"], cols).collect()}
        assert all(np.isclose(got[c], want, atol=1e-9) for c in cols if c not in ("flat", "z"))
        assert got.get("flat") is None


def test_skewness_is_bias_adjusted(frame, sample):
    row = stats.skew_table(frame, ["x", "z"]).collect()
    assert np.isclose(row[0].skew_raw, sample["x"].skew())
    assert np.isclose(row[0].skew_log, np.log1p(sample["x"]).skew())
    assert row[1].skew_raw is None


def test_trend_needs_five_points(spark):
    points = [(float(i), 2.0 * i + 1) for i in range(5)]
    five = stats.trends(spark.createDataFrame(points, "x double, y double"), [("x", "y")]).first()
    assert np.isclose(five.slope, 2) and np.isclose(five.intercept, 1) and np.isclose(five.r, 1)
    assert (five.x_from, five.x_to, five.y_from, five.y_to) == (0.0, 4.0, 1.0, 9.0)
    four = stats.trends(spark.createDataFrame(points[:4], "x double, y double"), [("x", "y")]).first()
    assert four.n == 4 and four.slope is None and four.r is None


def test_histogram_counts_every_row_once(frame, sample):
    bins = stats.histogram(frame, "x", 60).collect()
    assert sum(b.n_rows for b in bins) == sample["x"].notna().sum()
    assert max(b.bin for b in bins) == 59
    flat = stats.histogram(frame, "z", 60).collect()
    assert [(b.bin, b.n_rows) for b in flat] == [(0, len(sample))]


def test_density_shares_sum_to_one(frame):
    sums = stats.density(frame, "x", "g").groupBy("g").agg(F.sum("share").alias("s")).collect()
    assert all(np.isclose(r.s, 1.0) for r in sums)


def test_outliers_and_box(frame, sample):
    x = sample["x"]
    q1, q3 = x.quantile(0.25), x.quantile(0.75)
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    row = stats.iqr_outliers(frame, ["x", "z"]).collect()
    assert [r.column for r in row] == ["x"]
    assert row[0].n_outliers == ((x < lo) | (x > hi)).sum()
    for r in stats.box_stats(frame, "x", "g").collect():
        part = sample[sample.g == r.g]["x"]
        assert np.isclose(r.median, part.median())
        reach = 1.5 * (r.q3 - r.q1)
        assert r.whisker_high == part[part <= r.q3 + reach].max()


def test_sample_is_reproducible(spark):
    df = spark.range(100).select(F.col("id").alias("station_id"), F.lit("t").alias("timestamp"))
    a = {r.station_id for r in stats.scatter_sample(df, 10, 42).collect()}
    b = {r.station_id for r in stats.scatter_sample(df.repartition(7), 10, 42).collect()}
    c = {r.station_id for r in stats.scatter_sample(df, 10, 43).collect()}
    assert a == b and len(a) == 10 and a != c


def test_profile_and_catalog(spark):
    rows = [(1, "b", None), (2, "a", 1.5), (3, "b", 2.5), (4, "c", 1.5), (5, "d", 1.5)]
    df = spark.createDataFrame(rows, "timestamp long, kind string, v double")
    got = {r.column: r for r in quality.column_profile(df, ["timestamp"]).collect()}
    assert (got["kind"].span, got["kind"].n_distinct) == ("b, a, c, ...", 4)
    assert (got["v"].span, got["v"].n_null) == ("[1.5, 2.5]", 1)
    about = {r.column: r.n_distinct for r in quality.column_profile(df, ["timestamp"], True).collect()}
    assert about == {"timestamp": 5, "kind": 4, "v": 2}
    cat = {r.column: r for r in quality.column_catalog(df, {"kind": "a kind"}, order=["timestamp"]).collect()}
    assert (cat["kind"].description, cat["v"].examples, cat["v"].position) == ("a kind", "1.5, 2.5", 3)


def test_reconcile_counts_gaps(spark):
    df = spark.createDataFrame([(3.0, 1.0, 2.0), (5.0, 1.0, None)], "t double, a double, b double")
    row = quality.reconcile(df, {"t": ["a", "b"]}).first()
    assert (row.n_mismatch, row.gap_sum, row.gap_max) == (1, 4.0, 4.0)


def test_quantiles_of_wild_values_and_wrong_brackets(spark):
    g = np.random.default_rng(8)
    wild = np.concatenate((g.normal(size=1500) * 10.0 ** g.integers(-300, 300, 1500), [0.0] * 700, [1e308, -1e308], np.nextafter(1.0, 2) * np.ones(400), np.ones(400)))
    rows = [(1, float(v)) for v in wild] + [(2, float(v)) for v in g.normal(size=50)] + [(3, 7.0)] + [(4, None)]
    df = spark.createDataFrame(rows, "g long, x double").repartition(4)
    pdf = pd.DataFrame(rows, columns=["g", "x"])
    # A coarse sketch without a margin misses ranks on both sides; tiny brackets have to be cut again and again.
    for accuracy, small, spread in ((3, 5, 0.0), (20, 1, 0.0), (10_000, 50_000, 3.0)):
        got = exact_quantiles(df, ["x"], PROBS, ["g"], accuracy, small, spread).collect()
        assert len(got) == 3 * len(PROBS)
        for r in got:
            want = np.sort(pdf[pdf.g == r.g].x.dropna().to_numpy())
            at = (len(want) - 1) * r.prob
            left = int(at)
            a, b = want[left], want[min(left + 1, len(want) - 1)]
            assert np.isclose(r.value, a + (at - left) * (b - a) if at > left else a, rtol=1e-9), (accuracy, r)


def test_measured_columns_leave_out_flags_and_fixed_ones(spark):
    df = spark.createDataFrame([(1, 0, 5.0, 3, "a"), (2, 1, None, 3, "b"), (3, None, 0.0, 3, None)], "k long, flag int, x double, shop_area_m2 int, t string")
    assert stats.measured_columns(df) == ["k", "x"]
