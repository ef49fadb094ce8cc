"""Hand-made cases of projections, calendars, filters and sources."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from forecourt import roles
from forecourt.functions import calendar, labels
from forecourt.functions.expressions import arg_max, duration_text, hours_between, moment
from forecourt.operators import encoding, features, filters, joins, scaling
from forecourt.sources import schemas, tables


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_first_of_january_is_iso_week_52_and_a_sunday(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2023-01-01 23:00:00' AS timestamp")
    row = one(calendar.with_season(calendar.with_calendar_flags(calendar.with_calendar(df))))
    assert (row.week_of_year, row.day_of_week, row.is_weekend) == (52, 6, 1)
    assert (row.hour, row.is_night, row.is_rush_hour) == (23, 1, 0)
    assert (row.season, row.quarter, row.day_name) == ("winter", 1, "Sunday")


def test_shop_opening_hours(spark):
    rows = calendar.with_shop_open(spark.range(24).withColumnRenamed("id", "hour")).collect()
    assert [r.hour for r in rows if r.is_shop_open] == list(range(5, 22))


def test_row_sum_skips_nulls_and_keeps_existing(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "sales_AI92 double, sales_AI95 double")
    out = features.with_row_sum(df, "total", roles.FUEL_TARGETS).collect()
    assert [r.total for r in out] == [1.0, 5.0]
    kept = features.with_row_sum(df.withColumn("total", F.lit(9.0)), "total", ["sales_AI92"], True)
    assert {r.total for r in kept.collect()} == {9.0}


def test_zero_price_gives_no_ratio(spark):
    df = spark.createDataFrame([(50.0, 0.0), (50.0, 25.0)], "competitor_price_AI92 double, price_AI92 double")
    assert [r.comp_ratio_AI92 for r in features.with_price_ratio(df).collect()] == [None, 2.0]


def test_diesel_ratio_takes_the_first_diesel_price(spark):
    df = spark.createDataFrame([(60.0, 30.0)], "competitor_price_DT double, price_DT_TANEKO double")
    assert one(features.with_price_ratio(df)).comp_ratio_DT == 2.0


def test_fill_only_present_columns(spark):
    df = spark.createDataFrame([(None,)], "ad_channel string")
    assert one(features.fill_missing(df)).ad_channel == roles.NO_ADVERT
    assert features.fill_missing(spark.range(1)).columns == ["id"]


def test_cycle_lies_on_the_unit_circle(spark):
    df = spark.range(24).withColumnRenamed("id", "hour")
    for r in features.add_cyclical(df).collect():
        assert math.isclose(r.hour_sin**2 + r.hour_cos**2, 1.0, abs_tol=1e-12)


def test_log_and_back(spark):
    df = spark.createDataFrame([(0.0,), (3.5,), (1e6,)], "sales_AI92 double")
    back = features.exp_targets(features.log_targets(df)).collect()
    for r in back:
        assert math.isclose(r.sales_AI92, r.sales_AI92_orig, rel_tol=1e-12, abs_tol=1e-12)


def test_negative_logs_count_as_zero(spark):
    assert one(spark.range(1).select(features.unlog(F.lit(-2.0)).alias("x"))).x == 0.0


def test_code_text_drops_the_fraction(spark):
    df = spark.createDataFrame([("2.0", 2.0), ("2.5", 2.5), ("007", None)], "c string, d double")
    out = features.normalise_types(df, [], ["c", "d"]).collect()
    assert [r.c for r in out] == ["2", "2.5", "007"] and [r.d for r in out] == ["2", "2.5", None]


def test_ids_and_mixed_codes_stay_as_they_are(spark):
    rows = [(9007199254740993, "007", "2.0"), (9007199254740992, "7", "A1"), (None, None, None)]
    df = spark.createDataFrame(rows, "station_id long, other string, mixed string")
    out = features.normalise_types(df, ["station_id", "other"], ["mixed"]).collect()
    assert [r.station_id for r in out] == ["9007199254740993", "9007199254740992", None]
    assert [r.other for r in out] == ["007", "7", None] and [r.mixed for r in out] == ["2.0", "A1", None]


def test_column_classes(spark):
    rows = [(1, 0, 5.0), (1, 1, 5.0), (2, None, 6.0)]
    df = spark.createDataFrame(rows, "station_id long, flag int, price double")
    found = {r.column: (r.is_binary, r.is_constant) for r in features.classify_columns(df).collect()}
    assert found == {"flag": (True, False), "price": (False, True)}
    assert "flag" in features.binary_columns(df)


def test_unknown_code_keeps_its_code(spark):
    df = spark.createDataFrame([(1,), (13,)], "m int")
    out = [r.label for r in labels.with_label(df, "m", labels.MONTH).collect()]
    assert out == ["January", "13"]


def test_clamp_takes_the_first_known_value(spark):
    df = spark.createDataFrame([("b",), ("x",), (None,)], "c string")
    known = spark.createDataFrame([("b",), ("a",)], "value string")
    assert sorted(r.c for r in joins.clamp_category(df, "c", known).collect()) == ["a", "a", "b"]


def test_tie_goes_to_the_smaller_key(spark):
    df = spark.createDataFrame([(5, 2.0), (3, 2.0), (4, 1.0), (1, None)], "k int, v double")
    assert one(df.agg(arg_max("k", "v").alias("k"))).k == 3


def test_duration_text(spark):
    df = spark.createDataFrame([(None,), (0.0,), (59.0,), (61.0,), (3700.0,)], "s double")
    assert [r[0] for r in df.select(duration_text("s")).collect()] == ["-", "-", "59s", "1m 01s", "1h 01m"]


def test_hours_between_do_not_depend_on_the_time_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2023-03-25 00:00:00' a, TIMESTAMP_NTZ'2023-03-27 00:00:00' b")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        assert one(df.select(hours_between("a", "b").alias("h"))).h == 48
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_empty_filter_falls_back(spark):
    df = spark.createDataFrame([(1, 0), (0, 1)], "is_weekend int, is_holiday int")
    none = filters.filter_analysis(df.where("is_weekend = 0"), day_type=["weekend"])
    assert filters.filter_or_fallback(none, df).count() == 2
    some = filters.filter_analysis(df, holiday="only")
    assert filters.filter_or_fallback(some, df).count() == 1


def test_split_bounds_belong_to_the_earlier_split(spark):
    df = spark.sql(
        "SELECT explode(array(TIMESTAMP_NTZ'2023-10-31 23:00:00', TIMESTAMP_NTZ'2023-11-01 00:00:00', "
        "TIMESTAMP_NTZ'2023-11-30 23:00:00', TIMESTAMP_NTZ'2023-12-01 00:00:00')) AS timestamp"
    )
    got = [filters.in_split(df, s).count() for s in ("train", "val", "test")]
    assert got == [1, 2, 1]


def test_context_reaches_back_a_week(spark):
    df = spark.sql(
        "SELECT 1L AS station_id, explode(sequence(TIMESTAMP_NTZ'2023-01-01 00:00:00', "
        "TIMESTAMP_NTZ'2023-01-31 23:00:00', INTERVAL 1 HOUR)) AS timestamp"
    )
    out = filters.context_slice(df, "2023-01-10 00:00:00", "2023-01-10 23:00:00")
    assert out.count() == 168 + 24


def test_missing_and_empty_source_switch_a_feature_off(spark, tmp_path):
    df, there = tables.optional_table(spark, str(tmp_path / "no.parquet"), schemas.METRICS)
    assert not there and df.columns == schemas.METRICS.fieldNames()
    path = str(tmp_path / "empty.parquet")
    spark.createDataFrame([], schemas.METRICS).write.parquet(path)
    assert tables.optional_table(spark, path, schemas.METRICS)[1] is False


def test_required_columns_are_checked(spark):
    with pytest.raises(ValueError, match="station_id"):
        tables.check_roles(spark.range(1))
    kept = tables.check_roles(spark.range(1).select(F.lit(1).alias("station_id"), F.lit(1.0).alias("sales_AI92")))
    assert kept["targets"] == ["sales_AI92"]


def test_role_counts():
    assert [len(v) for v in roles.ROLES.values()] == [12, 3, 26, 4, 44, 0]
    assert len(schemas.FACTS) == 72 and len(schemas.PASSPORT) == 32


def test_csv_facts_are_renamed_and_nan_is_null(spark, tmp_path):
    path = str(tmp_path / "facts.csv")
    with open(path, "w") as f:
        f.write("timestamp,station_id,shop_кофе\n2023-01-01 00:00:00,1,NaN\n2023-01-01 01:00:00,1,2.5\n")
    schema = schemas.T.StructType([x for x in schemas.FACTS.fields if x.name in ("timestamp", "station_id", "shop_кофе")])
    rows = tables.read_facts(spark, path, schema).collect()
    assert [r.shop_coffee for r in rows] == [None, 2.5]
    assert rows[0].timestamp == dt.datetime(2023, 1, 1)


def test_merge_keeps_rows_and_adds_only_missing_columns(spark):
    facts = spark.createDataFrame([(1, "fact"), (2, "fact"), (9, "fact")], "station_id long, road_type string")
    dim = spark.createDataFrame([(1, "dim", 4), (2, "dim", 5)], "station_id long, road_type string, total_pumps int")
    out = joins.merge_metadata(facts, dim).orderBy("station_id").collect()
    assert [(r.road_type, r.total_pumps) for r in out] == [("fact", 4), ("fact", 5), ("fact", None)]


def test_train_rows_alone_fit_the_scaler(spark):
    rows = [(1, dt.datetime(2023, 10, 31, h), float(h)) for h in range(24)]
    rows += [(1, dt.datetime(2023, 12, 1, 0), 1e9)]
    df = spark.createDataFrame(rows, "station_id long, timestamp timestamp_ntz, temperature double")
    scalers = scaling.fit_scalers(df, ["temperature"])
    z = scaling.apply_scalers(df, scalers, ["temperature"]).where(F.col("timestamp") <= moment(roles.TRAIN_END))
    row = one(z.agg(F.avg("temperature").alias("m"), F.stddev_samp("temperature").alias("s")))
    assert math.isclose(row.m, 0.0, abs_tol=1e-9) and math.isclose(row.s, 1.0, rel_tol=1e-9)


def test_constant_column_is_left_alone_by_scaling_and_zero_in_overrides(spark):
    rows = [(1, dt.datetime(2023, 1, 1, h), 7.0) for h in range(3)]
    df = spark.createDataFrame(rows, "station_id long, timestamp timestamp_ntz, price double")
    scalers = scaling.fit_scalers(df, ["price"])
    assert {r.price for r in scaling.apply_scalers(df, scalers, ["price"]).collect()} == {7.0}
    over = spark.createDataFrame([(1, "price", 9.0), (1, "other", 9.0)], "station_id long, column string, value double")
    z = {r.column: r.z for r in joins.normalise_override(over, scalers).collect()}
    assert z == {"price": 0.0, "other": None}


def test_labels_follow_sorted_order_and_unknown_is_null(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "c string")
    d = encoding.fit_labels(df, ["c"])
    assert {r.value: r.code for r in d.collect()} == {"a": 0, "b": 1, "c": 2}
    new = spark.createDataFrame([("z",)], "c string")
    assert one(encoding.apply_labels(new, d, ["c"])).c_enc is None


def test_labels_of_long_and_short_columns(spark):
    from forecourt.operators import encoding
    from forecourt.sources import scratch

    rows = [(i, f"v{i * 7919 % 300:03d}", "abc"[i % 3] if i % 5 else None) for i in range(900)]
    df = spark.createDataFrame(rows, "i long, wide string, short string").repartition(4)
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    dictionary = scratch.materialise(encoding.fit_labels(df, ["wide", "short", "absent"]), "dictionary")
    spark.conf.unset(merge)
    got = {(r.column, r.value): r.code for r in dictionary.collect()}
    assert got == {("wide", f"v{k:03d}"): k for k in range(300)} | {("short", c): k for k, c in enumerate("abc")}
    coded = encoding.apply_labels(df, dictionary.where("value != 'v007' AND value != 'b'"), ["wide", "short"])
    assert coded.columns == ["i", "wide", "short", "short_enc", "wide_enc"]
    for r in coded.collect():
        assert r.wide_enc == (None if r.wide == "v007" else int(r.wide[1:]))
        assert r.short_enc == {"a": 0, "c": 2}.get(r.short)


def test_first_known_values(spark):
    import datetime as dt

    from forecourt.operators.firsts import first_known

    t = dt.datetime(1969, 12, 31, 23, 59, 59, 250000)
    rows = [("k", t, 2, None, 5), ("k", t, 1, None, None), ("k", t + dt.timedelta(microseconds=1), 9, "late", 6),
            ("k", t + dt.timedelta(days=40), 0, "later", 7), ("m", t, 3, None, None)]
    df = spark.createDataFrame(rows, "key string, timestamp timestamp_ntz, station_id long, name string, n int")
    got = {r.key: (r.name, r.n) for r in first_known(df, ["key"], ["name", "n"]).collect()}
    assert got == {"k": ("late", 5), "m": (None, None)}
