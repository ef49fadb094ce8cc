"""Queries over scaling, encoding and the feature pipeline."""

from pyspark.sql import functions as F

from forecourt import roles
from forecourt.operators import encoding, scaling
from forecourt.plans import prepare
from forecourt.sources import scratch, standins
from workload import base, sql
from workload.registry import query, rounded
from workload.sources import SPLIT

IDS = ["station_id", "timestamp"]
TRAIN = f"timestamp <= TIMESTAMP '{standins.TRAIN_END}'"
COLUMNS = ["temperature", "visibility_km", "total_traffic", "competitor_price_AI92", "price_AI92", "traffic_Undefined"]


def fit_sql(cols, source):
    return " UNION ALL ".join(
        f"""SELECT station_id, '{c}' AS "column", avg({c}) AS mean, stddev_samp({c}) AS std FROM {source}
        WHERE {TRAIN} GROUP BY station_id"""
        for c in cols
    )


@query(
    "scalers_fitted",
    sql.hourly(f'SELECT station_id, "column", {sql.r("mean", "mean")}, {sql.r("std", "std")} FROM ({fit_sql(COLUMNS, "facts")})'),
)
def scalers_fitted(spark, folder):
    return rounded(scaling.fit_scalers(base.hourly(spark, folder), COLUMNS, standins.TRAIN_END))


@query(
    "scalers_applied",
    sql.hourly(
        "SELECT f.station_id, f.timestamp, "
        + ", ".join(
            sql.r(f"CASE WHEN s.s_{c} > 0 THEN (f.{c} - s.m_{c}) / s.s_{c} ELSE f.{c} END", c) for c in COLUMNS
        )
        + " FROM facts f JOIN (SELECT station_id, "
        + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in COLUMNS)
        + f" FROM facts WHERE {TRAIN} GROUP BY station_id) s USING (station_id)"
    ),
)
def scalers_applied(spark, folder):
    facts = base.hourly(spark, folder).select(*IDS, *COLUMNS)
    scalers = scaling.fit_scalers(facts, COLUMNS, standins.TRAIN_END)
    return rounded(scaling.apply_scalers(facts, scalers, COLUMNS))


CATS = ["road_type", "direction", "settlement_size", "season", "weather_condition", "ad_channel"]


@query(
    "label_dictionary",
    sql.merged(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", {c} AS value, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INTEGER) AS code
            FROM (SELECT DISTINCT {c} FROM merged WHERE {c} IS NOT NULL)"""
            for c in CATS
        )
    ),
)
def label_dictionary(spark, folder):
    return encoding.fit_labels(base.merged(spark, folder), CATS)


@query(
    "labels_applied",
    sql.merged(
        "SELECT station_id, timestamp, "
        + ", ".join(
            f"CAST({c}_rk AS INTEGER) AS {c}_enc" for c in CATS
        )
        + " FROM (SELECT *, "
        + ", ".join(f"CASE WHEN {c} IS NOT NULL THEN dense_rank() OVER (ORDER BY {c} NULLS LAST) - 1 END AS {c}_rk" for c in CATS)
        + " FROM merged)"
    ),
)
def labels_applied(spark, folder):
    df = base.merged(spark, folder).select(*IDS, *CATS)
    labels = scratch.materialise(encoding.fit_labels(df, CATS), "labels")
    return encoding.apply_labels(df, labels, CATS).drop(*CATS)


@query(
    "ad_channel_codes",
    sql.merged(
        """SELECT CAST(row_number() OVER (ORDER BY ad_channel) - 1 AS INTEGER) AS ad_channel_enc, ad_channel
        FROM (SELECT DISTINCT ad_channel FROM merged WHERE ad_channel IS NOT NULL)"""
    ),
)
def ad_channel_codes(spark, folder):
    df = base.merged(spark, folder).where(F.col("ad_channel").isNotNull()).select("ad_channel")
    labels = scratch.materialise(encoding.fit_labels(df, ["ad_channel"]), "labels")
    return encoding.label_map(encoding.apply_labels(df, labels, ["ad_channel"]), "ad_channel")


# The numeric columns that the pipeline scales; the rest is 0/1, static, price, target or key.
_SCALED = ["temperature", "precipitation_mm", "visibility_km", "wind_speed_ms", *roles.TRAFFIC, *roles.RIVAL_PRICES, *roles.CALENDAR]
_CYCLES = [f"{c}_{f}" for c in roles.CYCLE_PERIODS for f in ("sin", "cos")]
_CODES = ["season", "ad_channel", "holiday_name", "weather_condition", *roles.STATIC_CATEGORIES]
_FLAGS = ["is_weekend", "is_rush_hour", "is_shop_open"]


def _prepared_sql():
    def cyc(name):
        c, f = name.rsplit("_", 1)
        return f"{f}({c} * (2 * pi()) / {roles.CYCLE_PERIODS[c]})"

    cyc_cols = ", ".join(f"{cyc(n)} AS {n}" for n in _CYCLES)
    codes = ", ".join(f"dense_rank() OVER (ORDER BY {c} NULLS LAST) - 1 AS {c}_enc" for c in _CODES)
    rows = f""", rows AS (SELECT m.* EXCLUDE (holiday_name, ad_channel), coalesce(holiday_name, '{roles.NO_HOLIDAY}') AS holiday_name,
      coalesce(ad_channel, '{roles.NO_ADVERT}') AS ad_channel, CAST(hour BETWEEN 5 AND 21 AS INTEGER) AS is_shop_open, {cyc_cols},
      row_number() OVER (PARTITION BY station_id ORDER BY timestamp) - 1 AS time_idx FROM merged m),
    coded AS (SELECT *, {codes} FROM rows),
    binary_cols AS (SELECT {', '.join(f'bool_and({c} IN (0, 1)) AS {c}' for c in _SCALED)} FROM rows),
    fit AS (SELECT station_id, {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in _SCALED + _CYCLES)}
      FROM rows WHERE {TRAIN} GROUP BY station_id)"""

    def z(c):
        test = f"f.s_{c} > 0"
        if c in _SCALED:
            test += f" AND NOT (SELECT {c} FROM binary_cols)"
        return sql.r(f"CASE WHEN {test} THEN (r.{c} - f.m_{c}) / f.s_{c} ELSE r.{c} END", c)

    body = f"""SELECT r.station_id, r.timestamp, r.time_idx, {SPLIT.replace('timestamp <=', 'r.timestamp <=')} AS split,
      {', '.join(z(c) for c in _SCALED + _CYCLES)},
      {', '.join(f"CASE WHEN r.{c} IS NOT NULL THEN CAST(r.{c}_enc AS INTEGER) END AS {c}_enc" for c in _CODES)},
      {', '.join('r.' + c for c in _FLAGS)},
      {sql.r('r.price_AI92', 'price_AI92')}, {sql.r('r.distance_to_city_km', 'distance_to_city_km')},
      {', '.join(sql.r(f'ln(1 + r.{t})', t) + ', ' + sql.r(f'r.{t}', t + '_orig') for t in roles.TARGETS)}
      FROM coded r LEFT JOIN fit f USING (station_id)"""
    return f"WITH {sql.MERGED}{rows} {body}"


def prepared(spark, folder):
    return prepare.prepare(base.merged_table(spark, folder), standins.TRAIN_END, standins.VAL_END)


@query("prepared_table", _prepared_sql())
def prepared_table(spark, folder):
    """The whole feature pipeline on the merged facts."""
    rows, _, _ = prepared(spark, folder)
    rows = rows.withColumns({c: F.col(c).cast("double") for c in _SCALED})
    cols = [*IDS, "time_idx", "split", *_SCALED, *_CYCLES, *[f"{c}_enc" for c in _CODES], *_FLAGS]
    cols += ["price_AI92", "distance_to_city_km"]
    cols += [x for t in roles.TARGETS for x in (t, t + "_orig")]
    return rounded(rows.select(*cols))


@query(
    "prepared_splits_written",
    sql.hourly(f"SELECT {SPLIT} AS split, count(*) AS n_rows, min(timestamp) AS first_ts, max(timestamp) AS last_ts FROM facts GROUP BY 1"),
)
def prepared_splits_written(spark, folder):
    rows, _, _ = prepared(spark, folder)
    path = scratch.new_path(spark, "prepared")
    prepare.write_splits(rows, path)
    parts = [prepare.read_split(spark, path, s) for s in ("train", "val", "test")]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return whole.groupBy(F.col("split").cast("string").alias("split")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
    )


def _scaler_table_sql():
    def angle(name):
        c, f = name.rsplit("_", 1)
        return f"{f}({c} * (2 * pi()) / {roles.CYCLE_PERIODS[c]})"

    def fit(name, x, where=""):
        return f"""SELECT station_id, '{name}' AS "column", {sql.r(f'avg({x})', 'mean')}, {sql.r(f'stddev_samp({x})', 'std')}
        FROM merged WHERE {TRAIN} {where} GROUP BY station_id"""

    parts = [fit(c, c, f"AND NOT (SELECT bool_and({c} IN (0, 1)) FROM merged)") for c in _SCALED]
    return sql.merged(" UNION ALL ".join(parts + [fit(n, angle(n)) for n in _CYCLES]))


@query("prepared_scaler_table", _scaler_table_sql())
def prepared_scaler_table(spark, folder):
    _, scalers, _ = prepared(spark, folder)
    return rounded(scalers)
