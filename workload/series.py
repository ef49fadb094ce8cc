"""Queries over the hourly series of each station."""

from pyspark.sql import functions as F

from forecourt import roles
from forecourt.functions.expressions import hours
from forecourt.operators import series as se
from forecourt.operators import stats
from forecourt.sources import standins
from workload import base, sql
from workload.joins import indexed_sql
from workload.registry import query, rounded
from workload.sources import SPLIT

IDS = ["station_id", "timestamp"]


def indexed(spark, folder, *cols):
    return base.indexed(base.hourly(spark, folder).select(*IDS, *cols))


@query(
    "time_index_daily",
    f"WITH {sql.DAILY_FACTS} SELECT station_id, timestamp, row_number() OVER (PARTITION BY station_id ORDER BY timestamp) - 1 AS time_idx FROM daily_facts",
)
def time_index_daily(spark, folder):
    """Several years per station, with gaps."""
    return se.with_time_idx(standins.daily_facts(spark, folder).select(*IDS))


_LENGTH = "count(*) OVER (PARTITION BY station_id)"


@query(
    "window_index",
    indexed_sql(
        f"""SELECT station_id, timestamp, time_idx, CAST(least(time_idx, 168) AS INTEGER) AS encoder_length,
        CAST(least(n - time_idx, 24) AS INTEGER) AS decoder_length FROM (SELECT *, {_LENGTH} AS n FROM idx) WHERE time_idx >= 84"""
    ),
)
def window_index(spark, folder):
    return se.window_index(indexed(spark, folder))


@query(
    "window_samples",
    indexed_sql(
        f"""SELECT station_id, origin_idx, h AS horizon_h, {sql.r('(h - 1) / CAST(encoder_length AS DOUBLE)', 'relative_time_idx')},
        {sql.r('(encoder_length - 84.0::DOUBLE) / 84.0::DOUBLE', 'encoder_length_scaled')} FROM (
          SELECT station_id, time_idx AS origin_idx, CAST(least(time_idx, 168) AS INTEGER) AS encoder_length,
          CAST(unnest(range(1, CAST(least(n - time_idx, 24) AS INTEGER) + 1)) AS INTEGER) AS h
          FROM (SELECT *, {_LENGTH} AS n FROM idx) WHERE time_idx >= 84)"""
    ),
)
def window_samples(spark, folder):
    samples = se.relative_time(se.window_samples(se.window_index(indexed(spark, folder))))
    return rounded(
        samples.select(
            "station_id",
            F.col("time_idx").alias("origin_idx"),
            "horizon_h",
            "relative_time_idx",
            "encoder_length_scaled",
        )
    )


@query(
    "window_index_of_test",
    indexed_sql(
        f"""SELECT station_id, min(time_idx) AS first_origin, max(time_idx) AS last_origin, count(*) AS n_origins
        FROM idx WHERE time_idx >= 84 AND {SPLIT} = 'test' GROUP BY station_id"""
    ),
)
def window_index_of_test(spark, folder):
    """Origins of the test split; their history reaches into earlier splits."""
    origins = se.window_index(indexed(spark, folder)).where(base.split_col() == "test")
    return origins.groupBy("station_id").agg(
        F.min("time_idx").alias("first_origin"),
        F.max("time_idx").alias("last_origin"),
        F.count(F.lit(1)).alias("n_origins"),
    )


@query(
    "encoder_arrays",
    indexed_sql(
        """SELECT station_id, timestamp, CAST(count(*) OVER w AS INTEGER) AS n_history,
        array_to_string(list(total_traffic) OVER w, ',') AS traffic FROM idx
        WINDOW w AS (PARTITION BY station_id ORDER BY time_idx ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING)"""
    ),
)
def encoder_arrays(spark, folder):
    arrays = se.encoder_arrays(indexed(spark, folder, "total_traffic"), ["total_traffic"])
    text = F.concat_ws(",", F.transform("history", lambda h: h["total_traffic"].cast("string")))
    return arrays.select(
        *IDS, F.size("history").alias("n_history"), F.when(F.size("history") > 0, text).alias("traffic")
    )


_TRAIN = f"timestamp <= TIMESTAMP '{standins.TRAIN_END}'"


@query(
    "target_scales",
    sql.hourly(
        " UNION ALL ".join(
            f"""SELECT '{t}' AS target, {sql.r(f'quantile_cont({t}, 0.5)', 'center')},
            {sql.r(f'quantile_cont({t}, 0.75) - quantile_cont({t}, 0.25)', 'scale')} FROM facts WHERE {_TRAIN}"""
            for t in roles.TARGETS
        )
    ),
)
def target_scales(spark, folder):
    return rounded(stats.target_scales(base.train_rows(base.hourly(spark, folder))))


@query(
    "split_report",
    indexed_sql(
        f"""SELECT {SPLIT} AS split, count(*) AS n_rows, min(timestamp) AS first_ts, max(timestamp) AS last_ts,
        count(CASE WHEN time_idx >= 84 THEN 1 END) AS n_windows, {sql.r('count(*) * 100.0::DOUBLE / sum(count(*)) OVER ()', 'share_pct')} FROM idx GROUP BY 1"""
    ),
)
def split_report(spark, folder):
    return rounded(se.split_report(indexed(spark, folder).withColumn("split", base.split_col())))


@query(
    "shortest_horizon",
    indexed_sql(
        "SELECT station_id, timestamp, min(horizon_h) AS horizon_h, arg_min(pred, horizon_h) AS pred FROM fc GROUP BY 1, 2",
        """, fc AS (SELECT station_id, timestamp + to_hours(h - 1) AS timestamp, h AS horizon_h, time_idx * 100 + h AS pred
        FROM (SELECT *, CAST(unnest(range(1, 25)) AS INTEGER) AS h FROM idx WHERE time_idx >= 84))""",
    ),
)
def shortest_horizon(spark, folder):
    """A forecast every hour; each hour keeps the one made last before it."""
    from forecourt.operators.joins import expand_horizon

    origins = indexed(spark, folder).where(F.col("time_idx") >= 84)
    steps = expand_horizon(origins)
    pred = steps.select(
        "station_id",
        (F.col("timestamp") + hours(F.col("horizon_h") - 1)).alias("timestamp"),
        "horizon_h",
        (F.col("time_idx") * 100 + F.col("horizon_h")).alias("pred"),
    )
    return se.shortest_horizon(pred)


@query(
    "tail_per_station",
    sql.hourly(
        """SELECT station_id, timestamp, total_traffic FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY timestamp DESC) AS rn
        FROM facts WHERE timestamp < TIMESTAMP '2024-01-28 00:00:00') WHERE rn <= 168"""
    ),
)
def tail_per_station(spark, folder):
    facts = base.hourly(spark, folder).select(*IDS, "total_traffic")
    return se.tail_per_station(facts, 168, "2024-01-28 00:00:00")


@query(
    "last_row_per_station",
    sql.hourly(
        """SELECT station_id, timestamp, total_traffic, ad_channel FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY timestamp DESC) AS rn
        FROM facts WHERE timestamp < TIMESTAMP '2024-01-28 00:00:00') WHERE rn = 1"""
    ),
)
def last_row_per_station(spark, folder):
    facts = base.hourly(spark, folder).select(*IDS, "total_traffic", "ad_channel")
    return se.last_row(facts, "2024-01-28 00:00:00")


@query(
    "gaps_filled",
    sql.hourly(
        f"""SELECT station_id, timestamp, weather_condition, {sql.r('temperature', 'temperature')} FROM (
          SELECT station_id, timestamp,
          coalesce(last_value(weather_condition IGNORE NULLS) OVER back, first_value(weather_condition IGNORE NULLS) OVER ahead) AS weather_condition,
          coalesce(last_value(temperature IGNORE NULLS) OVER back, first_value(temperature IGNORE NULLS) OVER ahead) AS temperature FROM facts
          WINDOW back AS (PARTITION BY station_id ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                 ahead AS (PARTITION BY station_id ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""
    ),
)
def gaps_filled(spark, folder):
    facts = base.hourly(spark, folder).select(*IDS, "weather_condition", "temperature")
    return rounded(se.fill_gaps(facts, ["weather_condition", "temperature"]))


@query(
    "gaps_filled_daily",
    f"""WITH {sql.DAILY_FACTS}, holes AS (SELECT station_id, timestamp, CASE WHEN total_traffic > 1 THEN total_traffic END AS v FROM daily_facts)
    SELECT station_id, timestamp, coalesce(last_value(v IGNORE NULLS) OVER back, first_value(v IGNORE NULLS) OVER ahead) AS v FROM holes
    WINDOW back AS (PARTITION BY station_id ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           ahead AS (PARTITION BY station_id ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
)
def gaps_filled_daily(spark, folder):
    """Many months per station, with whole months that hold no value."""
    days = standins.daily_facts(spark, folder)
    holes = days.select(*IDS, F.when(F.col("total_traffic") > 1, F.col("total_traffic")).alias("v"))
    return se.fill_gaps(holes, ["v"])


@query(
    "lag_columns",
    indexed_sql(
        f"""SELECT station_id, timestamp, {sql.r('lag(sales_AI92, 24) OVER w', 'sales_AI92_lag24')}, {sql.r('lag(sales_AI92, 168) OVER w', 'sales_AI92_lag168')}
        FROM idx WINDOW w AS (PARTITION BY station_id ORDER BY time_idx)"""
    ),
)
def lag_columns(spark, folder):
    out = se.lagged(indexed(spark, folder, "sales_AI92"), ["sales_AI92"])
    return rounded(out.select(*IDS, "sales_AI92_lag24", "sales_AI92_lag168"))
