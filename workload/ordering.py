"""Queries over ordering, top-k and set operations."""

from pyspark.sql import functions as F

from forecourt.operators import ordering, overview, series
from forecourt.sources import standins
from workload import base, sql
from workload.joins import indexed_sql
from workload.registry import query, rounded


@query(
    "time_index_order",
    indexed_sql("SELECT station_id, timestamp, time_idx FROM idx"),
)
def time_index_order(spark, folder):
    facts = base.hourly(spark, folder).select("station_id", "timestamp")
    return series.with_time_idx(facts)


@query(
    "ordered_nulls_first",
    sql.merged(
        f"""SELECT weather_condition, {sql.r('avg(temperature)', 'temperature')}, count(*) AS n_rows
        FROM merged GROUP BY weather_condition ORDER BY 2 NULLS FIRST"""
    ),
)
def ordered_nulls_first(spark, folder):
    out = base.merged(spark, folder).groupBy("weather_condition").agg(
        F.avg("temperature").alias("temperature"), F.count(F.lit(1)).alias("n_rows")
    )
    return rounded(ordering.ordered(out, ["temperature"], nulls_first=True))


@query(
    "top_stations",
    sql.daily(
        f"""SELECT station_name, {sql.r('s', 'total_sales', 2)} FROM (SELECT station_name, sum(total_sales) AS s FROM daily GROUP BY 1)
        ORDER BY s DESC, station_name LIMIT 20"""
    ),
)
def top_stations(spark, folder):
    totals = overview.sales_by_station(base.daily(spark, folder))
    return rounded(ordering.top_k(totals, "total_sales", 20, "station_name"), 2)


@query(
    "peak_and_low_hour",
    sql.hub(
        f"""SELECT * FROM (SELECT 'max' AS side, hour, {sql.r('s', 'total_sales')} FROM (SELECT hour, avg(total_sales) AS s FROM hub GROUP BY hour) ORDER BY s DESC, hour LIMIT 1)
        UNION ALL SELECT * FROM (SELECT 'min' AS side, hour, {sql.r('s', 'total_sales')} FROM (SELECT hour, avg(total_sales) AS s FROM hub GROUP BY hour) ORDER BY s, hour LIMIT 1)"""
    ),
)
def peak_and_low_hour(spark, folder):
    hours = overview.group(base.hub(spark, folder), ["hour"], ["total_sales"])
    top = ordering.arg_max(hours, "hour", "total_sales").withColumn("side", F.lit("max"))
    low = ordering.arg_min(hours, "hour", "total_sales").withColumn("side", F.lit("min"))
    return rounded(top.unionByName(low))


@query(
    "history_and_future",
    sql.hourly(
        f"""SELECT station_id, timestamp, total_traffic, NULL::BOOLEAN AS is_future FROM facts WHERE timestamp <= TIMESTAMP '{standins.VAL_END}'
        UNION ALL SELECT station_id, timestamp, NULL AS total_traffic, TRUE AS is_future FROM facts WHERE timestamp > TIMESTAMP '{standins.VAL_END}'"""
    ),
)
def history_and_future(spark, folder):
    facts = base.hourly(spark, folder).select("station_id", "timestamp", "total_traffic")
    end = F.lit(standins.VAL_END).cast("timestamp_ntz")
    future = facts.where(F.col("timestamp") > end).drop("total_traffic").withColumn("is_future", F.lit(True))
    return ordering.append_future(facts.where(F.col("timestamp") <= end), future)


@query(
    "columns_added_together",
    sql.hourly("SELECT station_id, timestamp, hour * 2 AS twice, CAST(total_traffic > 2 AS INTEGER) AS is_busy FROM facts"),
)
def columns_added_together(spark, folder):
    facts = base.hourly(spark, folder).select("station_id", "timestamp", "hour", "total_traffic")
    added = {"twice": F.col("hour") * 2, "is_busy": (F.col("total_traffic") > 2).cast("int")}
    return ordering.with_all(facts, added).drop("hour", "total_traffic")


@query(
    "distinct_channels",
    sql.merged("SELECT DISTINCT ad_channel, weather_condition FROM merged"),
)
def distinct_channels(spark, folder):
    return ordering.distinct_rows(base.merged(spark, folder), ["ad_channel", "weather_condition"])
