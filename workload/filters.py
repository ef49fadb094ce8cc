"""Queries over filters and predicates. Each reports what a filter keeps."""

from pyspark.sql import functions as F

from forecourt import roles
from forecourt.operators import features, filters
from forecourt.sources import standins
from workload import base, sql
from workload.registry import query, rounded
from workload.sources import SPLIT

MEASURES = (
    f"count(*) AS n_rows, {sql.r('sum(total_sales)', 'sales')}, {sql.r('avg(total_traffic)', 'traffic')}"
)


def kept(df):
    """Rows, sales and mean traffic per station of what a filter keeps."""
    return rounded(
        df.groupBy("station_id").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("total_sales").alias("sales"),
            F.avg("total_traffic").alias("traffic"),
        )
    )


def kept_sql(where, table="hub"):
    make = sql.hub if table == "hub" else sql.daily
    source = "hub" if table == "hub" else "daily"
    return make(f"SELECT station_id, {MEASURES} FROM {source} WHERE {where} GROUP BY station_id")


@query("filter_stations_months", kept_sql("station_name IN ('Supplier#000000001', 'Supplier#000000002', 'Supplier#000000007') AND month IN (1, 6, 12)", "daily"))
def filter_stations_months(spark, folder):
    names = [f"Supplier#{i:09d}" for i in (1, 2, 7)]
    return kept(filters.filter_hub(base.daily(spark, folder), names, [1, 6, 12]))


@query("filter_nothing_chosen", kept_sql("TRUE", "daily"))
def filter_nothing_chosen(spark, folder):
    return kept(filters.filter_hub(base.daily(spark, folder)))


@query("filter_season", kept_sql("season IN ('winter', 'summer')", "daily"))
def filter_season(spark, folder):
    return kept(filters.filter_analysis(base.daily(spark, folder), season=["winter", "summer"]))


@query("filter_day_type", kept_sql("is_weekend = 1 OR is_holiday = 1"))
def filter_day_type(spark, folder):
    return kept(filters.filter_analysis(base.hub(spark, folder), day_type=["weekend", "holiday"]))


@query("filter_weather", kept_sql("(is_rain = 0 AND is_snow = 0 AND is_fog = 0) OR is_fog = 1"))
def filter_weather(spark, folder):
    return kept(filters.filter_analysis(base.hub(spark, folder), weather=["clear", "fog"]))


@query(
    "filter_promotion",
    kept_sql(
        "promotion_fuel_active = 1 OR (promotion_fuel_active = 0 AND promotion_shop_active = 0 AND promotion_cafe_active = 0)"
    ),
)
def filter_promotion(spark, folder):
    return kept(filters.filter_analysis(base.hub(spark, folder), promo=["fuel", "none"]))


@query("filter_holiday_only", kept_sql("is_holiday = 1"))
def filter_holiday_only(spark, folder):
    return kept(filters.filter_analysis(base.hub(spark, folder), holiday="only"))


@query("filter_holiday_without", kept_sql("is_holiday = 0", "daily"))
def filter_holiday_without(spark, folder):
    return kept(filters.filter_analysis(base.daily(spark, folder), holiday="without"))


@query("filter_distance", kept_sql("distance_to_city_km BETWEEN 10 AND 60", "daily"))
def filter_distance(spark, folder):
    return kept(filters.filter_analysis(base.daily(spark, folder), distance=(10.0, 60.0)))


@query(
    "filter_place",
    kept_sql("road_type IN ('ASIA', 'EUROPE') AND direction IN ('0', '1') AND settlement_size <> 'NATION_3'", "daily"),
)
def filter_place(spark, folder):
    df = base.daily(spark, folder)
    towns = [f"NATION_{i}" for i in range(25) if i != 3]
    return kept(
        filters.filter_analysis(df, road=["ASIA", "EUROPE"], direction=["0", "1"], settlement=towns)
    )


@query("filter_falls_back", kept_sql("TRUE"))
def filter_falls_back(spark, folder):
    """No row has weekend and negative distance, so the whole hub comes back."""
    hub = base.hub(spark, folder)
    none = filters.filter_analysis(hub, day_type=["weekend"], distance=(-2.0, -1.0))
    return kept(filters.filter_or_fallback(none, hub))


@query("filter_keeps_match", kept_sql("is_weekend = 1"))
def filter_keeps_match(spark, folder):
    hub = base.hub(spark, folder)
    some = filters.filter_analysis(hub, day_type=["weekend"])
    return kept(filters.filter_or_fallback(some, hub))


@query(
    "target_subset_totals",
    sql.merged(
        f"""SELECT station_id, {sql.r('sum(sales_AI92 + sales_DT_EURO)', 'total_sales')},
        {sql.r('sum(shop_coffee)', 'total_shop_sales')} FROM merged GROUP BY station_id"""
    ),
)
def target_subset_totals(spark, folder):
    df = features.with_sales(base.merged(spark, folder), ["sales_AI92", "sales_DT_EURO"], ["shop_coffee"])
    out = df.groupBy("station_id").agg(
        F.sum("total_sales").alias("total_sales"), F.sum("total_shop_sales").alias("total_shop_sales")
    )
    return rounded(out)


@query(
    "split_rows",
    sql.hourly(f"SELECT station_id, timestamp, {SPLIT} AS split FROM facts WHERE {SPLIT} <> 'train'"),
)
def split_rows(spark, folder):
    facts = base.hourly(spark, folder).select("station_id", "timestamp")
    parts = [
        filters.in_split(facts, s, standins.TRAIN_END, standins.VAL_END).withColumn("split", F.lit(s))
        for s in ("val", "test")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "context_slice",
    sql.hourly(
        """SELECT station_id, timestamp, total_traffic FROM facts
        WHERE timestamp >= TIMESTAMP '2024-01-28 00:00:00' - INTERVAL 168 HOUR AND timestamp <= TIMESTAMP '2024-01-29 23:00:00'"""
    ),
)
def context_slice(spark, folder):
    facts = base.hourly(spark, folder).select("station_id", "timestamp", "total_traffic")
    return filters.context_slice(facts, "2024-01-28 00:00:00", "2024-01-29 23:00:00")


@query(
    "context_slice_one_station",
    sql.hourly(
        """SELECT station_id, timestamp, total_traffic FROM facts WHERE station_id = 0
        AND timestamp >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 168 HOUR AND timestamp <= TIMESTAMP '2024-01-20 23:00:00'"""
    ),
)
def context_slice_one_station(spark, folder):
    facts = base.hourly(spark, folder).select("station_id", "timestamp", "total_traffic")
    return filters.context_slice(facts, "2024-01-20 00:00:00", "2024-01-20 23:00:00", 0)


@query(
    "complete_pairs",
    sql.hub(
        f"SELECT station_id, count(*) AS n_rows, {sql.r('avg(comp_ratio_DT)', 'ratio')} FROM hub "
        "WHERE comp_ratio_DT IS NOT NULL AND temperature IS NOT NULL GROUP BY station_id"
    ),
)
def complete_pairs(spark, folder):
    pairs = filters.complete(base.hub(spark, folder), ["comp_ratio_DT", "temperature"])
    out = pairs.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg("comp_ratio_DT").alias("ratio")
    )
    return rounded(out)


@query(
    "known_targets_only",
    sql.hourly(
        f"""SELECT target, {sql.r('sum(y)', 'total')} FROM
        (SELECT {', '.join(roles.TARGETS)} FROM facts) UNPIVOT (y FOR target IN ({', '.join(roles.TARGETS)}))
        WHERE target IN (SELECT target FROM (SELECT {', '.join(roles.TARGETS)} FROM facts)
          UNPIVOT (y FOR target IN ({', '.join(roles.TARGETS)})) WHERE y > 0) GROUP BY target"""
    ),
)
def known_targets_only(spark, folder):
    """Targets that were ever sold; summer diesel never is."""
    long = features.to_long(base.hourly(spark, folder), ["station_id"], roles.TARGETS, "target", "y")
    totals = long.groupBy("target").agg(F.sum("y").alias("total"))
    sold = long.where(F.col("y") > 0).select("target").distinct()
    return rounded(filters.known_targets(totals, sold))
