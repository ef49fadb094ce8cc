"""Overview and station comparison: aggregates over the filtered hub.

Every function takes the hub with ``total_sales`` and ``total_shop_sales``. Averages
and sums merge inside each task first, so a busy group costs no more than another.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt import roles
from forecourt.functions import labels
from forecourt.functions.expressions import arg_max
from forecourt.operators.features import present, to_long
from forecourt.operators.firsts import first_known

STATION = "station_name"


def group(df: DataFrame, keys: list, cols: list[str], how=F.avg) -> DataFrame:
    """Grouped aggregate of several columns; rows with a null key are left out."""
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    for k in keys:
        df = df.where(k.isNotNull())
    return df.groupBy(*keys).agg(*[how(c).alias(c) for c in cols])


def group_long(df, keys, names, cols, var, val, how=F.avg) -> DataFrame:
    return to_long(group(df, keys, cols, how), names, cols, var, val)


def with_overall(small: DataFrame, **aggregates) -> DataFrame:
    """Aggregates over a result of few rows, beside each row, without computing it twice.

    Only for results whose length the calendar or a list of columns bounds.
    """
    rows = F.collect_list(F.struct(*small.columns)).alias("_rows")
    one = small.agg(rows, *[a.alias(n) for n, a in aggregates.items()])
    return one.select(F.explode("_rows").alias("_row"), *aggregates).select("_row.*", *aggregates)


def kpis(hub: DataFrame) -> DataFrame:
    """Fuel and shop totals, mean traffic, stations and the month that sells most.

    One row per station first, with its twelve months side by side.
    """
    months = [f"m{m}" for m in range(1, 13)]
    stations = hub.groupBy(STATION).agg(
        F.sum("total_sales").alias("fuel"),
        F.sum("total_shop_sales").alias("shop"),
        F.sum("total_traffic").alias("traffic"),
        F.count("total_traffic").alias("n"),
        *[F.expr(f"sum(CASE WHEN month = {m[1:]} THEN total_sales END) AS {m}") for m in months],
    )
    totals = stations.agg(
        F.sum("fuel").alias("fuel_total"),
        F.sum("shop").alias("shop_total"),
        (F.sum("traffic") / F.sum("n")).alias("mean_traffic"),
        F.count(STATION).alias("n_stations"),
        *[F.sum(m).alias(m) for m in months],
    )
    peak = F.array_position(F.array(*months), F.greatest(*months)).cast("int")
    return totals.withColumn("peak_month", peak).drop(*months)


def flag_peak(profile: DataFrame, key: str, value: str) -> DataFrame:
    """Marks the row with the largest value; the smallest key on ties."""
    out = with_overall(profile, _peak=arg_max(key, value))
    return out.withColumn("is_peak", (F.col(key) == F.col("_peak")).cast("int")).drop("_peak")


def monthly_sales(hub: DataFrame) -> DataFrame:
    months = flag_peak(group(hub, ["month"], ["total_sales"], F.sum), "month", "total_sales")
    return labels.with_label(months, "month", labels.MONTH_SHORT)


def mix(hub: DataFrame, cols: list[str], how, names: dict) -> DataFrame:
    """One aggregate per column and its share of their sum."""
    row = hub.agg(*[how(c).cast("double").alias(c) for c in cols])
    parts = with_overall(row.unpivot([], cols, "target", "value"), _whole=F.sum("value"))
    parts = parts.withColumn("share", F.try_divide("value", "_whole")).drop("_whole")
    return labels.with_label(parts, "target", names)


def fuel_mix(hub: DataFrame) -> DataFrame:
    return mix(hub, present(hub, roles.FUEL_TARGETS), F.sum, labels.FUEL)


def shop_mix(hub: DataFrame) -> DataFrame:
    return mix(hub, present(hub, roles.SHOP_TARGETS), F.avg, labels.SHOP)


def shop_by_station(hub: DataFrame) -> DataFrame:
    long = group_long(hub, [STATION], [STATION], roles.SHOP_TARGETS, "category", "revenue", F.sum)
    return labels.with_label(long, "category", labels.SHOP)


def fuel_by_station(hub: DataFrame) -> DataFrame:
    long = group_long(hub, [STATION], [STATION], roles.FUEL_TARGETS, "fuel", "sales", F.sum)
    return labels.with_label(long, "fuel", labels.FUEL)


def sales_by_station(hub: DataFrame) -> DataFrame:
    return group(hub, [STATION], ["total_sales"], F.sum).orderBy("total_sales", STATION)


def traffic_by_month(hub: DataFrame) -> DataFrame:
    return group(hub, ["month"], present(hub, roles.TRAFFIC))


def shop_by_hour(hub: DataFrame) -> DataFrame:
    hour = F.hour("timestamp").alias("hour")
    long = group_long(hub, [hour], ["hour"], roles.SHOP_TARGETS, "category", "revenue")
    return labels.with_label(long, "category", labels.SHOP)


def hour_profile(hub: DataFrame) -> DataFrame:
    profile = group(hub, [F.hour("timestamp").alias("hour")], ["total_sales"])
    return flag_peak(profile, "hour", "total_sales")


def dow_profile(hub: DataFrame) -> DataFrame:
    profile = group(hub, [F.weekday("timestamp").alias("weekday")], ["total_sales"])
    return labels.with_label(profile, "weekday", labels.WEEKDAY)


def season_profile(hub: DataFrame) -> DataFrame:
    """Means of the four seasons in fixed order; a season without rows stays, with null."""
    schema = T.StructType(
        [T.StructField("position", T.IntegerType()), T.StructField("season", T.StringType())]
    )
    seasons = hub.sparkSession.createDataFrame(list(enumerate(roles.SEASONS)), schema)
    means = group(hub, ["season"], ["total_sales"])
    out = F.broadcast(seasons).join(means, "season", "left")
    return labels.with_label(out, "season", labels.SEASON).orderBy("position")


def hour_dow_heatmap(hub: DataFrame, target: str) -> DataFrame:
    """Mean by hour and weekday, one row per cell."""
    keys = [F.hour("timestamp").alias("hour"), F.weekday("timestamp").alias("weekday")]
    cells = group(hub, keys, [target]).withColumnRenamed(target, "sales")
    return labels.with_label(cells, "weekday", labels.WEEKDAY)


def hour_dow_pivot(hub: DataFrame, target: str) -> DataFrame:
    """Mean by hour with one column per weekday value."""
    days = list(range(7))
    keyed = hub.select(
        F.hour("timestamp").alias("hour"), F.weekday("timestamp").alias("weekday"), target
    )
    wide = keyed.groupBy("hour").pivot("weekday", days).agg(F.avg(target))
    return wide.withColumnsRenamed({str(d): f"day_{d}" for d in days})


def flag_means(df: DataFrame, flags: list[str], value: str = "total_sales") -> DataFrame:
    """Mean where each flag is 0 and where it is 1, from one pass."""
    cells = [
        F.struct(
            F.lit(f).alias("flag"),
            F.lit(v).alias("active"),
            F.avg(F.when(F.col(f) == v, F.col(value))).alias("mean_sales"),
        )
        for f in flags
        for v in (0, 1)
    ]
    return df.agg(F.array(*cells).alias("a")).select(F.inline("a"))


def promo_effect(hub: DataFrame) -> DataFrame:
    """Mean sales without and with each promotion; zero where there is no such hour."""
    out = flag_means(hub, roles.PROMOTIONS).fillna({"mean_sales": 0.0})
    return labels.with_label(out, "flag", labels.PROMOTION)


def weekly_by_station(hub: DataFrame) -> DataFrame:
    week = F.weekofyear("timestamp").alias("week")
    return group(hub, [week, STATION], ["total_sales"], F.sum)


def mean_by(hub: DataFrame, column: str, value: str = "total_sales") -> DataFrame:
    return group(hub, [column], [value]).orderBy(value, column)


def by_road_type(hub: DataFrame) -> DataFrame:
    return mean_by(hub, "road_type")


def by_settlement(hub: DataFrame) -> DataFrame:
    return mean_by(hub, "settlement_size")


def _first(c):
    return F.min_by(c, F.when(F.col(c).isNotNull(), F.col("timestamp"))).alias(c)


def station_profile(hub: DataFrame) -> DataFrame:
    """Mean sales and the first known value of each passport attribute."""
    attributes = present(hub, roles.PROFILE_ATTRIBUTES)
    texts = [f.name for f in hub.schema if f.name in attributes and isinstance(f.dataType, T.StringType)]
    numbers = [_first(c) for c in attributes if c not in texts]
    out = hub.groupBy(STATION).agg(F.avg("total_sales").alias("avg_sales"), *numbers)
    if texts:
        tie = "station_id" if "station_id" in hub.columns else None
        out = out.join(first_known(hub, [STATION], texts, tie=tie), STATION)
    return out.select(STATION, "avg_sales", *attributes)


def station_competitors(profile: DataFrame) -> DataFrame:
    return profile.select(STATION, "competitors_within_5km").orderBy("competitors_within_5km", STATION)


def station_scores(profile: DataFrame) -> DataFrame:
    long = to_long(profile, [STATION], present(profile, roles.SCORES), "metric", "value")
    return labels.with_label(long, "metric", labels.SCORE)


def service_matrix(hub: DataFrame) -> DataFrame:
    return hub.groupBy(STATION).agg(*[_first(c) for c in present(hub, roles.SERVICES)])
