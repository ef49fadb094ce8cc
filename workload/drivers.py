"""Queries on what moves sales."""

from pyspark.sql import functions as F

from forecourt import roles
from forecourt.functions import labels
from forecourt.operators import drivers as d
from workload import base, sql
from workload.overview import _grouped_long, flag_sql
from workload.registry import query, rounded


@query(
    "by_weather",
    sql.hub(
        f"SELECT weather_condition, {sql.r('avg(total_sales)', 'total_sales', 9)} FROM hub WHERE weather_condition IS NOT NULL GROUP BY 1"
    ),
)
def by_weather(spark, folder):
    return rounded(d.by_weather(base.hub(spark, folder)), 9)


@query("weather_flag_effect", sql.hub(flag_sql(["is_rain", "is_snow", "is_fog"], labels.WEATHER_FLAG)))
def weather_flag_effect(spark, folder):
    return rounded(d.weather_flag_effect(base.hub(spark, folder)), 9)


@query(
    "by_ad_channel",
    sql.hub(
        f"""SELECT ad_channel, {sql.r('avg(total_sales)', 'total_sales', 9)},
        round((SELECT coalesce(avg(total_sales), 0) FROM hub WHERE ad_channel = '{roles.NO_ADVERT}'), 9) AS no_ad_sales FROM hub GROUP BY ad_channel"""
    ),
)
def by_ad_channel(spark, folder):
    return rounded(d.by_ad_channel(base.hub(spark, folder)), 9)


@query(
    "shop_by_ad_channel",
    sql.hub(f"SELECT ad_channel, {sql.r('avg(shop_total_revenue)', 'shop_total_revenue', 9)} FROM hub GROUP BY ad_channel"),
)
def shop_by_ad_channel(spark, folder):
    return rounded(d.shop_by_ad_channel(base.hub(spark, folder)), 9)


@query(
    "promo_by_fuel",
    _grouped_long("promotion_fuel_active", "active", roles.FUEL_TARGETS, "avg", "fuel", "sales", labels.FUEL, "hub", 9),
)
def promo_by_fuel(spark, folder):
    return rounded(d.promo_by_fuel(base.hub(spark, folder), "promotion_fuel_active", roles.FUEL_TARGETS), 9)


@query(
    "promo_by_shop",
    _grouped_long("promotion_shop_active", "active", roles.SHOP_TARGETS, "avg", "category", "revenue", labels.SHOP, "hub", 9),
)
def promo_by_shop(spark, folder):
    return rounded(d.promo_by_shop(base.hub(spark, folder), "promotion_shop_active"), 9)


@query("flag_effects", sql.hub(flag_sql(list(labels.FLAG), labels.FLAG, drop_null=True)))
def flag_effects(spark, folder):
    return rounded(d.flag_effects(base.hub(spark, folder)), 9)


@query(
    "ad_effect",
    sql.hub(
        f"""SELECT ad_active, {sql.r('avg(total_sales)', 'total_sales', 9)}, {sql.case_label('ad_active', labels.ADVERT)} AS label
        FROM hub GROUP BY ad_active"""
    ),
)
def ad_effect(spark, folder):
    return rounded(d.ad_effect(base.hub(spark, folder)), 9)


@query(
    "by_holiday",
    sql.daily(
        f"SELECT holiday_name, {sql.r('avg(total_sales)', 'total_sales', 4)} FROM daily WHERE is_holiday = 1 GROUP BY holiday_name"
    ),
)
def by_holiday(spark, folder):
    return rounded(d.by_holiday(base.daily(spark, folder)), 4)


def _pattern(by, table):
    return _grouped_long(by, by, roles.FUEL_TARGETS, "avg", "fuel", "sales", labels.FUEL, table, 9 if table == "hub" else 6)


@query("pattern_by_hour", _pattern("hour", "hub"))
def pattern_by_hour(spark, folder):
    return rounded(d.pattern(base.hub(spark, folder), "hour"), 9)


@query("pattern_by_weekday", _pattern("day_of_week", "hub"))
def pattern_by_weekday(spark, folder):
    return rounded(d.pattern(base.hub(spark, folder), "day_of_week"), 9)


@query("pattern_by_month", _pattern("month", "daily"))
def pattern_by_month(spark, folder):
    return rounded(d.pattern(base.daily(spark, folder), "month"))


_OPTIONS = ["station_name", "month", "season", "road_type", "direction", "settlement_size"]


@query(
    "filter_option_values",
    sql.daily(
        " UNION ALL ".join(
            f"SELECT DISTINCT '{c}' AS option, CAST({c} AS VARCHAR) AS value FROM daily WHERE {c} IS NOT NULL" for c in _OPTIONS
        )
    ),
)
def filter_option_values(spark, folder):
    return d.filter_options(base.daily(spark, folder), _OPTIONS)


@query(
    "distance_bounds",
    sql.merged("SELECT min(distance_to_city_km) AS low, max(distance_to_city_km) AS high FROM merged"),
)
def distance_bounds(spark, folder):
    return d.distance_bounds(base.merged(spark, folder))


@query(
    "price_bounds",
    sql.hourly(
        """SELECT station_id, median(price_AI95) AS median_price, round(median(price_AI95) * (1 - 0.12), 1) AS low,
        round(median(price_AI95) * (1 + 0.12), 1) AS high FROM facts GROUP BY station_id"""
    ),
)
def price_bounds(spark, folder):
    return d.price_bounds(base.hourly(spark, folder), "price_AI95")


@query(
    "station_value_median",
    "SELECT user_id // 30 AS station_id, round(median(value), 6) AS median_value FROM events GROUP BY 1",
)
def station_value_median(spark, folder):
    """Exact median of raw event values per station, however many events one has."""
    from forecourt.operators.quantiles import exact_quantiles
    from forecourt.sources import standins

    events = standins.table(spark, folder, "events")
    values = events.select(standins.station_of("user_id").alias("station_id"), "value")
    out = exact_quantiles(values, ["value"], [0.5], ["station_id"])
    return rounded(out.select("station_id", F.col("value").alias("median_value")))
