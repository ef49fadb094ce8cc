"""Schemas of the input and result tables."""

from pyspark.sql import types as T

from forecourt import roles


def _fields(names, kind):
    return [T.StructField(n, kind) for n in names]


PASSPORT = T.StructType(
    [T.StructField("station_id", T.LongType()), T.StructField("station_name", T.StringType())]
    + _fields(roles.STATIC_CATEGORIES, T.StringType())
    + _fields(["distance_to_city_km"], T.DoubleType())
    + _fields(roles.PUMPS + ["total_pumps", "shop_area_m2"], T.IntegerType())
    + _fields(roles.SERVICES + ["competitors_within_5km"], T.IntegerType())
    + _fields(roles.BASE_PRICES, T.DoubleType())
    + _fields(
        [
            "customer_loyalty_score",
            "staff_quality_score",
            "corporate_customer_ratio",
            "staff_engagement_score",
        ],
        T.DoubleType(),
    )
)

FACTS = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("station_id", T.LongType()),
        T.StructField("station_name", T.StringType()),
    ]
    + _fields(roles.STATIC_CATEGORIES, T.StringType())
    + _fields(["distance_to_city_km"], T.DoubleType())
    + _fields(["total_pumps", "shop_area_m2"], T.IntegerType())
    + _fields(["has_car_wash", "has_cafe", "has_shop", "competitors_within_5km"], T.IntegerType())
    + _fields(
        ["corporate_customer_ratio", "staff_engagement_score", "customer_loyalty_score"],
        T.DoubleType(),
    )
    + _fields(["temperature"], T.DoubleType())
    + _fields(["weather_condition"], T.StringType())
    + _fields(["precipitation_mm", "visibility_km", "wind_speed_ms"], T.DoubleType())
    + _fields(roles.WEATHER_FLAGS, T.IntegerType())
    + _fields(roles.TRAFFIC + ["total_traffic"], T.LongType())
    + _fields(roles.FUEL_TARGETS + ["total_fuel_sales"], T.DoubleType())
    + _fields(list(roles.SOURCE_RENAMES) + ["shop_total_revenue"], T.DoubleType())
    + _fields(roles.PROMOTIONS + ["ad_active"], T.IntegerType())
    + _fields(["ad_channel"], T.StringType())
    + _fields(roles.RIVAL_PRICES + roles.PRICES, T.DoubleType())
    + _fields(["hour", "day_of_week", "week_of_year", "month", "quarter"], T.IntegerType())
    + _fields(["season"], T.StringType())
    + _fields(["is_weekend", "is_holiday"], T.IntegerType())
    + _fields(["holiday_name"], T.StringType())
    + _fields(["is_rush_hour", "is_night"], T.IntegerType())
    + _fields(["day_name"], T.StringType())
)

SCALERS = T.StructType(
    [
        T.StructField("station_id", T.LongType()),
        T.StructField("column", T.StringType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("std", T.DoubleType()),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("station_id", T.LongType()),
        T.StructField("target", T.StringType()),
        T.StructField("MAE", T.DoubleType()),
        T.StructField("RMSE", T.DoubleType()),
        T.StructField("MAPE_%", T.DoubleType()),
        T.StructField("n", T.LongType()),
    ]
)

CONDITIONS = T.StructType(
    [
        T.StructField("scenario_id", T.LongType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("weather", T.StringType()),
        T.StructField("traffic_pct", T.IntegerType()),
        T.StructField("promo_fuel", T.IntegerType()),
        T.StructField("promo_shop", T.IntegerType()),
        T.StructField("ad_active", T.IntegerType()),
    ]
)

SCALARS = T.StructType(
    [
        T.StructField("run", T.LongType()),
        T.StructField("tag", T.StringType()),
        T.StructField("step", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("wall_time", T.DoubleType()),
    ]
)
