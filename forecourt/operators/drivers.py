"""What moves sales: weather, promotion, advertising and calendar effects."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import roles
from forecourt.functions import labels
from forecourt.operators.features import present, to_long
from forecourt.operators.overview import flag_means, group, group_long, with_overall


def by_weather(df: DataFrame) -> DataFrame:
    return group(df, ["weather_condition"], ["total_sales"]).orderBy("total_sales", "weather_condition")


def weather_flag_effect(df: DataFrame) -> DataFrame:
    out = flag_means(df, present(df, ["is_rain", "is_snow", "is_fog"]))
    return labels.with_label(out, "flag", labels.WEATHER_FLAG)


def by_ad_channel(df: DataFrame, none: str = roles.NO_ADVERT) -> DataFrame:
    """Mean by channel, best first, beside the mean of hours without advertising (0 if none)."""
    means = group(df, ["ad_channel"], ["total_sales"])
    quiet = F.max(F.when(F.col("ad_channel") == none, F.col("total_sales")))
    out = with_overall(means, no_ad_sales=F.coalesce(quiet, F.lit(0.0)))
    return out.orderBy(F.desc("total_sales"), "ad_channel")


def shop_by_ad_channel(df: DataFrame) -> DataFrame:
    out = group(df, ["ad_channel"], ["shop_total_revenue"])
    return out.orderBy(F.desc("shop_total_revenue"), "ad_channel")


def promo_by_fuel(df: DataFrame, promo: str, fuels: list[str] = roles.FUEL_TARGETS) -> DataFrame:
    cols = present(df, fuels)
    key = F.col(promo).alias("active")
    return labels.with_label(group_long(df, [key], ["active"], cols, "fuel", "sales"), "fuel", labels.FUEL)


def promo_by_shop(df: DataFrame, promo: str, shops: list[str] = roles.SHOP_TARGETS) -> DataFrame:
    cols = present(df, shops)
    key = F.col(promo).alias("active")
    out = group_long(df, [key], ["active"], cols, "category", "revenue")
    return labels.with_label(out, "category", labels.SHOP)


def flag_effects(df: DataFrame) -> DataFrame:
    """Means by holiday, rush hour and weekend flag."""
    out = flag_means(df, list(labels.FLAG)).where(F.col("mean_sales").isNotNull())
    text = F.lit(None).cast("string")
    for flag, names in labels.FLAG.items():
        text = F.when(F.col("flag") == flag, labels.label(F.col("active"), names)).otherwise(text)
    return out.withColumn("label", text)


def ad_effect(df: DataFrame) -> DataFrame:
    out = group(df, ["ad_active"], ["total_sales"])
    return labels.with_label(out, "ad_active", labels.ADVERT)


def by_holiday(df: DataFrame) -> DataFrame:
    days = df.where(F.col("is_holiday") == 1)
    return group(days, ["holiday_name"], ["total_sales"]).orderBy("total_sales", "holiday_name")


def pattern(df: DataFrame, by: str, fuels: list[str] = roles.FUEL_TARGETS) -> DataFrame:
    """Mean of each fuel by hour, day_of_week or month."""
    cols = present(df, fuels)
    return labels.with_label(group_long(df, [by], [by], cols, "fuel", "sales"), "fuel", labels.FUEL)


def filter_options(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct values of each filter column; values merge inside tasks first."""
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("option"), F.col(c).cast("string").alias("value")) for c in cols])
    )
    values = df.select(cells.alias("cell")).select("cell.*").where(F.col("value").isNotNull())
    return values.distinct().orderBy("option", "value")


def distance_bounds(df: DataFrame, column: str = "distance_to_city_km") -> DataFrame:
    return df.agg(
        F.min(column).cast("double").alias("low"), F.max(column).cast("double").alias("high")
    )


def price_bounds(df: DataFrame, price: str, spread: float = 0.12) -> DataFrame:
    """Median price of each station and the range a scenario may set.

    A station has one row per hour, which bounds the values an exact median keeps.
    """
    median = df.groupBy("station_id").agg(F.percentile(price, 0.5).alias("median_price"))
    return median.withColumns(
        {
            "low": F.round(F.col("median_price") * (1 - spread), 1),
            "high": F.round(F.col("median_price") * (1 + spread), 1),
        }
    )
