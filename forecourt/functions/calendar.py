"""Calendar columns of a timestamp."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import roles


def with_calendar(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Hour, Monday-first weekday, ISO week, month, day and date."""
    t = F.col(ts)
    return df.withColumns(
        {
            "hour": F.hour(t),
            "day_of_week": F.weekday(t),
            "week_of_year": F.weekofyear(t),
            "month": F.month(t),
            "day": F.dayofmonth(t),
            "date": F.to_date(t),
        }
    )


def shop_open(hour, lo: int = roles.SHOP_HOURS[0], hi: int = roles.SHOP_HOURS[1]):
    return hour.between(lo, hi).cast("int")


def with_shop_open(
    df: DataFrame, lo: int = roles.SHOP_HOURS[0], hi: int = roles.SHOP_HOURS[1]
) -> DataFrame:
    return df.withColumn("is_shop_open", shop_open(F.col("hour"), lo, hi))


def with_calendar_flags(df: DataFrame) -> DataFrame:
    """Weekend, rush hour and night, from ``hour`` and ``day_of_week``."""
    h = F.col("hour")
    return df.withColumns(
        {
            "is_weekend": (F.col("day_of_week") >= 5).cast("int"),
            "is_rush_hour": h.isin(roles.RUSH_HOURS).cast("int"),
            "is_night": ((h < 6) | (h >= 22)).cast("int"),
        }
    )


def season_of(month):
    return (
        F.when(month.isin(12, 1, 2), "winter")
        .when(month.isin(3, 4, 5), "spring")
        .when(month.isin(6, 7, 8), "summer")
        .otherwise("autumn")
    )


def with_season(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Season, quarter and English day name."""
    t = F.col(ts)
    return df.withColumns(
        {
            "season": season_of(F.month(t)),
            "quarter": F.quarter(t),
            "day_name": F.date_format(t, "EEEE"),
        }
    )
