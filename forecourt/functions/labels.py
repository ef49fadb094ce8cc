"""Display labels for codes: short English texts, made from the code where that reads well."""

import calendar

from pyspark.sql import Column
from pyspark.sql import functions as F

from forecourt import roles


def _words(code: str, prefix: str) -> str:
    return code.removeprefix(prefix).replace("_", " ").capitalize()


FUEL = {t: t.removeprefix("sales_").replace("_", " ") for t in roles.FUEL_TARGETS}
SHOP = {t: _words(t, "shop_") for t in roles.SHOP_TARGETS}
MONTH = {m: calendar.month_name[m] for m in range(1, 13)}
MONTH_SHORT = {m: calendar.month_abbr[m] for m in range(1, 13)}
WEEKDAY = {d: calendar.day_abbr[d] for d in range(7)}
SEASON = {s: s.capitalize() for s in ("winter", "spring", "summer", "autumn")}
SCORE = {
    "customer_loyalty_score": "Loyal customers",
    "staff_quality_score": "Service quality",
    "staff_engagement_score": "Staff commitment",
    "corporate_customer_ratio": "Share of companies",
}
FLAG = {
    "is_holiday": {0: "no holiday", 1: "holiday"},
    "is_rush_hour": {0: "off-peak", 1: "rush hour"},
    "is_weekend": {0: "Mon-Fri", 1: "Sat-Sun"},
}
PROMOTION = {p: _words(p.removesuffix("_active"), "promotion_") + " promotion" for p in roles.PROMOTIONS}
WEATHER_FLAG = {f: _words(f, "is_") for f in ("is_rain", "is_snow", "is_fog")}
ADVERT = {0: "not advertised", 1: "advertised"}


def label(code: Column, mapping: dict) -> Column:
    """The label of ``code``; a code without a label stays as it is."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[code], code.cast("string"))


def with_label(df, col: str, mapping: dict, out: str = "label"):
    return df.withColumn(out, label(F.col(col), mapping))
