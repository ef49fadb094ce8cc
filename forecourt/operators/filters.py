"""Row filters. An empty choice keeps all rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import roles
from forecourt.functions.expressions import hours, moment
from forecourt.operators.series import split_of


def _any(conditions):
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def _zero(*cols):
    out = F.lit(True)
    for c in cols:
        out = out & (F.col(c) == 0)
    return out


# Predicates of the multiple choice filters.
DAY_TYPES = {
    "workday": lambda: F.col("is_weekend") == 0,
    "weekend": lambda: F.col("is_weekend") == 1,
    "holiday": lambda: F.col("is_holiday") == 1,
}
WEATHER = {
    "clear": lambda: _zero("is_rain", "is_snow", "is_fog"),
    "rain": lambda: F.col("is_rain") == 1,
    "snow": lambda: F.col("is_snow") == 1,
    "fog": lambda: F.col("is_fog") == 1,
}
PROMOTIONS = {
    "fuel": lambda: F.col("promotion_fuel_active") == 1,
    "shop": lambda: F.col("promotion_shop_active") == 1,
    "cafe": lambda: F.col("promotion_cafe_active") == 1,
    "none": lambda: _zero(*roles.PROMOTIONS),
}


def filter_hub(df: DataFrame, stations: list = (), months: list = ()) -> DataFrame:
    if stations:
        df = df.where(F.col("station_name").isin(list(stations)))
    if months:
        df = df.where(F.col("month").isin(list(months)))
    return df


def filter_analysis(
    df: DataFrame,
    season: list = (),
    day_type: list = (),
    weather: list = (),
    promo: list = (),
    holiday: str = "all",
    distance: tuple | None = None,
    road: list = (),
    direction: list = (),
    settlement: list = (),
) -> DataFrame:
    """Conjunction of the chosen filters; inside one filter the choices are alternatives."""
    if season:
        df = df.where(F.col("season").isin(list(season)))
    for chosen, known in ((day_type, DAY_TYPES), (weather, WEATHER), (promo, PROMOTIONS)):
        if chosen:
            df = df.where(_any(known[c]() for c in chosen))
    if holiday == "only":
        df = df.where(F.col("is_holiday") == 1)
    elif holiday == "without":
        df = df.where(F.col("is_holiday") == 0)
    if distance is not None:
        df = df.where(F.col("distance_to_city_km").between(*distance))
    for chosen, name in ((road, "road_type"), (direction, "direction"), (settlement, "settlement_size")):
        if chosen:
            df = df.where(F.col(name).isin(list(chosen)))
    return df


def filter_or_fallback(filtered: DataFrame, fallback: DataFrame) -> DataFrame:
    """The filtered rows, or all fallback rows when the filter leaves none."""
    return fallback if filtered.isEmpty() else filtered


def in_split(
    df: DataFrame, split: str, train_end: str = roles.TRAIN_END, val_end: str = roles.VAL_END
) -> DataFrame:
    return df.where(split_of("timestamp", train_end, val_end) == split)


def context_slice(
    df: DataFrame, start: str, end: str, station=None, context: int = roles.ENCODER_HOURS
) -> DataFrame:
    """Rows from ``context`` hours before start up to end, of one or all stations."""
    first = moment(start) - hours(context)
    out = df.where((F.col("timestamp") >= first) & (F.col("timestamp") <= moment(end)))
    return out if station is None else out.where(F.col("station_id") == station)


def complete(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols)


def known_targets(metrics: DataFrame, available: DataFrame) -> DataFrame:
    """Metric rows of the targets that a prediction table holds."""
    return metrics.join(available.select("target"), "target", "left_semi")
