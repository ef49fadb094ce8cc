"""What-if frames and the summaries of their forecasts.

Conditions are in raw units and act on raw columns; scale afterwards if a model needs it.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import roles
from forecourt.functions.calendar import shop_open, with_calendar, with_calendar_flags
from forecourt.functions.expressions import change_pct, hours, moment
from forecourt.operators.features import present, unlog
from forecourt.operators.joins import (
    apply_conditions,
    first_by_month,
    holiday_calendar,
    preset_table,
    with_holiday,
    with_preset,
    with_season_code,
)
from forecourt.operators.series import KEY
from forecourt.plans.forecast import NAMES

CALENDAR = ["hour", "day_of_week", "week_of_year", "month", "day", "date"]
FLAGS = ["is_weekend", "is_rush_hour", "is_night", "is_shop_open", "is_holiday", "holiday_name", "season"]


def future_frame(df: DataFrame, start: str, n_hours: int = roles.HORIZON_HOURS) -> DataFrame:
    """Hours from start on for every station.

    Calendar columns are computed, season and holiday are looked up in the history, and
    all other columns repeat the last known row of the same hour. Targets are zero.
    """
    past = df.where(F.col("timestamp") < moment(start))
    own = set(CALENDAR + FLAGS + ["timestamp", KEY, "time_idx", *roles.TARGETS])
    rest = [c for c in df.columns if c not in own]
    seasonal = "season" in df.columns
    if seasonal:
        past = past.withColumn("_season", F.col("season"))
        rest = [*rest, "_season"]
    own_hour = F.hour("timestamp").alias("hour")
    latest = past.groupBy(KEY, own_hour).agg(F.max("timestamp").alias("timestamp"))
    template = past.select(KEY, "timestamp", own_hour, *rest).join(latest, [KEY, "timestamp", "hour"], "left_semi").drop("timestamp")
    last = past.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n"))
    first = moment(start)
    steps = F.sequence(first, first + hours(n_hours - 1), hours(1))
    frame = last.select(KEY, "_n", F.posexplode(steps).alias("_h", "timestamp"))
    frame = frame.withColumn("time_idx", F.col("_n") + F.col("_h"))
    frame = frame.withColumn("day", F.floor(F.col("_h") / 24).cast("int")).drop("_n", "_h")
    dated = with_calendar(frame.withColumnRenamed("day", "_day")).drop("day", "date")
    dated = with_calendar_flags(dated.withColumnRenamed("_day", "day"))
    dated = dated.withColumn("is_shop_open", shop_open(F.col("hour")))
    dated = with_holiday(dated, holiday_calendar(df))
    if seasonal:
        dated = with_season_code(dated, first_by_month(df, "season"))
    out = dated.join(template, [KEY, "hour"], "left")
    if seasonal:
        out = out.withColumn("season", F.coalesce("season", "_season")).drop("_season")
    return out.withColumns({t: F.lit(0.0) for t in present(df, roles.TARGETS)})


def apply_scenario(frame: DataFrame, conditions: DataFrame, presets: DataFrame | None = None) -> DataFrame:
    """The frame once per scenario with weather, traffic, promotions, adverts and prices set.

    Traffic is a percentage of the frame's own value, so it never compounds over days.
    ``price_pct`` is optional and scales the own fuel prices.
    """
    presets = preset_table(frame.sparkSession) if presets is None else presets
    rows = with_preset(apply_conditions(frame, conditions), presets)
    factor = F.col("traffic_pct") / 100
    traffic = present(frame, roles.TRAFFIC + ["total_traffic"])
    columns = {c: F.col(c) * factor for c in traffic}
    columns |= {
        "promotion_fuel_active": F.col("promo_fuel"),
        "promotion_shop_active": F.col("promo_shop"),
        "ad_active": F.col("_ad"),
    }
    if "price_pct" in conditions.columns:
        columns |= {p: F.col(p) * F.col("price_pct") / 100 for p in present(frame, roles.PRICES)}
    return rows.withColumns(columns).drop("_ad")


def natural_units(forecast: DataFrame) -> DataFrame:
    """p10, p50 and p90 out of log forecasts."""
    pick = {"p10": unlog(F.col("q10")), "p50": unlog(F.col("q50")), "p90": unlog(F.col("q90"))}
    return forecast.withColumns(pick).drop(*NAMES)


def scenario_summary(result: DataFrame, keys: tuple = ("scenario_id", KEY, "target")) -> DataFrame:
    """Mean median, peak and time of the peak; the earliest hour on ties."""
    peak = F.min_by("timestamp", F.struct(-F.col("p50"), "timestamp"))
    return result.groupBy(*keys).agg(
        F.avg("p50").alias("mean_p50"), F.max("p50").alias("peak_p50"), peak.alias("peak_ts")
    )


def scenario_days(result: DataFrame, keys: tuple = ("scenario_id", KEY, "target")) -> DataFrame:
    """Daily means of the band and the daily peak; days count from 1."""
    out = result.groupBy(*keys, "day").agg(
        F.date_format(F.min("timestamp"), "dd.MM").alias("date"),
        F.avg("p10").alias("p10"),
        F.avg("p50").alias("p50"),
        F.avg("p90").alias("p90"),
        F.max("p50").alias("peak"),
    )
    return out.withColumn("day", F.col("day") + 1)


def scenario_delta(result: DataFrame, base: DataFrame) -> DataFrame:
    """Scenario against base run, per scenario, station and target, in percent."""
    keys = [KEY, "timestamp", "target"]
    usual = base.select(*keys, F.col("p50").alias("base_p50"))
    both = result.join(usual, keys)
    out = both.groupBy("scenario_id", KEY, "target").agg(
        F.avg("p50").alias("mean_p50"), F.avg("base_p50").alias("base_p50")
    )
    return out.withColumn("delta_pct", change_pct("mean_p50", "base_p50"))


def stimuli(conditions: DataFrame) -> DataFrame:
    """Which stimuli a scenario uses on any day."""
    return conditions.groupBy("scenario_id").agg(
        F.max("promo_fuel").alias("any_promo_fuel"),
        F.max("promo_shop").alias("any_promo_shop"),
        F.max("ad_active").alias("any_ad"),
    )

