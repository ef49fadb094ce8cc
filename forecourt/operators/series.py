"""Operators over the hourly series of each station.

A series can be long, so nothing here sorts a whole station in one task. Ranks and
fills work inside calendar months and carry small per-month totals across; bounded
windows run on fixed runs of hours that overlap by the length of the window.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt import roles
from forecourt.functions.expressions import hours, moment
from forecourt.operators.overview import with_overall

KEY, TS, IDX = "station_id", "timestamp", "time_idx"
RUN_HOURS = 672


def _month(ts: str = TS):
    return F.year(ts) * 12 + F.month(ts)


def hourly_spine(
    df: DataFrame, zero_cols: list[str] = (), key: str = KEY, ts: str = TS, spans=None
) -> DataFrame:
    """Every hour between a station's first and last one.

    Added hours hold zero in ``zero_cols`` and null elsewhere. ``spans`` gives
    (key, first_ts, last_ts) when it is known more cheaply than from ``df``.
    """
    if spans is None:
        spans = df.groupBy(key).agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    spine = spans.select(key, F.explode(F.sequence("first_ts", "last_ts", hours(1))).alias(ts))
    full = spine.join(df, [key, ts], "left")
    return full.withColumns({c: F.coalesce(c, F.lit(0)) for c in zero_cols})


def with_time_idx(df: DataFrame, key: str = KEY, ts: str = TS, out: str = IDX) -> DataFrame:
    """Position of each row in its station's time order, from 0."""
    rows = df.withColumn("_month", _month(ts))
    sizes = rows.groupBy(key, "_month").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(key, "_month", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    rank = F.row_number().over(Window.partitionBy(key, "_month").orderBy(ts))
    out_rows = rows.join(starts, [key, "_month"]).withColumn(out, F.col("_start") + rank - 1)
    return out_rows.drop("_month", "_start")


def gap_report(df: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """Hours present and missing per station."""
    span = F.max(ts) - F.min(ts)
    expected = F.extract(F.lit("DAY"), span) * 24 + F.extract(F.lit("HOUR"), span) + 1
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_hours"),
        expected.cast("long").alias("expected_hours"),
        (expected - F.count(F.lit(1))).cast("long").alias("missing_hours"),
    )


def fill_gaps(df: DataFrame, cols: list[str], key: str = KEY, ts: str = TS) -> DataFrame:
    """Forward fill, then backward fill, per station."""
    rows = df.withColumn("_month", _month(ts))
    ends = rows.groupBy(key, "_month").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ts))).alias(f"_last_{c}") for c in cols],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(ts))).alias(f"_first_{c}") for c in cols],
    )
    months = Window.partitionBy(key).orderBy("_month")
    earlier = months.rowsBetween(Window.unboundedPreceding, -1)
    later = months.rowsBetween(1, Window.unboundedFollowing)
    carried = ends.select(
        key,
        "_month",
        *[F.last(f"_last_{c}", True).over(earlier).alias(f"_prev_{c}") for c in cols],
        *[F.first(f"_first_{c}", True).over(later).alias(f"_next_{c}") for c in cols],
    )
    month = Window.partitionBy(key, "_month").orderBy(ts)
    back = month.rowsBetween(Window.unboundedPreceding, 0)
    ahead = month.rowsBetween(0, Window.unboundedFollowing)
    filled = {
        c: F.coalesce(
            F.last(c, True).over(back),
            F.col(f"_prev_{c}"),
            F.first(c, True).over(ahead),
            F.col(f"_next_{c}"),
        )
        for c in cols
    }
    out = rows.join(carried, [key, "_month"]).withColumns(filled)
    return out.select(*df.columns)


def overlapping_runs(df: DataFrame, before: int, run_hours: int = RUN_HOURS) -> DataFrame:
    """Rows cut into runs of time_idx; each run also gets the ``before`` rows ahead of it.

    Adds ``run`` and ``is_halo``. Windows over (station, run) that look back at most
    ``before`` rows are exact for the rows that are not halo.
    """
    own = F.floor(F.col(IDX) / run_hours)
    last = F.floor((F.col(IDX) + before) / run_hours)
    runs = df.withColumn("_own", own).withColumn("run", F.explode(F.sequence(own, last)))
    return runs.withColumn("is_halo", F.col("run") != F.col("_own")).drop("_own")


def run_window(before: int, after: int = -1):
    return Window.partitionBy(KEY, "run").orderBy(IDX).rowsBetween(-before, after)


def window_index(
    df: DataFrame,
    encoder: int = roles.ENCODER_HOURS,
    min_encoder: int = roles.MIN_ENCODER_HOURS,
    horizon: int = roles.HORIZON_HOURS,
) -> DataFrame:
    """Training samples of gap-free series with ``time_idx``.

    One row per origin, the first predicted hour: how many hours of history it has
    (at most ``encoder``) and how many hours ahead exist (at most ``horizon``).
    """
    length = df.groupBy(KEY).agg((F.max(IDX) + 1).alias("_length"))
    encoder_length = F.least(F.col(IDX), F.lit(encoder)).cast("int")
    ahead = F.least(F.col("_length") - F.col(IDX), F.lit(horizon)).cast("int")
    return (
        df.where(F.col(IDX) >= min_encoder)
        .join(length, KEY)
        .withColumns({"encoder_length": encoder_length, "decoder_length": ahead})
        .drop("_length")
    )


def window_samples(index: DataFrame) -> DataFrame:
    """One row per origin and hour ahead that exists."""
    steps = F.explode(F.sequence(F.lit(1), F.col("decoder_length")))
    return index.withColumn("horizon_h", steps)


def encoder_stats(df: DataFrame, cols: list[str], encoder: int = roles.ENCODER_HOURS) -> DataFrame:
    """Count, mean and last value over the history of each row."""
    w = run_window(encoder)
    runs = overlapping_runs(df, encoder)
    stats = {"encoder_length": F.count(F.lit(1)).over(w).cast("int")}
    for c in cols:
        stats[f"{c}_mean"] = F.avg(c).over(w)
        stats[f"{c}_last"] = F.last(c).over(w)
    return runs.withColumns(stats).where(~F.col("is_halo")).drop("run", "is_halo")


def encoder_rows(df: DataFrame, origins: DataFrame, encoder: int = roles.ENCODER_HOURS) -> DataFrame:
    """History rows of each origin: an equi-join on blocks of ``encoder`` hours, where a row also stands in the block after its own.

    So each side is shuffled once or twice instead of once per lag. Spark takes exploded rows for as small as those
    before, hence the hint: neither side may be sent whole through the driver.
    """
    block = F.floor(F.col(IDX) / encoder)
    wanted = origins.select(KEY, F.col(IDX).alias("origin_idx"), block.alias("_block"))
    near = df.where(F.col(IDX) >= 0).withColumn("_block", F.explode(F.array(block, block + 1)))
    lag = F.col("origin_idx") - F.col(IDX)
    rows = wanted.join(near.hint("merge"), [KEY, "_block"]).where(lag.between(1, encoder))
    rest = [c for c in df.columns if c not in (KEY, IDX)]
    return rows.select(KEY, IDX, "origin_idx", lag.cast("int").alias("lag_h"), *rest)


def encoder_arrays(df: DataFrame, cols: list[str], encoder: int = roles.ENCODER_HOURS) -> DataFrame:
    """History of each row as an array of structs, oldest first."""
    history = F.collect_list(F.struct(IDX, *cols)).over(run_window(encoder))
    runs = overlapping_runs(df, encoder).withColumn("history", history)
    return runs.where(~F.col("is_halo")).drop("run", "is_halo")


def relative_time(samples: DataFrame) -> DataFrame:
    """Relative time index and scaled encoder length of each sample row."""
    return samples.withColumns(
        {
            "relative_time_idx": (F.col("horizon_h") - 1) / F.col("encoder_length"),
            "encoder_length_scaled": (
                F.col("encoder_length") - roles.ENCODER_HOURS / 2
            )
            / F.lit(roles.ENCODER_HOURS / 2),
        }
    )


def split_of(ts, train_end: str = roles.TRAIN_END, val_end: str = roles.VAL_END):
    """Name of the calendar split a timestamp falls in."""
    return (
        F.when(F.col(ts) <= moment(train_end), "train")
        .when(F.col(ts) <= moment(val_end), "val")
        .otherwise("test")
    )


def split_report(df: DataFrame) -> DataFrame:
    """Rows, period, share and number of sample windows of each split."""
    enough = F.col(IDX) >= roles.MIN_ENCODER_HOURS
    splits = df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(TS).alias("first_ts"),
        F.max(TS).alias("last_ts"),
        F.count(F.when(enough, 1)).alias("n_windows"),
    )
    out = with_overall(splits, _total=F.sum("n_rows"))
    return out.withColumn("share_pct", F.col("n_rows") * 100 / F.col("_total")).drop("_total")


def shortest_horizon(pred: DataFrame, keys: tuple = (KEY, TS)) -> DataFrame:
    """The forecast made closest to each hour; partial results merge before the shuffle. One forecast per hour and horizon."""
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    rest = [f for f in pred.schema if f.name not in keys and f.name != "horizon_h"]
    least = F.min("horizon_h").alias("horizon_h")
    if all(isinstance(f.dataType, fixed) for f in rest):
        # Values of fixed width stay in the buffers of a hash aggregate.
        best = [F.min_by(f.name, "horizon_h").alias(f.name) for f in rest]
        return pred.groupBy(*keys).agg(least, *best).select(pred.columns)
    return pred.join(pred.groupBy(*keys).agg(least), [*keys, "horizon_h"]).select(pred.columns)


def tail_per_station(df: DataFrame, n: int = roles.ENCODER_HOURS, before: str | None = None) -> DataFrame:
    """Last n rows of each station before a time; tasks keep only n rows per station to shuffle."""
    if before is not None:
        df = df.where(F.col(TS) < moment(before))
    rank = F.row_number().over(Window.partitionBy(KEY).orderBy(F.col(TS).desc()))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def last_row(df: DataFrame, before: str | None = None) -> DataFrame:
    """Last row of each station before a time."""
    if before is not None:
        df = df.where(F.col(TS) < moment(before))
    return df.join(df.groupBy(KEY).agg(F.max(TS).alias(TS)), [KEY, TS], "left_semi")


def lagged(df: DataFrame, cols: list[str], lags: tuple = (24, 168)) -> DataFrame:
    """Columns of earlier hours, joined on (station, time_idx).

    Both sides hold every hour. Spark may take them for as small as the spans they were exploded from, or as their
    packed files; the hint keeps it from sending one whole through the driver.
    """
    for lag in lags:
        past = df.select(
            KEY, (F.col(IDX) + lag).alias(IDX), *[F.col(c).alias(f"{c}_lag{lag}") for c in cols]
        )
        df = df.join(past.hint("merge"), [KEY, IDX], "left")
    return df
