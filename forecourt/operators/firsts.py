"""First known values by key: one hash aggregate of a packed order, and an equi-join back to the rows that hold them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.expressions import hours_between, moment

_EPOCH = "1970-01-01 00:00:00"


def packed(ts: str = "timestamp", tie: str | None = "station_id") -> Column:
    """Time and a whole, non-negative tie breaker as one number that sorts like both: microseconds, then nineteen digits."""
    gap = F.col(ts) - moment(_EPOCH)
    seconds = hours_between(moment(_EPOCH), F.col(ts)) * 3600 + F.extract(F.lit("MINUTE"), gap) * 60
    micros = seconds.cast("decimal(20,0)") * 1_000_000 + (F.extract(F.lit("SECOND"), gap) * 1_000_000).cast("decimal(20,0)")
    return (micros.cast("decimal(18,0)") * F.lit("1" + "0" * 19).cast("decimal(20,0)") + (F.lit(0) if tie is None else F.col(tie)).cast("decimal(19,0)")).cast("decimal(38,0)")


def first_known(df: DataFrame, keys: list[str], columns: list[str], ts: str = "timestamp", tie: str | None = "station_id") -> DataFrame:
    """``keys`` with the first value of each column that is not null, in the order of ``ts``, then ``tie``.

    ``ts`` and ``tie`` name a row; of rows that share both, the largest value counts. The aggregate keeps a number per key and column; the rows that hold a first value are
    few, at most one for each key and column, and only they are read for it.
    """
    rows = df.select(*keys, *columns, packed(ts, tie).alias("_at"))
    firsts = rows.groupBy(*keys).agg(*[F.min(F.when(F.col(c).isNotNull(), F.col("_at"))).alias(f"_{k}") for k, c in enumerate(columns)])
    wanted = firsts.select(*keys, F.explode(F.array_distinct(F.array(*[f"_{k}" for k in range(len(columns))]))).alias("_at"))
    held = rows.join(wanted.where("_at IS NOT NULL"), [*keys, "_at"]).join(firsts, keys)
    values = [F.max(F.when(F.col("_at") == F.col(f"_{k}"), F.col(c))).alias(c) for k, c in enumerate(columns)]
    return firsts.select(*keys).join(held.groupBy(*keys).agg(*values), keys, "left")
