"""Which variables and which past hours carry information."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import roles
from forecourt.functions.expressions import correlation
from forecourt.operators.filters import context_slice
from forecourt.operators.overview import with_overall
from forecourt.operators.series import IDX, KEY, overlapping_runs, run_window


def importance(strengths: DataFrame, k: int = 20) -> DataFrame:
    """Share of each factor's strength in the total, the k largest, and what they cover.

    ``strengths`` has one row per factor: (factor, strength).
    """
    known = with_overall(strengths.select("factor", "strength"), _total=F.sum(F.abs("strength")))
    share = F.try_divide(F.abs("strength") * 100, "_total").alias("share_pct")
    best = known.select("factor", share).orderBy(F.desc_nulls_last("share_pct"), "factor").limit(k)
    return with_overall(best, covered_pct=F.sum("share_pct"))


def lag_profile(
    df: DataFrame, target: str, max_lag: int = roles.ENCODER_HOURS, by: tuple = (KEY,)
) -> DataFrame:
    """Autocorrelation of the target at lags of 1 to ``max_lag`` hours, with its share.

    Each hour meets its own last hours inside an overlapping run; the products merge per
    lag before anything is shuffled again.
    """
    rows = df.select(*dict.fromkeys([KEY, IDX, *by]), F.col(target).cast("double").alias("y"))
    past = F.collect_list(F.struct("y")).over(run_window(max_lag))
    runs = overlapping_runs(rows, max_lag).withColumn("past", past).where(~F.col("is_halo"))
    pairs = runs.select(*by, "y", F.posexplode(F.reverse("past")).alias("_pos", "_p"))
    pairs = pairs.select(*by, (F.col("_pos") + 1).alias("lag_h"), "y", F.col("_p.y").alias("x"))
    out = pairs.groupBy(*by, "lag_h").agg(correlation("x", "y").alias("r"))
    sums = out.groupBy(*by).agg(F.sum(F.abs("r")).alias("_sum"))
    joined = out.join(sums, list(by)) if by else out.withColumn("_sum", sums.scalar())
    share = F.try_divide(F.abs("r") * 100, F.col("_sum"))
    return joined.withColumn("share_pct", share).drop("_sum")


def lag_verdict(profile: DataFrame, by: tuple = (KEY,)) -> DataFrame:
    """Top three lags and whether the strongest one is daily or weekly.

    A profile has at most 168 rows per group.
    """
    lags = F.array_sort(
        F.collect_list(
            F.when(F.col("share_pct").isNotNull(), F.struct((-F.col("share_pct")).alias("s"), "lag_h"))
        )
    )
    out = profile.groupBy(*by).agg(F.slice(lags, 1, 3).alias("_t"))
    top = F.col("_t")[0]["lag_h"]
    verdict = (
        F.when(F.abs(top - 24) <= 3, "daily").when(F.abs(top - 168) <= 6, "weekly").otherwise("other")
    )
    names = {f"lag_{i + 1}": F.get("_t", F.lit(i))["lag_h"] for i in range(3)}
    return out.where(F.size("_t") > 0).withColumns(names).withColumn("verdict", verdict).drop("_t")


def period_slice(df: DataFrame, period: str, station=None, periods: dict = roles.PERIODS) -> DataFrame:
    """Rows of an interpretation period with the hours of context before it."""
    start, end = periods[period]
    return context_slice(df, f"{start} 00:00:00", f"{end} 23:00:00", station)
