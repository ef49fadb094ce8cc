"""Accuracy of forecasts against actual values. Tables are long: one row per target."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import roles
from forecourt.operators.quantiles import exact_quantiles

MIN_ACTUAL = 0.01


def _complete(pred: DataFrame) -> DataFrame:
    return pred.where(F.col("pred").isNotNull() & F.col("actual").isNotNull())


def accuracy(pred: DataFrame, keys: tuple = ("station_id", "target"), digits: tuple = (3, 3, 2)) -> DataFrame:
    """MAE, RMSE, MAPE and n; MAPE counts actual values above 0.01 only."""
    miss = F.abs(F.col("pred") - F.col("actual"))
    relative = F.when(F.col("actual") > MIN_ACTUAL, miss / F.col("actual"))
    a, b, c = digits
    return _complete(pred).groupBy(*keys).agg(
        F.round(F.avg(miss), a).alias("MAE"),
        F.round(F.sqrt(F.avg(miss * miss)), b).alias("RMSE"),
        F.round(F.avg(relative) * 100, c).alias("MAPE_%"),
        F.count(F.lit(1)).alias("n"),
    )


def accuracy_summary(metrics: DataFrame) -> DataFrame:
    """Mean metrics per target over the stations, unknown MAPE first."""
    out = metrics.groupBy("target").agg(
        *[F.avg(c).alias(c) for c in ("MAE", "RMSE", "MAPE_%")]
    )
    return out.orderBy(F.asc_nulls_first("MAPE_%"), "target")


def r2(pred: DataFrame, keys: tuple = ("target",)) -> DataFrame:
    """R2 per target; needs more than one row and spread in the actual values."""
    miss = F.col("pred") - F.col("actual")
    n = F.count(F.lit(1))
    total = F.var_pop("actual") * n
    value = F.when((n > 1) & (total > 0), F.lit(1.0) - F.try_divide(F.sum(miss * miss), total))
    return _complete(pred).groupBy(*keys).agg(value.alias("r2"))


def accuracy_kpis(pred: DataFrame, metrics: DataFrame, good: float = 15.0) -> DataFrame:
    """Targets, median MAPE, median R2, and how many series reach a good MAPE."""
    mape = exact_quantiles(metrics, ["MAPE_%"], [0.5]).agg(F.max("value")).scalar()
    # One row per target, at most as many as there are target columns.
    fit = r2(pred).agg(F.percentile("r2", 0.5)).scalar()
    return metrics.agg(
        F.count_distinct("target").alias("n_targets"),
        F.count(F.lit(1)).alias("n_series"),
        F.count(F.when(F.col("MAPE_%") <= good, 1)).alias("n_good"),
    ).withColumns({"median_mape": mape, "median_r2": fit})


def band(value, good: float = 10.0, fair: float = 20.0):
    """good, fair or poor; null stays null."""
    return F.when(value <= good, "good").when(value <= fair, "fair").when(value.isNotNull(), "poor")


def mape_bands(metrics: DataFrame) -> DataFrame:
    out = metrics.groupBy("station_id", "target").agg(F.avg("MAPE_%").alias("mape"))
    return out.withColumn("band", band(F.col("mape")))


def mape_matrix(metrics: DataFrame, targets: list[str] = roles.TARGETS) -> DataFrame:
    """MAPE with a row per station and a column per target."""
    return metrics.groupBy("station_id").pivot("target", targets).agg(F.avg("MAPE_%"))


def prediction_band(pred: DataFrame, target: str) -> DataFrame:
    """Actual, median and the 10 to 90 % band of one target in time order."""
    rows = pred.where(F.col("target") == target)
    return rows.select("station_id", "timestamp", "actual", "pred", "q10", "q90").orderBy(
        "timestamp", "station_id"
    )


def ideal_line(pred: DataFrame) -> DataFrame:
    """Ends of the pred = actual line per target."""
    return _complete(pred).groupBy("target").agg(
        F.least(F.min("pred"), F.min("actual")).alias("low"),
        F.greatest(F.max("pred"), F.max("actual")).alias("high"),
    )


def pinball(pred: DataFrame, names: list[str] = roles.QUANTILE_NAMES, levels: list[float] = roles.QUANTILES) -> DataFrame:
    """Mean quantile loss per target and level."""
    rows = pred.where(F.col("actual").isNotNull())
    cells = []
    for name, p in zip(names, levels, strict=True):
        gap = F.col("actual") - F.col(name)
        loss = F.avg(F.greatest(gap * p, gap * (p - 1)))
        cells.append(F.struct(F.lit(p).alias("level"), loss.alias("loss")))
    return rows.groupBy("target").agg(F.array(*cells).alias("a")).select("target", F.inline("a"))

