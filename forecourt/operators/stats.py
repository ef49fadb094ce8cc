"""Correlation, trend and distribution statistics."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt import roles
from forecourt.functions.expressions import correlation, sample_skewness
from forecourt.operators.features import numeric_columns, present, to_long
from forecourt.operators.overview import STATION
from forecourt.operators.quantiles import exact_quantiles


def column_means(df: DataFrame, cols: list[str]) -> Column:
    """A struct of the means of columns, computed once per plan."""
    return df.agg(F.struct(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols])).scalar()


def pair_moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """Counts, sums and products of every column pair over rows where both are present.

    Each task multiplies Arrow batches as matrices and emits one row per pair; Spark adds
    the rows of the tasks up. Columns are shifted by their mean first, which keeps the
    sums small enough to subtract.
    """
    shifted = df.select(column_means(df, cols).alias("_m"), *[F.col(c).cast("double").alias(c) for c in cols]).select(
        *[(F.col(c) - F.col(f"_m.{c}")).alias(c) for c in cols]
    )
    width = len(cols)

    def multiply(batches):
        import numpy as np
        import pyarrow as pa

        sums = np.zeros((5, width, width))
        for batch in batches:
            x = np.column_stack(
                [c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]
            )
            there = ~np.isnan(x)
            x = np.where(there, x, 0.0)
            m = there.astype(float)
            sums += np.stack([m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, x.T @ x])
        i, j = np.divmod(np.arange(width * width), width)
        n, sx, sy, sxx, sxy = (s.ravel() for s in sums)
        syy = sums[3].T.ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype("int32")), pa.array(j.astype("int32"))]
            + [pa.array(v) for v in (n, sx, sy, sxx, syy, sxy)],
            names=["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"],
        )

    schema = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"
    parts = shifted.mapInArrow(multiply, schema)
    return parts.groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]
    )


def corr_matrix(df: DataFrame, cols: list[str], digits: int | None = 2) -> DataFrame:
    """Pairwise-complete Pearson matrix as (row_name, col_name, r) rows.

    A column counts as constant if its spread is rounding noise beside its own mean, whatever its unit.
    """
    cols = present(df, cols)
    names = F.array(*[F.lit(c) for c in cols])
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    vx = F.col("sxx") - F.try_divide(sx * sx, n)
    vy = F.col("syy") - F.try_divide(sy * sy, n)
    # A constant column leaves only rounding noise after the shift.
    spread = (vx > F.col("sxx") * 1e-9) & (vy > F.col("syy") * 1e-9) & (n > 1)
    means = column_means(df, cols)
    noise = F.array(*[F.abs(means[c]) * 1e-15 for c in cols])
    sure = (vx > n * F.pow(F.col("_noise")[F.col("i")], 2)) & (vy > n * F.pow(F.col("_noise")[F.col("j")], 2))
    r = F.when(spread & sure, (F.col("sxy") - sx * sy / n) / (F.sqrt(vx) * F.sqrt(vy)))
    r = F.when(spread & sure & (F.col("i") == F.col("j")), F.lit(1.0)).otherwise(r)
    return pair_moments(df, cols).withColumn("_noise", noise).select(
        names[F.col("i")].alias("row_name"),
        names[F.col("j")].alias("col_name"),
        (F.round(r, digits) if digits is not None else r).alias("r"),
    )


def corr_block(df: DataFrame, rows: list[str], cols: list[str]) -> DataFrame:
    """Correlations of some columns with some others: cells of the matrix."""
    rows, cols = present(df, rows), present(df, cols)
    matrix = corr_matrix(df, list(dict.fromkeys(rows + cols)), None)
    return matrix.where(F.col("row_name").isin(rows) & F.col("col_name").isin(cols))


def rank_factors(df: DataFrame, factors: list[str], target: str = "total_sales") -> DataFrame:
    """Factors by absolute correlation with the target, weakest first."""
    block = corr_block(df, factors, [target])
    out = block.select(F.col("row_name").alias("factor"), F.abs("r").alias("strength"))
    return out.orderBy(F.asc_nulls_first("strength"), "factor")


def group_corr(df: DataFrame, group: str, fuels: list[str] = roles.FUEL_TARGETS) -> DataFrame:
    """Matrix over the fuels and one factor group."""
    return corr_matrix(df, list(dict.fromkeys(fuels + roles.FACTOR_GROUPS[group])))


def top_factors(df: DataFrame, target: str, group: str, k: int = 5) -> DataFrame:
    ranked = rank_factors(df, roles.FACTOR_GROUPS[group], target)
    return ranked.orderBy(F.desc_nulls_last("strength"), "factor").limit(k)


def trend_cell(x: str, y: str):
    """Line, r and end points over complete pairs; null under five of them."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x).cast("double")), F.when(both, F.col(y).cast("double"))
    n = F.count(a)
    slope = F.try_divide(F.covar_pop(a, b), F.var_pop(a))
    start = F.avg(b) - slope * F.avg(a)
    enough = n >= 5
    return F.struct(
        F.lit(x).alias("x_name"),
        F.lit(y).alias("y_name"),
        n.alias("n"),
        F.when(enough, slope).alias("slope"),
        F.when(enough, start).alias("intercept"),
        F.when(enough, correlation(x, y)).alias("r"),
        F.when(enough, F.min(a)).alias("x_from"),
        F.when(enough, F.max(a)).alias("x_to"),
        F.when(enough, start + slope * F.min(a)).alias("y_from"),
        F.when(enough, start + slope * F.max(a)).alias("y_to"),
    )


def trends(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Regression lines of several column pairs over all rows, in one pass."""
    cells = F.array(*[trend_cell(x, y) for x, y in pairs])
    return df.agg(cells.alias("a")).select(F.inline("a"))


def price_ratio_trend(df: DataFrame) -> DataFrame:
    """Own sales against the competitor price ratio."""
    diesel = present(df, ["sales_DT_EURO", "sales_DT_TANEKO"])
    own = {"comp_ratio_AI92": "sales_AI92", "comp_ratio_AI95": "sales_AI95"}
    if diesel:
        own["comp_ratio_DT"] = diesel[0]
    return trends(df, [(x, y) for x, y in own.items() if x in df.columns and y in df.columns])


def scatter_sample(df: DataFrame, n: int, seed: int, keys: tuple = ("station_id", "timestamp")) -> DataFrame:
    """At most n rows, the same for one seed: those with the smallest hash of key and seed."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    rows = df.withColumn("_hash", F.md5(text))
    return rows.orderBy("_hash", *keys).limit(n).drop("_hash")


def skew_table(df: DataFrame, targets: list[str]) -> DataFrame:
    """Range and skewness of each target before and after log(1+x), in one pass."""
    cells = [
        F.struct(
            F.lit(t).alias("target"),
            F.min(t).alias("low"),
            F.max(t).alias("high"),
            sample_skewness(t).alias("skew_raw"),
            sample_skewness(F.log1p(t)).alias("skew_log"),
        )
        for t in present(df, targets)
    ]
    return df.agg(F.array(*cells).alias("a")).select(F.inline("a"))


def _bin(x, lo, hi, bins: int):
    # A column without spread fills the first bin.
    place = F.coalesce(F.floor(F.try_divide((x - lo) * bins, hi - lo)).cast("int"), F.lit(0))
    return F.least(place, F.lit(bins - 1))


def histogram(df: DataFrame, column: str, bins: int = 60) -> DataFrame:
    """Counts of equal bins from minimum to maximum; the top edge joins the last bin."""
    x = F.col(column).cast("double")
    ends = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    rows = df.where(x.isNotNull()).select(x.alias("x"), ends.alias("e"))
    lo, hi = F.col("e.lo"), F.col("e.hi")
    counted = rows.groupBy(_bin(F.col("x"), lo, hi, bins).alias("bin"), "e").agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    width = (hi - lo) / bins
    return counted.select(
        "bin",
        (lo + F.col("bin") * width).alias("bin_from"),
        (lo + (F.col("bin") + 1) * width).alias("bin_to"),
        "n_rows",
    )


def density(df: DataFrame, column: str, by: str = STATION, bins: int = 60) -> DataFrame:
    """Normalised histogram of each group over common bins."""
    x = F.col(column).cast("double")
    ends = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    rows = df.where(x.isNotNull()).select(by, x.alias("x"), ends.alias("e"))
    cells = rows.groupBy(by, _bin(F.col("x"), F.col("e.lo"), F.col("e.hi"), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    sizes = cells.groupBy(by).agg(F.sum("n_rows").alias("_n"))
    out = cells.join(sizes, by)
    return out.select(by, "bin", "n_rows", (F.col("n_rows") / F.col("_n")).alias("share"))


def box_stats(df: DataFrame, column: str, by: str = STATION) -> DataFrame:
    """Quartiles of each group and whiskers at the outermost values within 1.5 IQR."""
    long = exact_quantiles(df, [column], [0.25, 0.5, 0.75], [by])
    quartiles = long.groupBy(by).pivot("prob", [0.25, 0.5, 0.75]).agg(F.first("value"))
    quartiles = quartiles.toDF(by, "q1", "median", "q3")
    reach = (F.col("q3") - F.col("q1")) * 1.5
    x = F.col(column).cast("double")
    inside = x.between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        df.select(by, column)
        .join(quartiles, by)
        .groupBy(by, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, x)).alias("whisker_low"),
            F.max(F.when(inside, x)).alias("whisker_high"),
            F.count(F.when(~inside, 1)).alias("n_outliers"),
        )
    )


def measured_columns(df: DataFrame, fixed: list[str] = roles.STATIC_REALS) -> list[str]:
    """Numeric columns that hold more than 0 and 1 and are not ``fixed`` for a station.

    The classes of the columns, one flag each, reach the driver.
    """
    cols = [c for c in numeric_columns(df) if c not in fixed]
    flags = df.agg(*[F.bool_or(~F.col(c).isin(0, 1)).alias(c) for c in cols]).first()
    return [c for c in cols if flags[c]]


def iqr_outliers(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows outside 1.5 IQR for each column that has any."""
    long = exact_quantiles(df, cols, [0.25, 0.75])
    ends = long.groupBy("column").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"),
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    ends = ends.select("column", (F.col("q1") - reach).alias("lo"), (F.col("q3") + reach).alias("hi"))
    # One row with a field per column of the table.
    wide = [F.max(F.when(F.col("column") == c, F.struct("lo", "hi"))).alias(c) for c in cols]
    limits = ends.agg(F.struct(*wide)).scalar()
    rows = df.select(limits.alias("m"), *[F.col(c).cast("double").alias(c) for c in cols])

    def beyond(c):
        return (F.col(c) < F.col(f"m.{c}.lo")) | (F.col(c) > F.col(f"m.{c}.hi"))

    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(F.when(beyond(c), 1)).alias("n_outliers"),
            F.max(F.col(f"m.{c}.lo")).alias("low"),
            F.max(F.col(f"m.{c}.hi")).alias("high"),
        )
        for c in cols
    ]
    out = rows.agg(F.array(*cells).alias("a")).select(F.inline("a"))
    return out.where(F.col("n_outliers") > 0)


def target_scales(df: DataFrame, targets: list[str] = roles.TARGETS) -> DataFrame:
    """Median and IQR of each target over the given (training) rows."""
    long = exact_quantiles(df, targets, [0.25, 0.5, 0.75])
    return long.groupBy(F.col("column").alias("target")).agg(
        F.max(F.when(F.col("prob") == 0.5, F.col("value"))).alias("center"),
        (
            F.max(F.when(F.col("prob") == 0.75, F.col("value")))
            - F.max(F.when(F.col("prob") == 0.25, F.col("value")))
        ).alias("scale"),
    )


def long_targets(df: DataFrame, ids: list[str], targets: list[str] = roles.TARGETS) -> DataFrame:
    return to_long(df, ids, present(df, targets), "target", "y")
