"""Derived columns of the fact table."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt import roles
from forecourt.functions.expressions import change_pct, ratio, row_sum


def present(df: DataFrame, cols: list[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


def drop_redundant(df: DataFrame, cols: list[str] = roles.REDUNDANT) -> DataFrame:
    return df.drop(*cols)


def fill_missing(df: DataFrame, values: dict[str, str] = roles.FILL_VALUES) -> DataFrame:
    """Sentinels for nulls in the columns that exist."""
    here = {c: v for c, v in values.items() if c in df.columns}
    return df.fillna(here) if here else df


def with_row_sum(df: DataFrame, out: str, cols: list[str], if_absent: bool = False) -> DataFrame:
    """Sum of columns per row; ``if_absent`` leaves an existing column alone."""
    if if_absent and out in df.columns:
        return df
    return df.withColumn(out, row_sum(present(df, cols)))


def with_price_ratio(df: DataFrame, ratios: dict = roles.PRICE_RATIOS) -> DataFrame:
    """Competitor price over own price; the first own price column that exists counts."""
    columns = {}
    for out, (rival, own) in ratios.items():
        own = present(df, own)
        if rival in df.columns and own:
            columns[out] = ratio(rival, own[0])
    return df.withColumns(columns) if columns else df


def load_hub(df: DataFrame) -> DataFrame:
    """Facts with totals, price ratios and sentinels."""
    df = with_row_sum(df, "total_fuel_sales", roles.FUEL_TARGETS, if_absent=True)
    df = with_row_sum(df, "shop_total_revenue", roles.SHOP_TARGETS, if_absent=True)
    df = with_row_sum(df, "total_traffic", roles.TRAFFIC, if_absent=True)
    return fill_missing(with_price_ratio(df))


def with_sales(df: DataFrame, fuels: list[str] | None = None, shops: list[str] | None = None) -> DataFrame:
    """Totals over the chosen fuels and shop categories; an empty choice means all."""
    df = with_row_sum(df, "total_sales", fuels or roles.FUEL_TARGETS)
    return with_row_sum(df, "total_shop_sales", shops or roles.SHOP_TARGETS)


def add_cyclical(df: DataFrame, periods: dict[str, int] = roles.CYCLE_PERIODS) -> DataFrame:
    """Sine and cosine of calendar columns."""
    columns = {}
    for c in present(df, list(periods)):
        angle = F.col(c) * (2 * math.pi) / periods[c]
        columns[f"{c}_sin"] = F.sin(angle)
        columns[f"{c}_cos"] = F.cos(angle)
    return df.withColumns(columns) if columns else df


def log_targets(df: DataFrame, cols: list[str] = roles.TARGETS) -> DataFrame:
    """log(1+x) of the targets; the raw values stay as ``<name>_orig``."""
    cols = present(df, cols)
    raw = {f"{c}_orig": F.col(c) for c in cols}
    return df.withColumns(raw | {c: F.log1p(c) for c in cols})


def unlog(x):
    """Back from log(1+x); negative logs count as zero."""
    return F.when(x.isNotNull(), F.expm1(F.greatest(x, F.lit(0.0))))


def exp_targets(df: DataFrame, cols: list[str] = roles.TARGETS) -> DataFrame:
    return df.withColumns({c: unlog(F.col(c)) for c in present(df, cols)})


def to_long(df: DataFrame, ids: list[str], values: list[str], var: str, val: str) -> DataFrame:
    """Wide columns as (name, value) rows."""
    same = [F.col(c).cast("double").alias(c) for c in values]
    return df.select(*ids, *same).unpivot(ids, values, var, val)


def suffix(df: DataFrame, cols: list[str], text: str) -> DataFrame:
    return df.withColumnsRenamed({c: c + text for c in cols})


def code_text(df: DataFrame, c: str) -> Column:
    """A category code as text, without a fraction of zeros where every value of the column is a number.

    Text is never sent through a number, so long codes and leading zeros survive; a column that holds other text as
    well stays as it is.
    """
    kind = df.schema[c].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # Beyond 2**53 a double is no exact code; its own text stays.
        whole = (F.col(c) == F.floor(c)) & (F.abs(c) <= 1 << 53)
        return F.when(whole, F.col(c).cast("long").cast("string")).otherwise(F.col(c).cast("string"))
    text = F.col(c).cast("string")
    if not isinstance(kind, (T.StringType, T.DecimalType)):
        return text
    numbers = df.agg(F.coalesce(F.min(text.rlike(r"^[+-]?[0-9]+([.][0-9]*)?$")), F.lit(False))).scalar()
    return F.when(numbers, F.regexp_replace(text, r"[.]0*$", "")).otherwise(text)


def normalise_types(
    df: DataFrame, ids: list[str] = ("station_id",), categories: list[str] = (), reals: list[str] = ()
) -> DataFrame:
    """Ids as their own text, categories as text without a fraction, features as double."""
    columns = {c: F.col(c).cast("string") for c in ids if c in df.columns}
    columns |= {c: code_text(df, c) for c in categories if c in df.columns}
    columns |= {c: F.col(c).cast("double") for c in reals if c in df.columns}
    return df.withColumns(columns)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def classify_columns(df: DataFrame, key: str = "station_id") -> DataFrame:
    """Per numeric column: only 0 and 1, and constant within every station."""
    cols = [c for c in numeric_columns(df) if c != key]
    stations = df.groupBy(key).agg(
        *[
            F.struct(
                F.coalesce(F.bool_and(F.col(c).isin(0, 1)), F.lit(True)).alias("binary"),
                F.coalesce(F.max(c) == F.min(c), F.lit(True)).alias("constant"),
            ).alias(c)
            for c in cols
        ]
    )
    return stations.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.bool_and(f"{c}.binary").alias("is_binary"),
                    F.bool_and(f"{c}.constant").alias("is_constant"),
                )
                for c in cols
            ]
        ).alias("a")
    ).select(F.inline("a"))


def binary_columns(df: DataFrame) -> list[str]:
    """Names of the 0/1 columns; one small row comes to the driver."""
    cols = numeric_columns(df)
    row = df.agg(*[F.coalesce(F.bool_and(F.col(c).isin(0, 1)), F.lit(True)).alias(c) for c in cols]).first()
    return [c for c in cols if row[c]]


def with_price_delta(df: DataFrame, price: str, base: str, out: str = "price_delta_pct") -> DataFrame:
    return df.withColumn(out, change_pct(price, base))


def with_error(df: DataFrame, pred: str = "pred", actual: str = "actual") -> DataFrame:
    return df.withColumn("error", F.col(pred) - F.col(actual))
