"""Data quality: nulls, column profiles, catalog, reconciliation."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.functions.expressions import row_sum


def null_report(df: DataFrame) -> DataFrame:
    """Null count of every column that has nulls."""
    cells = [
        F.struct(F.lit(c).alias("column"), F.count(F.when(F.col(c).isNull(), 1)).alias("n_null"))
        for c in df.columns
    ]
    out = df.agg(F.array(*cells).alias("a")).select(F.inline("a"))
    return out.where(F.col("n_null") > 0)


def null_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Null counts before and after filling."""
    a = null_report(before).withColumnRenamed("n_null", "n_before")
    b = null_report(after).withColumnRenamed("n_null", "n_after")
    return a.join(b, "column", "left").fillna({"n_after": 0})


def value_counts(df: DataFrame, cols: list[str], order: list[str]) -> DataFrame:
    """Distinct values of each column with the place of their first row.

    Tasks merge equal values before they shuffle, and the shuffle key holds the value,
    so neither a long column nor a common value lands in one task.
    """
    place = F.struct(*order)
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    )
    rows = df.select(place.alias("place"), cells.alias("cell")).select("place", "cell.*")
    rows = rows.where(F.col("value").isNotNull())
    return rows.groupBy("column", "value").agg(F.min("place").alias("place"))


def first_values(values: DataFrame, n: int = 3) -> DataFrame:
    """Number of distinct values and the first n of them, per column."""
    sizes = values.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
    order = Window.partitionBy("column").orderBy("place", "value")
    first = values.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n)
    lists = first.groupBy("column").agg(
        F.array_sort(F.collect_list(F.struct("_rank", "value"))).alias("_v")
    )
    return sizes.join(lists, "column").withColumn("examples", F.col("_v.value")).drop("_v")


def column_names(df: DataFrame, descriptions: dict[str, str] | None = None) -> DataFrame:
    """Position, name, type and description of the columns."""
    text = descriptions or {}
    schema = T.StructType(
        [
            T.StructField("position", T.IntegerType()),
            T.StructField("column", T.StringType()),
            T.StructField("dtype", T.StringType()),
            T.StructField("description", T.StringType()),
        ]
    )
    rows = [(i + 1, c, t, text.get(c, "-")) for i, (c, t) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, schema)


def column_profile(
    df: DataFrame, order: list[str] = ("timestamp", "station_id"), approximate: bool = False
) -> DataFrame:
    """Type, distinct values, nulls and range of each column.

    Numbers and times show minimum and maximum, text its first three values. With
    ``approximate`` the distinct values of numbers and times are estimated, which spares
    the shuffle of all their values.
    """
    cols = df.columns
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    listed = [c for c in cols if c in texts or not approximate]
    none = F.lit(None).cast("long")
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(F.when(F.col(c).isNull(), 1)).alias("n_null"),
            F.min(c).cast("string").alias("low"),
            F.max(c).cast("string").alias("high"),
            (none if c in listed else F.approx_count_distinct(c)).alias("n_about"),
        )
        for c in cols
    ]
    ranges = df.agg(F.array(*cells).alias("a")).select(F.inline("a"))
    found = first_values(value_counts(df, listed, list(order)))
    shown = F.concat_ws(", ", F.transform("examples", lambda v: F.substring(v, 1, 22)))
    more = F.when(F.col("n_distinct") > 3, F.concat(shown, F.lit(", ..."))).otherwise(shown)
    span = F.concat(F.lit("["), "low", F.lit(", "), "high", F.lit("]"))
    out = F.broadcast(column_names(df)).join(ranges, "column").join(found, "column", "left")
    return out.select(
        "position",
        "column",
        "dtype",
        F.coalesce("n_distinct", "n_about", F.lit(0)).alias("n_distinct"),
        "n_null",
        F.when(F.col("column").isin(*texts), more).otherwise(span).alias("span") if texts else span.alias("span"),
    )


def column_catalog(
    df: DataFrame,
    descriptions: dict[str, str],
    n: int = 3,
    order: list[str] = ("timestamp", "station_id"),
) -> DataFrame:
    """Position, name, description and the first n distinct values of each column."""
    found = first_values(value_counts(df, df.columns, list(order)), n)
    shown = F.concat_ws(", ", "examples")
    text = F.when(F.col("n_distinct") > n, F.concat(shown, F.lit(", ..."))).otherwise(shown)
    out = F.broadcast(column_names(df, descriptions)).join(found, "column", "left")
    return out.select(
        "position", "column", "description", F.coalesce(text, F.lit("")).alias("examples")
    )


def reconcile(df: DataFrame, totals: dict[str, list[str]], eps: float = 1e-6) -> DataFrame:
    """For each total: rows that differ from the sum of their parts, and by how much."""
    cells = []
    for total, parts in totals.items():
        gap = F.abs(F.col(total).cast("double") - row_sum(parts))
        cells.append(
            F.struct(
                F.lit(total).alias("total"),
                F.count(total).alias("n_rows"),
                F.count(F.when(gap > eps, 1)).alias("n_mismatch"),
                F.coalesce(F.sum(F.when(gap > eps, gap)), F.lit(0.0)).alias("gap_sum"),
                F.max(gap).alias("gap_max"),
            )
        )
    return df.agg(F.array(*cells).alias("a")).select(F.inline("a"))


def class_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct values of each category."""
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    )
    values = df.select(cells.alias("cell")).select("cell.*").where(F.col("value").isNotNull()).distinct()
    return values.groupBy("column").agg(F.count(F.lit(1)).alias("n_classes"))
