"""Label codes of categories: sorted distinct values become 0, 1, 2 and so on."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.operators.features import present
from forecourt.sources import scratch

#: Values of a column up to which its codes are looked up in place; columns with more are joined.
FEW = 64


def fit_labels(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value, code) over all rows, from one pass over the data.

    Distinct values are laid out by range. Each range is ranked by itself and begins behind the sizes of the ranges
    before it, so no task holds all values of a column.
    """
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in present(df, cols)])
    )
    values = df.select(cells.alias("cell")).select("cell.*").where(F.col("value").isNotNull()).distinct()
    ranges = values.repartitionByRange("column", "value").withColumn("_range", F.spark_partition_id())
    ranges = scratch.materialise(ranges, "values")
    sizes = ranges.groupBy("column", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("column").orderBy("_range")) - F.col("_n")
    rank = F.row_number().over(Window.partitionBy("column", "_range").orderBy("value"))
    ranked = ranges.withColumn("_rank", rank).join(sizes.withColumn("_before", before), ["column", "_range"])
    return ranked.select("column", "value", (F.col("_before") + F.col("_rank") - 1).cast("int").alias("code"))


def apply_labels(df: DataFrame, dictionary: DataFrame, cols: list[str]) -> DataFrame:
    """Adds ``<column>_enc``; values the dictionary lacks become null.

    Codes of columns with at most ``FEW`` values come from one row of maps; only longer columns are joined. Pass a
    written dictionary: it is read for the sizes, for the maps and once for each joined column.
    """
    cols = present(df, cols)
    sizes = {r["column"]: r["count"] for r in dictionary.where(F.col("column").isin(cols)).groupBy("column").count().collect()}
    short = [c for c in cols if sizes.get(c, 0) <= FEW]
    if short:
        entry = F.struct("value", "code")
        maps = [F.map_from_entries(F.collect_list(F.when(F.col("column") == c, entry))).alias(c) for c in short]
        row = dictionary.where(F.col("column").isin(short)).agg(F.struct(*maps)).scalar()
        df = df.withColumn("_codes", row)
        df = df.withColumns({f"{c}_enc": F.try_element_at(F.col("_codes")[c], F.col(c).cast("string")) for c in short}).drop("_codes")
    for c in cols:
        if c not in short:
            part = dictionary.where(F.col("column") == c).select(
                F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"{c}_enc")
            )
            df = df.join(part, F.col(c).cast("string") == F.col(f"_v_{c}"), "left").drop(f"_v_{c}")
    return df


def label_map(df: DataFrame, column: str) -> DataFrame:
    """Distinct (code, value) pairs of an encoded column."""
    return df.select(f"{column}_enc", column).distinct().orderBy(f"{column}_enc")
