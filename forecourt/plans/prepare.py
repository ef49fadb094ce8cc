"""The feature pipeline: merged facts to the prepared table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt import roles
from forecourt.functions.calendar import with_shop_open
from forecourt.operators.encoding import apply_labels, fit_labels
from forecourt.operators.features import (
    add_cyclical,
    binary_columns,
    drop_redundant,
    fill_missing,
    log_targets,
)
from forecourt.operators.scaling import apply_scalers, fit_scalers, scalable_columns
from forecourt.operators.series import split_of, with_time_idx
from forecourt.sources import scratch


def clean(df: DataFrame) -> DataFrame:
    """Sentinels for nulls, redundant columns out, opening hours in."""
    return with_shop_open(drop_redundant(fill_missing(df)))


def category_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def prepare(
    df: DataFrame, train_end: str = roles.TRAIN_END, val_end: str = roles.VAL_END
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Prepared rows with their split, the scaler table and the label dictionary.

    The order is fixed: opening hours before the search for 0/1 columns, codes and logs
    before scaling. Scalers and labels are small tables and are written once, so that
    the wide plan reads them instead of computing them again.
    """
    rows = clean(df)
    binary = binary_columns(rows)
    categories = category_columns(rows)
    labels = scratch.materialise(fit_labels(rows, categories), "labels")
    rows = add_cyclical(apply_labels(rows, labels, categories))
    rows = log_targets(with_time_idx(rows))
    cols = scalable_columns(rows, binary)
    scalers = scratch.materialise(fit_scalers(rows, cols, train_end), "scalers")
    rows = apply_scalers(rows, scalers, cols)
    return rows.withColumn("split", split_of("timestamp", train_end, val_end)), scalers, labels


def write_splits(prepared: DataFrame, path: str) -> None:
    """All rows in one parquet table with a folder per split."""
    prepared.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark, path: str, split: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("split") == split)
