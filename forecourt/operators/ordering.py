"""Ordering, top-k, arg-max and set operations on result tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.functions.expressions import arg_max as _arg_max
from forecourt.functions.expressions import arg_min as _arg_min


def ordered(df: DataFrame, by: list[str], desc: bool = False, nulls_first: bool = False) -> DataFrame:
    """Rows of a small result in a stated order."""
    cols = [F.col(c) for c in by]
    if desc:
        keys = [c.desc_nulls_first() if nulls_first else c.desc_nulls_last() for c in cols]
    else:
        keys = [c.asc_nulls_first() if nulls_first else c.asc_nulls_last() for c in cols]
    return df.orderBy(*keys)


def top_k(df: DataFrame, by: str, k: int, tie: str) -> DataFrame:
    """The k largest values; each task keeps k rows before they meet."""
    return df.orderBy(F.col(by).desc_nulls_last(), F.col(tie)).limit(k)


def arg_max(df: DataFrame, key: str, value: str) -> DataFrame:
    """Key and value of the largest value; the smallest key on ties."""
    return df.agg(_arg_max(key, value).alias(key), F.max(value).alias(value))


def arg_min(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.agg(_arg_min(key, value).alias(key), F.min(value).alias(value))


def append_future(history: DataFrame, future: DataFrame) -> DataFrame:
    """History rows, then future rows; columns match by name."""
    return history.unionByName(future, allowMissingColumns=True)


def with_all(df: DataFrame, columns: dict) -> DataFrame:
    """Several columns in one projection."""
    return df.withColumns(columns)


def distinct_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()
