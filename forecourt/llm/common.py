"""Small helpers that the operators share."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.sources import scratch


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    while name.lower() in (c.lower() for c in df.columns):
        name = f"_{name}"
    return name


def unit_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A non-null key of a row: its id, or for a null id a number above all ids made from its text."""
    own = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), 2)
    return F.coalesce(F.col(doc_id).cast("long"), own + F.lit(1 << 62))


def real_id(key: str) -> Column:
    """The id behind a ``unit_key``: null for a row without one."""
    return F.when(F.col(key) < (1 << 62), F.col(key))


def ranked(
    df: DataFrame,
    groups: list[str],
    by: list[str],
    order: list[str],
    slim: DataFrame | None = None,
    rows_per_task: int = 5_000,
    out: str = "rank",
) -> DataFrame:
    """Rows with ``out``, gapless from 0 in each group (non-null columns), in the order of a hash of ``by``.

    No window covers a group: rows are numbered inside hash buckets, and bucket counts are summed. The number of
    buckets follows the number of rows. Rows of one bucket are in the order of ``by``, then ``order``. ``slim``
    holds the same rows with no more than ``groups`` and ``by``, for counting. ``out`` must be no column of ``df``.
    """
    slim = df if slim is None else slim
    bucket, inside, before, n = (fresh(df, c) for c in ("_bucket", "_inside", "_before", "_n"))
    place = F.pmod(F.xxhash64(*by), F.lit(1 + slim.count() // rows_per_task))
    counts = slim.groupBy(*groups, place.alias(bucket)).agg(F.count(F.lit(1)).alias(n))
    earlier = F.sum(n).over(Window.partitionBy(*groups).orderBy(bucket)) - F.col(n)
    counts = scratch.materialise(counts.withColumn(before, earlier).drop(n), "ranks")
    number = F.row_number().over(Window.partitionBy(*groups, bucket).orderBy(*by, *order))
    rows = df.withColumn(bucket, place).withColumn(inside, number.cast("long"))
    numbered = rows.join(counts, [*groups, bucket]).withColumn(out, F.col(before) + F.col(inside) - 1)
    return numbered.select(*df.columns, out)
