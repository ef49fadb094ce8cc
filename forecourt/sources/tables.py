"""Reading, checking and writing tables."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt import roles
from forecourt.functions.expressions import hours_between
from forecourt.sources import schemas


def _scan(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    if path.rstrip("/").endswith(".csv"):
        reader = spark.read.option("header", True)
        return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def _nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floats:
        return df
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def read_facts(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = schemas.FACTS,
    columns: list[str] | None = None,
) -> DataFrame:
    """Hourly facts from CSV or parquet; ``columns`` prunes the scan."""
    facts = _scan(spark, path, schema).withColumnsRenamed(roles.SOURCE_RENAMES)
    if columns is not None:
        facts = facts.select(*columns)
    return _nan_to_null(facts)


def read_passport(spark: SparkSession, path: str) -> DataFrame:
    return _nan_to_null(_scan(spark, path, schemas.PASSPORT))


def head(df: DataFrame, n: int, order: list) -> DataFrame:
    """The first n rows in a stated order."""
    return df.orderBy(*order).limit(n)


def optional_table(
    spark: SparkSession, path: str, schema: T.StructType
) -> tuple[DataFrame, bool]:
    """The table and whether it holds any row; a missing path is an empty table."""
    try:
        df = _scan(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema), False
    return df, not df.isEmpty()


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a parquet table. Rows of one partition value go to several writers."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def save_scalers(scalers: DataFrame, path: str) -> None:
    write_table(scalers.select(*schemas.SCALERS.fieldNames()), path)


def load_scalers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SCALERS).parquet(path)


def table_summary(df: DataFrame, key: str = "station_id", ts: str = "timestamp") -> DataFrame:
    """One row: rows, columns, period, stations, fewest and most hours per station."""
    per_station = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("a"), F.max(ts).alias("b")
    )
    return per_station.agg(
        F.sum("n").alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.min("a").alias("first_ts"),
        F.max("b").alias("last_ts"),
        F.count(F.lit(1)).alias("n_stations"),
        F.min("n").alias("min_hours"),
        F.max("n").alias("max_hours"),
        F.sum((hours_between("a", "b") + 1 - F.col("n"))).alias("missing_hours"),
    )


def rows_per_station(df: DataFrame, key: str = "station_name") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))


def read_scalars(df: DataFrame, tags: list[str] = roles.TRAIN_TAGS) -> DataFrame:
    """Rows of the best available tag of each run; ``tags`` come best first."""
    rank = F.array_position(F.array(*[F.lit(t) for t in tags]), F.col("tag"))
    wanted = df.where(F.col("tag").isin(tags))
    best = wanted.groupBy("run").agg(F.min_by("tag", rank).alias("tag"))
    return wanted.join(best, ["run", "tag"], "left_semi")


def table_checks(df: DataFrame, wanted: dict[str, list[str]] = roles.ROLES) -> tuple[dict, list]:
    """Role lists cut to the columns present, and the names that are absent."""
    present = set(df.columns)
    kept = {role: [c for c in cols if c in present] for role, cols in wanted.items()}
    absent = sorted({c for cols in wanted.values() for c in cols} - present)
    return kept, absent


def check_roles(
    df: DataFrame, wanted: dict[str, list[str]] = roles.ROLES, required: tuple = ("station_id",)
) -> dict[str, list[str]]:
    """Role lists cut to what the table has; raises when a required column is absent."""
    kept, _ = table_checks(df, wanted)
    lost = [c for c in required if c not in df.columns]
    if lost:
        raise ValueError(f"required columns are absent: {lost}")
    return kept
