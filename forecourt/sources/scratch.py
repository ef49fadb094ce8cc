"""Where intermediate tables go, and how long plans are cut."""

import uuid

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's spark.checkpoint.dir.

    A session without that setting gets a folder below its warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> tuple[DataFrame, str]:
    """Write the rows once; the table read back, and its path for ``remove``."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialise(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write the rows once and go on from the written table, which outlives executors."""
    return written(df, name, partition_by)[0]


def remove(spark: SparkSession, path: str) -> None:
    """Delete one written table."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clear(spark: SparkSession) -> None:
    """Delete every table that this session wrote here, once no result reads them any more."""
    for path in _WRITTEN.pop(spark.sparkContext.applicationId, []):
        remove(spark, path)
