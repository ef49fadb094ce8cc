"""Summary of training runs from a log of scalars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import roles
from forecourt.functions.expressions import duration_text


def run_summary(scalars: DataFrame, tags: list[str] = roles.TRAIN_TAGS, val_tag: str = roles.VAL_TAG) -> DataFrame:
    """Status, duration, last training loss and best validation loss of every run.

    One grouped pass by (run, tag); the best available training tag is chosen after it,
    so a run with a very long log is no burden on one task.
    """
    order = F.struct("step", "wall_time")
    by_tag = scalars.groupBy("run", "tag").agg(
        F.count(F.lit(1)).alias("n"),
        F.max_by("value", order).alias("last"),
        F.min("value").alias("best"),
        F.min_by("step", F.struct("value", "step")).alias("best_step"),
        (F.max_by("wall_time", order) - F.min_by("wall_time", order)).alias("span"),
    )
    rank = F.array_position(F.array(*[F.lit(t) for t in tags]), F.col("tag"))
    cell = F.struct("tag", "n", "last", "best", "best_step", "span")
    runs = by_tag.groupBy("run").agg(
        F.min_by(cell, F.when(rank > 0, rank)).alias("t"),
        F.max_by(cell, F.when(F.col("tag") == val_tag, F.lit(1))).alias("v"),
    )
    n_train, n_val = F.coalesce("t.n", F.lit(0)), F.coalesce("v.n", F.lit(0))
    seconds = F.when(n_train >= 2, F.col("t.span")).when(n_val >= 2, F.col("v.span"))
    newest = scalars.agg(F.max("run")).scalar()
    return runs.select(
        "run",
        F.when(n_val > 0, "finished").when(n_train > 0, "interrupted").otherwise("no data").alias("status"),
        F.col("t.tag").alias("train_tag"),
        n_train.alias("n_train"),
        n_val.alias("n_val"),
        seconds.alias("seconds"),
        duration_text(seconds).alias("duration"),
        F.col("t.last").alias("last_train_loss"),
        F.col("v.best").alias("best_val_loss"),
        F.col("v.best_step").alias("best_val_step"),
        (F.col("run") == newest).cast("int").alias("is_newest"),
    )
