"""Stand-in tables as the queries use them."""

from forecourt.operators.features import load_hub, with_sales
from forecourt.operators.series import split_of, with_time_idx
from forecourt.sources import scratch
from forecourt.sources import standins as s


def hourly(spark, folder):
    return s.hourly_facts(spark, folder)


def merged(spark, folder):
    return s.merged(spark, folder)


def merged_table(spark, folder):
    """Merged facts, written once for plans that read them several times."""
    return scratch.materialise(merged(spark, folder), "merged")


def hub(spark, folder):
    return with_sales(load_hub(merged(spark, folder)))


def daily(spark, folder):
    return with_sales(load_hub(s.daily_facts(spark, folder)))


def split_col():
    return split_of("timestamp", s.TRAIN_END, s.VAL_END)


def train_rows(df):
    return df.where(split_col() == "train")


def indexed(df):
    return with_time_idx(df)


def daily_table(spark, folder):
    """The daily hub, written once for plans that read it several times."""
    return scratch.materialise(daily(spark, folder), "daily")


def hub_table(spark, folder):
    return scratch.materialise(hub(spark, folder), "hub")
