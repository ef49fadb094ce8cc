"""Column expressions shared by the operators. All run inside the JVM."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_sum(cols: Sequence) -> Column:
    """Sum over columns of one row, by name; nulls count as zero."""
    return F.expr(" + ".join(["0.0D", *[f"coalesce(CAST(`{c}` AS DOUBLE), 0.0D)" for c in cols]]))


def ratio(top, bottom) -> Column:
    """Quotient, null when the divisor is zero."""
    return F.try_divide(col(top).cast("double"), col(bottom).cast("double"))


def change_pct(new, old) -> Column:
    return ratio(col(new) - col(old), old) * 100


def correlation(x, y) -> Column:
    """Pearson r over rows where both sides are present, null if either is constant."""
    both = col(x).isNotNull() & col(y).isNotNull()
    a = F.when(both, col(x).cast("double"))
    b = F.when(both, col(y).cast("double"))
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return F.try_divide(F.covar_pop(a, b), spread)


def sample_skewness(x) -> Column:
    """Bias-adjusted skewness, null under three values or without spread."""
    v = col(x).cast("double")
    n = F.count(v).cast("double")
    spread = F.stddev_pop(v)
    adjust = F.sqrt(n * (n - 1)) / (n - 2)
    return F.when((n > 2) & (spread > 0), F.skewness(v) * adjust)


def arg_max(key, value) -> Column:
    """Key of the largest value; the smallest key on ties. Numeric keys."""
    return F.max_by(col(key), F.when(col(value).isNotNull(), F.struct(col(value), -col(key))))


def arg_min(key, value) -> Column:
    return F.min_by(col(key), F.when(col(value).isNotNull(), F.struct(col(value), col(key))))


def duration_text(seconds) -> Column:
    """Seconds as ``h m s`` text in three sizes."""
    s = F.floor(col(seconds)).cast("long")
    h = F.floor(s / 3600)
    m = F.floor(F.pmod(s, F.lit(3600)) / 60)
    r = F.pmod(s, F.lit(60))
    return (
        F.when(s.isNull() | (s <= 0), F.lit("-"))
        .when(h > 0, F.format_string("%dh %02dm", h, m))
        .when(m > 0, F.format_string("%dm %02ds", m, r))
        .otherwise(F.format_string("%ds", r))
    )


def hours(n) -> Column:
    """An interval of n hours; n may be a column or a number."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.make_dt_interval(F.lit(0), n.cast("int"))


def moment(text: str) -> Column:
    """A timestamp without time zone from text."""
    return F.lit(text).cast("timestamp_ntz")


def hour_start(ts) -> Column:
    """Start of the hour, free of any session time zone."""
    t = col(ts)
    return t - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(t), F.extract(F.lit("SECOND"), t))


def hours_between(start, end) -> Column:
    """Whole hours from start to end, free of any session time zone."""
    gap = col(end) - col(start)
    return F.extract(F.lit("DAY"), gap) * 24 + F.extract(F.lit("HOUR"), gap)
