"""Exact quantiles of columns too long for one task.

A sketch of each column gives a bracket around every wanted rank. One pass counts the values below and inside of each
bracket. Where a rank lies outside, the bracket moves to that side; where too many values lie inside, it is cut into
parts and the one that holds the rank is the next bracket, until all brackets are small. Only values of small brackets
are sorted.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.sources import scratch

ACCURACY = 10_000
#: Values that one bracket may hold when they are sorted.
SMALL = 50_000
#: Parts that a bracket is cut into.
PARTS = 32


def _inside(state: DataFrame, long: DataFrame, keys: list[str]) -> DataFrame:
    """The values of every bracket, beside the bracket."""
    known = state.withColumnsRenamed({k: f"_{k}" for k in keys})
    inside = [F.col(k) == F.col(f"_{k}") for k in keys] + [F.col("x").between(F.col("lo"), F.col("hi"))]
    return long.join(known, inside).drop(*[f"_{k}" for k in keys])


def _narrowed(pending: DataFrame, long: DataFrame, keys: list[str]) -> DataFrame:
    """Each bracket's part that holds the rank, with counts, and the least and the largest value there.

    Values of the bracket itself, spread evenly over its ranks, cut it. Each of them is a part of its own, so a value that
    fills most of a bracket is one part, and every part holds fewer distinct values than the bracket.
    """
    cuts = F.percentile_approx("x", [i / PARTS for i in range(PARTS + 1)], 100 * PARTS).alias("cuts")
    cuts = _inside(pending.select(*keys, "prob", "lo", "hi"), long, keys).groupBy(*keys, "prob").agg(cuts)
    pending = scratch.materialise(pending.join(cuts, [*keys, "prob"]), "cuts")
    x = F.col("x")
    part = 2 * F.size(F.filter("cuts", lambda c: c < x)) + F.array_contains("cuts", x).cast("int")
    group = [*keys, "n", "prob", "rank", "low", "high", "below", "above"]
    found = _inside(pending, long, keys).groupBy(*group, part.alias("part"))
    found = found.agg(F.count(F.lit(1)).alias("inside"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    along = Window.partitionBy(*keys, "prob").orderBy("part")
    found = found.withColumns(
        {
            "below": F.col("below") + F.sum("inside").over(along) - F.col("inside"),
            "above": F.coalesce(F.lead("lo").over(along), "above"),
        }
    )
    held = (F.col("below") <= F.col("rank")) & (F.col("rank") < F.col("below") + F.col("inside"))
    return found.where(held).select(*[c for c in pending.columns if c != "cuts"])


def exact_quantiles(
    df: DataFrame,
    cols: list[str],
    probs: list[float],
    by: list[str] = (),
    accuracy: int = ACCURACY,
    small: int = SMALL,
    spread: float = 3.0,
) -> DataFrame:
    """Rows (by..., column, prob, value), with linear interpolation between ranks.

    Nulls do not count, and rows with a null group are left out. All groups take the same way, whatever their size:
    a bracket reaches ``spread`` times the sketch's error to both sides, is narrowed while it holds more than ``small``
    values, and a sketch that is wrong costs a further pass, not the result.
    """
    by = list(by)
    keys = [*by, "column"]
    margin = spread / accuracy
    wanted = [max(p - margin, 0.0) for p in probs] + [min(p + margin, 1.0) for p in probs]

    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    long = long.unpivot(by, list(cols), "column", "x").dropna(subset=[*by, "x"])
    sketch = long.groupBy(*keys).agg(
        F.count("x").alias("n"),
        F.min("x").alias("low"),
        F.max("x").alias("high"),
        F.percentile_approx("x", wanted, accuracy).alias("s"),
    )
    pairs = [
        F.struct(
            F.lit(float(p)).alias("prob"),
            F.floor((F.col("n") - 1) * p).alias("rank"),
            F.col("s")[i].alias("lo"),
            F.col("s")[i + len(probs)].alias("hi"),
        )
        for i, p in enumerate(probs)
    ]
    # Written, so that Spark knows the size and broadcasts it only when it is small.
    brackets = scratch.materialise(sketch.select(*keys, "n", "low", "high", F.array(*pairs).alias("b")), "brackets")
    x = F.col("x")
    counts = []
    for i in range(len(probs)):
        lo, hi = F.col("b")[i]["lo"], F.col("b")[i]["hi"]
        counts += [F.count_if(x < lo), F.count_if(x.between(lo, hi)), F.min(F.when(x > hi, x))]
    measured = long.join(brackets.select(*keys, "b"), keys).groupBy(*keys)
    measured = measured.agg(*[c.alias(f"c{k}") for k, c in enumerate(counts)])
    entries = [
        F.struct(
            *[F.col("b")[i][c].alias(c) for c in ("prob", "rank", "lo", "hi")],
            *[F.col(f"c{3 * i + k}").alias(c) for k, c in enumerate(("below", "inside", "above"))],
        )
        for i in range(len(probs))
    ]
    state = brackets.join(measured, keys).select(*keys, "n", "low", "high", F.inline(F.array(*entries)))
    state = scratch.materialise(state, "brackets")
    before, behind = F.col("rank") < F.col("below"), F.col("rank") >= F.col("below") + F.col("inside")
    large = (F.col("inside") > small) & (F.col("lo") < F.col("hi"))
    while True:
        pending = state.where(before | behind | large)
        if pending.isEmpty():
            break
        moved = pending.withColumns(
            {
                "lo": F.when(before, F.col("low")).when(behind, F.col("above")).otherwise(F.col("lo")),
                "hi": F.when(before, F.col("lo")).when(behind, F.col("high")).otherwise(F.col("hi")),
                "below": F.when(before, F.lit(0)).when(behind, F.col("below") + F.col("inside")).otherwise(F.col("below")),
            }
        )
        done = state.where(~(before | behind | large))
        state = scratch.materialise(done.unionByName(_narrowed(moved, long, keys)), "brackets")
    return _picked(state, long, keys)


def _picked(state: DataFrame, long: DataFrame, keys: list[str]) -> DataFrame:
    """The quantile of every small bracket; the next rank may be the first value above it."""
    rows = _inside(state, long, keys)
    values = rows.groupBy(*keys, "prob", "n", "rank", "below", "above", "x").agg(F.count(F.lit(1)).alias("m"))
    along = Window.partitionBy(*keys, "prob").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    upto = values.withColumn("upto", F.col("below") + F.sum("m").over(along))
    picked = upto.groupBy(*keys, "prob", "n", "rank", "above").agg(
        F.min(F.when(F.col("upto") > F.col("rank"), F.col("x"))).alias("a"),
        F.min(F.when(F.col("upto") > F.col("rank") + 1, F.col("x"))).alias("b"),
    )
    part = (F.col("n") - 1) * F.col("prob") - F.col("rank")
    step = F.coalesce("b", "above", "a") - F.col("a")
    return picked.select(*keys, "prob", F.when(part > 0, F.col("a") + part * step).otherwise(F.col("a")).alias("value"))
