"""Quantile forecasts 24 hours ahead, built from training rows only.

The seasonal model holds exact quantiles of log(1+sales) for each station, target, day
type and hour, and optional effects of drivers such as traffic or promotions. The
regression model is fitted by MLlib on calendar, driver and lag columns.
"""

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import roles
from forecourt.functions.expressions import hours, moment
from forecourt.operators.features import add_cyclical, unlog
from forecourt.operators.joins import expand_horizon
from forecourt.operators.quantiles import exact_quantiles
from forecourt.operators.series import KEY, lagged, shortest_horizon
from forecourt.operators.stats import long_targets

CELL = [KEY, "is_weekend", "hour"]
NAMES = roles.QUANTILE_NAMES


# Seasonal model ------------------------------------------------------------------


def fit_seasonal(train: DataFrame, targets: list[str] = roles.TARGETS) -> DataFrame:
    """Quantiles of log(1+y) by station, target, day type and hour.

    A cell holds one value per day, which bounds what an exact percentile keeps.
    """
    long = long_targets(train, CELL, targets)
    q = F.percentile(F.log1p("y"), roles.QUANTILES).alias("q")
    cells = long.groupBy(*CELL, "target").agg(q)
    return cells.select(*CELL, "target", *[F.col("q")[i].alias(n) for i, n in enumerate(NAMES)])


def fit_effects(train: DataFrame, model: DataFrame, drivers: list[str]) -> DataFrame:
    """Slope of the log residual on each driver, per station and target.

    One slope at a time: drivers that move together share their effect twice. The
    regression model is the joint alternative.
    """
    targets = [t for t in roles.TARGETS if t in train.columns]
    long = long_targets(train, [*CELL, *drivers], targets)
    fitted = long.join(model.select(*CELL, "target", "q50"), [*CELL, "target"])
    rest = F.log1p("y") - F.col("q50")
    cells = []
    for d in drivers:
        x = F.col(d).cast("double")
        y = F.when(x.isNotNull(), rest)
        slope = F.try_divide(F.covar_pop(x, y), F.var_pop(x))
        cells.append(
            F.struct(
                F.lit(d).alias("driver"),
                F.coalesce(slope, F.lit(0.0)).alias("slope"),
                F.coalesce(F.avg(x), F.lit(0.0)).alias("center"),
            )
        )
    return fitted.groupBy(KEY, "target").agg(F.array(*cells).alias("a")).select(
        KEY, "target", F.inline("a")
    )


def with_model(rows: DataFrame, model: DataFrame) -> DataFrame:
    """Rows once per target of the model, with its quantiles and the ``level`` they come from.

    Cells without training rows fall back: ``station`` is the own cell, ``hour`` the mean of all stations in this
    day type and hour, ``all`` the mean of the target. No row is lost, whenever its station opened.
    """
    means = [F.avg(n).alias(n) for n in NAMES]
    overall = model.groupBy("target").agg(*means)
    # One entry per target, at most as many as there are target columns.
    each = overall.agg(F.collect_list(F.struct("target", *[F.col(n).alias(f"_a_{n}") for n in NAMES]))).scalar()
    pooled = model.groupBy("is_weekend", "hour", "target").agg(*[m.alias(f"_h_{n}") for m, n in zip(means, NAMES)])
    long = rows.select("*", F.inline(each))
    long = long.join(pooled, ["is_weekend", "hour", "target"], "left").join(model, [*CELL, "target"], "left")
    level = F.when(F.col("q50").isNotNull(), "station").when(F.col("_h_q50").isNotNull(), "hour").otherwise("all")
    filled = {n: F.coalesce(n, f"_h_{n}", f"_a_{n}") for n in NAMES}
    return long.withColumn("level", level).withColumns(filled).drop(*[f"_{k}_{n}" for k in "ha" for n in NAMES])


def forecast_seasonal(
    model: DataFrame,
    frame: DataFrame,
    effects: DataFrame | None = None,
    drivers: tuple = (),
    keep: tuple = (),
) -> DataFrame:
    """Long forecasts in log units for every row of the frame.

    With ``effects``, the values of the ``drivers`` move all quantiles of a row. Rows whose
    cell has no training rows use the fallback of ``with_model``; ``level`` in ``keep`` tells.
    """
    ids = [KEY, "timestamp", *keep]
    asked = [c for c in dict.fromkeys([*ids, *CELL, *drivers]) if c != "level"]
    rows = with_model(frame.select(*asked), model)
    if effects is None:
        return rows.select(*ids, "target", *NAMES)
    wide = effects.groupBy(KEY, "target").agg(
        *[
            F.max(F.when(F.col("driver") == d, F.struct("slope", "center"))).alias(f"_e_{d}")
            for d in drivers
        ]
    )
    shift = F.lit(0.0)
    for d in drivers:
        e = F.col(f"_e_{d}")
        move = e["slope"] * (F.col(d).cast("double") - e["center"])
        shift = shift + F.coalesce(move, F.lit(0.0))
    rows = rows.join(wide, [KEY, "target"], "left").withColumn("_shift", shift)
    return rows.select(*ids, "target", *[(F.col(n) + F.col("_shift")).alias(n) for n in NAMES])


def rolling_origin(
    model: DataFrame,
    facts: DataFrame,
    origins: DataFrame,
    targets: list[str] = roles.TARGETS,
    horizon: int = roles.HORIZON_HOURS,
    persistence: float = 0.5,
    nearest: bool = False,
) -> DataFrame:
    """Forecasts of 1 to ``horizon`` hours from each origin, in log units.

    ``nearest`` keeps one origin per hour, the last before it, ahead of all joins. An
    assembled prediction table needs no more than that.

    The error of the last hour before the origin carries over and fades by
    ``persistence`` per hour. Only rows before the origin are used. Cells without training
    rows fall back as in ``with_model``; an unknown last error counts as zero.
    """
    fitted = long_targets(facts, [*CELL, "time_idx", "timestamp"], targets).join(
        model, [*CELL, "target"]
    )
    last_error = fitted.select(
        KEY,
        "target",
        (F.col("time_idx") + 1).alias("origin_idx"),
        (F.log1p("y") - F.col("q50")).alias("_error"),
    )
    steps = expand_horizon(
        origins.select(KEY, F.col("time_idx").alias("origin_idx"), F.col("timestamp").alias("origin_ts")),
        horizon,
    )
    steps = steps.withColumn("timestamp", F.col("origin_ts") + hours(F.col("horizon_h") - 1))
    if nearest:
        steps = shortest_horizon(steps)
    steps = steps.withColumns(
        {"hour": F.hour("timestamp"), "is_weekend": (F.weekday("timestamp") >= 5).cast("int")}
    )
    rows = with_model(steps, model).join(last_error, [KEY, "target", "origin_idx"], "left")
    carry = F.coalesce("_error", F.lit(0.0)) * F.pow(F.lit(persistence), F.col("horizon_h"))
    return rows.select(
        KEY,
        "origin_ts",
        "horizon_h",
        "timestamp",
        "target",
        *[(F.col(n) + carry).alias(n) for n in NAMES],
    )


def attach_actuals(pred: DataFrame, facts: DataFrame, targets: list[str] = roles.TARGETS) -> DataFrame:
    """Actual value of each (station, timestamp, target)."""
    actual = long_targets(facts, [KEY, "timestamp"], targets).withColumnRenamed("y", "actual")
    return pred.join(actual, [KEY, "timestamp", "target"], "left")


def assemble_predictions(
    raw: DataFrame, facts: DataFrame, start: str = roles.TEST_START, end: str = roles.TEST_END
) -> DataFrame:
    """Raw log forecasts to the prediction table.

    Clipped to the test period, one forecast per hour (the nearest one), in natural
    units, with the actual values beside.
    """
    inside = raw.where(F.col("timestamp").between(moment(start), moment(end)))
    best = shortest_horizon(inside.drop("origin_ts"), (KEY, "timestamp", "target"))
    natural = {n: unlog(F.col(n)) for n in NAMES}
    out = best.withColumns(natural).withColumn("pred", F.col("q50"))
    return attach_actuals(out, facts)


def wide_predictions(pred: DataFrame, targets: list[str] = roles.TARGETS) -> DataFrame:
    """Keys, horizon and four columns per target."""
    cells = [F.first(c).alias(c) for c in ("pred", "q10", "q90", "actual")]
    return pred.groupBy(KEY, "timestamp", "horizon_h").pivot("target", targets).agg(*cells)


# Regression model ----------------------------------------------------------------

LAGS = (24, 168)


def regression_frame(df: DataFrame, target: str, drivers: list[str]) -> DataFrame:
    """Calendar, driver and lag columns of one target, in log units."""
    rows = df.withColumn("log_y", F.log1p(F.col(target).cast("double")))
    cols = dict.fromkeys([KEY, "timestamp", "time_idx", "hour", "day_of_week", "log_y", *drivers])
    return add_cyclical(lagged(rows.select(*cols), ["log_y"], LAGS))


def regression_features(drivers: list[str]) -> list[str]:
    cycles = [f"{c}_{f}" for c in ("hour", "day_of_week") for f in ("sin", "cos")]
    return cycles + list(drivers) + [f"log_y_lag{n}" for n in LAGS]


def fit_regression(train: DataFrame, drivers: list[str], kind: str = "linear", seed: int = 7):
    """An MLlib model of log sales and the quantiles of its residuals by hour."""
    features = regression_features(drivers)
    rows = train.dropna(subset=[*features, "log_y"])
    vectors = VectorAssembler(inputCols=features, outputCol="features")
    if kind == "linear":
        learner = LinearRegression(labelCol="log_y", regParam=0.01, solver="normal")
    else:
        learner = GBTRegressor(labelCol="log_y", maxIter=20, maxDepth=4, seed=seed)
    model = PipelineModel([vectors, learner.fit(vectors.transform(rows))])
    fitted = model.transform(rows).select("hour", (F.col("log_y") - F.col("prediction")).alias("rest"))
    long = exact_quantiles(fitted, ["rest"], roles.QUANTILES, ["hour"])
    spread = long.groupBy("hour").agg(
        *[
            F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"_d_{n}")
            for n, p in zip(NAMES, roles.QUANTILES, strict=True)
        ]
    )
    return model, spread


def forecast_regression(model, spread: DataFrame, frame: DataFrame, keep: tuple = ()) -> DataFrame:
    """Quantiles in log units: prediction plus the residual quantiles of the hour."""
    rows = model.transform(frame).join(F.broadcast(spread), "hour")
    return rows.select(
        KEY,
        "timestamp",
        *keep,
        *[(F.col("prediction") + F.col(f"_d_{n}")).alias(n) for n in NAMES],
    )


def regression_weights(model, drivers: list[str]) -> list[tuple[str, float]]:
    """Feature names with coefficient or importance of the fitted model."""
    fitted = model.stages[-1]
    weights = fitted.coefficients if hasattr(fitted, "coefficients") else fitted.featureImportances
    return list(zip(regression_features(drivers), [float(w) for w in weights.toArray()], strict=True))
