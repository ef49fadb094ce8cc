"""Queries over scans, sources and sinks."""

from pyspark.sql import functions as F

from forecourt import roles
from forecourt.operators.scaling import fit_scalers
from forecourt.sources import schemas, scratch, standins, tables
from workload import base, sql
from workload.registry import query, rounded

FACT_COLUMNS = ["station_id", "timestamp", *roles.TARGETS, "total_traffic", "ad_channel", "temperature"]
SPLIT = f"""(CASE WHEN timestamp <= TIMESTAMP '{standins.TRAIN_END}' THEN 'train'
  WHEN timestamp <= TIMESTAMP '{standins.VAL_END}' THEN 'val' ELSE 'test' END)"""
SCALED = ["temperature", "visibility_km", "total_traffic", "hour", "competitor_price_AI92"]


@query(
    "facts_scan",
    sql.hourly(
        "SELECT station_id, timestamp, "
        + ", ".join(sql.r(c, c) if c in (*roles.TARGETS, "temperature") else c for c in FACT_COLUMNS[2:])
        + " FROM facts"
    ),
)
def facts_scan(spark, folder):
    return rounded(base.hourly(spark, folder).select(*FACT_COLUMNS))


@query(
    "daily_facts_scan",
    sql.daily(
        f"SELECT station_id, timestamp, station_name, road_type, season, {sql.r('total_sales', 'total_sales')}, "
        f"{sql.r('total_shop_sales', 'total_shop_sales')}, total_traffic FROM daily"
    ),
)
def daily_facts_scan(spark, folder):
    cols = ["station_id", "timestamp", "station_name", "road_type", "season"]
    cols += ["total_sales", "total_shop_sales", "total_traffic"]
    return rounded(base.daily(spark, folder).select(*cols))


@query(
    "passport_scan",
    f"WITH {sql.PASSPORT} SELECT station_id, station_name, {', '.join(sql.EXTRA)} FROM passport",
)
def passport_scan(spark, folder):
    return standins.passport(spark, folder).select("station_id", "station_name", *sql.EXTRA)


@query(
    "passport_csv_scan",
    f"WITH {sql.PASSPORT} SELECT station_id, station_name, {', '.join(sql.EXTRA)} FROM passport",
)
def passport_csv_scan(spark, folder):
    """The passport written as CSV and read back with its declared schema."""
    path = scratch.new_path(spark, "passport") + ".csv"
    names = schemas.PASSPORT.fieldNames()
    passport = standins.passport(spark, folder).select(*names)
    passport.write.option("header", True).csv(path)
    return tables.read_passport(spark, path)


@query(
    "facts_csv_scan",
    sql.hourly("SELECT station_id, timestamp, " + ", ".join(sql.r(c, c) for c in roles.TARGETS) + " FROM facts"),
)
def facts_csv_scan(spark, folder):
    """Facts as CSV with the original shop headers, read with renaming and pruning."""
    path = scratch.new_path(spark, "facts") + ".csv"
    back = {new: old for old, new in roles.SOURCE_RENAMES.items()}
    facts = base.hourly(spark, folder).withColumnsRenamed(back)
    cols = [f for f in schemas.FACTS.fields if f.name in facts.columns]
    facts.select(*[f.name for f in cols]).write.option("header", True).csv(path)
    schema = schemas.T.StructType(cols)
    return rounded(
        tables.read_facts(spark, path, schema, ["station_id", "timestamp", *roles.TARGETS])
    )


@query(
    "events_pruned_scan",
    "SELECT event_type, count(*) AS n_rows FROM events GROUP BY event_type",
)
def events_pruned_scan(spark, folder):
    df = tables.read_facts(spark, f"{folder}/events.parquet", None, ["event_type"])
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "facts_head",
    sql.hourly("SELECT station_id, timestamp, total_traffic FROM facts ORDER BY station_id, timestamp LIMIT 500"),
)
def facts_head(spark, folder):
    facts = base.hourly(spark, folder).select("station_id", "timestamp", "total_traffic")
    return tables.head(facts, 500, ["station_id", "timestamp"])


@query(
    "table_write_by_split",
    sql.hourly(
        f"SELECT {SPLIT} AS split, count(*) AS n_rows, {sql.r('sum(sales_AI92)', 'sales_AI92')} FROM facts GROUP BY 1"
    ),
)
def table_write_by_split(spark, folder):
    path = scratch.new_path(spark, "by-split")
    facts = base.hourly(spark, folder).withColumn("split", base.split_col())
    tables.write_table(facts.select("station_id", "timestamp", "sales_AI92", "split"), path, ["split"])
    back = spark.read.parquet(path)
    out = back.groupBy(F.col("split").cast("string").alias("split")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("sales_AI92").alias("sales_AI92")
    )
    return rounded(out)


@query(
    "optional_table_absent",
    "SELECT count(*) AS n_metrics, (SELECT count(*) FROM events) AS n_events, FALSE AS has_metrics, TRUE AS has_events "
    "FROM events WHERE FALSE",
)
def optional_table_absent(spark, folder):
    metrics, has_metrics = tables.optional_table(spark, f"{folder}/no_such_metrics.parquet", schemas.METRICS)
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    events, has_events = tables.optional_table(spark, f"{folder}/events.parquet", schema)
    n_metrics = metrics.agg(F.count(F.lit(1))).scalar()
    return events.agg(F.count(F.lit(1)).alias("n_events")).select(
        n_metrics.alias("n_metrics"),
        "n_events",
        F.lit(has_metrics).alias("has_metrics"),
        F.lit(has_events).alias("has_events"),
    )


_FIT = " UNION ALL ".join(
    f"SELECT station_id, '{c}' AS \"column\", {sql.r(f'avg({c})', 'mean')}, {sql.r(f'stddev_samp({c})', 'std')} "
    f"FROM facts WHERE timestamp <= TIMESTAMP '{standins.TRAIN_END}' GROUP BY station_id"
    for c in SCALED
)


@query("scalers_saved_and_loaded", sql.hourly(_FIT))
def scalers_saved_and_loaded(spark, folder):
    path = scratch.new_path(spark, "scalers")
    tables.save_scalers(fit_scalers(base.hourly(spark, folder), SCALED, standins.TRAIN_END), path)
    return rounded(tables.load_scalers(spark, path))


@query(
    "table_summary",
    sql.merged(
        f"""SELECT CAST(sum(n) AS BIGINT) AS n_rows, {len(sql.MERGED_TYPES)} AS n_columns, min(a) AS first_ts, max(b) AS last_ts,
        count(*) AS n_stations, min(n) AS min_hours, max(n) AS max_hours,
        CAST(sum(date_diff('hour', a, b) + 1 - n) AS BIGINT) AS missing_hours
        FROM (SELECT station_id, count(*) AS n, min(timestamp) AS a, max(timestamp) AS b FROM merged WHERE total_traffic > 0 GROUP BY station_id)"""
    ),
)
def table_summary(spark, folder):
    """The merged facts without their idle hours, which count as missing."""
    return tables.table_summary(base.merged(spark, folder).where("total_traffic > 0"))


@query(
    "rows_per_station",
    sql.hourly("SELECT station_name, count(*) AS n_rows FROM facts GROUP BY station_name"),
)
def rows_per_station(spark, folder):
    return tables.rows_per_station(base.hourly(spark, folder))


_TAG = """log AS (SELECT user_id // 30 AS run,
  CASE WHEN event_type = 'view' AND (user_id // 30) % 3 = 0 THEN 'train_loss_step'
       WHEN event_type = 'click' AND (user_id // 30) % 3 <= 1 THEN 'train_loss_epoch'
       WHEN event_type = 'signup' THEN 'train_loss'
       WHEN event_type = 'purchase' AND (user_id // 30) % 5 <> 4 THEN 'val_loss' ELSE 'lr' END AS tag,
  event_id AS step, value, CAST(floor(epoch_us(ts) / 1e6) AS DOUBLE) AS wall_time FROM events)"""
_RANK = "CASE tag WHEN 'train_loss_step' THEN 1 WHEN 'train_loss_epoch' THEN 2 WHEN 'train_loss' THEN 3 END"


@query(
    "training_scalars_best_tag",
    f"""WITH {_TAG}, best AS (SELECT run, min({_RANK}) AS rk FROM log GROUP BY run)
    SELECT log.run, tag, step, value, wall_time FROM log JOIN best USING (run) WHERE {_RANK} = rk""",
)
def training_scalars_best_tag(spark, folder):
    out = tables.read_scalars(standins.training_scalars(spark, folder))
    return out.select("run", "tag", "step", "value", "wall_time")


_PRESENT = {
    "targets": roles.TARGETS,
    "static_reals": roles.STATIC_REALS,
    "future_reals": [c for c in roles.FUTURE_REALS if not c.endswith(("_sin", "_cos")) and c != "is_shop_open"],
}


@query(
    "roles_present",
    sql.hub(
        " UNION ALL ".join(
            f"SELECT '{r}' AS role, '{c}' AS \"column\", count({c}) AS n_rows FROM hub"
            for r, cols in _PRESENT.items()
            for c in cols
        )
    ),
)
def roles_present(spark, folder):
    """Columns that each role list keeps, and how many rows hold a value in them."""
    hub = base.hub(spark, folder)
    kept, _ = tables.table_checks(hub)
    cells = [
        F.struct(F.lit(r).alias("role"), F.lit(c).alias("column"), F.count(c).alias("n_rows"))
        for r, cols in kept.items()
        for c in cols
    ]
    return hub.agg(F.array(*cells).alias("a")).select(F.inline("a"))
