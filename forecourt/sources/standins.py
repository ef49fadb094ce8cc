"""Station tables derived from the general test tables.

Thirty consecutive customer accounts make one station, so the number of stations
grows with the data while the traffic of one station stays the same. ``hourly_facts``
covers one month by the hour, ``daily_facts`` several years by the day, with a
supplier as station.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt import roles
from forecourt.operators.joins import merge_metadata
from forecourt.operators.series import hourly_spine

ACCOUNTS_PER_STATION = 30

# Range of the event's k that counts as a sale of the target. Summer diesel never sells.
TARGET_RANGES = {
    "sales_AI92": (0, 19),
    "sales_AI95": (20, 39),
    "sales_AI98": (40, 49),
    "sales_DT_EURO": (50, 59),
    "sales_DT_TANEKO": (60, 64),
    "sales_DT_SUMMER": (100, 100),
    "sales_DT_WINTER": (65, 69),
    "shop_drinks": (70, 77),
    "shop_snacks": (78, 83),
    "shop_car_goods": (84, 89),
    "shop_coffee": (90, 95),
    "shop_tobacco": (96, 99),
}
PRICE_OFFSETS = dict(zip(roles.GRADES, (0, 25, 70, 22, 40, 18, 35), strict=True))
EVENT_TYPES = ["view", "click", "signup", "purchase", "error"]
HOLIDAYS = {(1, 1): "new_year", (1, 2): "new_year", (1, 7): "christmas"}
TRAIN_END = "2024-01-24 23:00:00"
VAL_END = "2024-01-27 23:00:00"
TEST_START = "2024-01-28 00:00:00"
TEST_END = "2024-01-30 23:00:00"


_SCHEMAS = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; its footer is read once per process."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def station_of(account: str):
    return F.expr(f"{account} DIV {ACCOUNTS_PER_STATION}")


def cents(amount: str) -> str:
    """An amount with two decimals as whole cents, which add up exactly."""
    return f"CAST(rint({amount} * 100) AS BIGINT)"


_HOUR = "ts - make_dt_interval(0, 0, minute(ts), extract(SECOND FROM ts))"
_NAME = "concat('Station-', lpad(CAST(station_id AS STRING), 6, '0'))"
_HOLIDAY = (
    "CASE "
    + " ".join(
        f"WHEN month(timestamp) = {m} AND dayofmonth(timestamp) = {d} THEN '{text}'"
        for (m, d), text in HOLIDAYS.items()
    )
    + " END"
)
CALENDAR = [
    "hour(timestamp) AS hour",
    "weekday(timestamp) AS day_of_week",
    "weekofyear(timestamp) AS week_of_year",
    "month(timestamp) AS month",
    "quarter(timestamp) AS quarter",
    "CASE WHEN month(timestamp) IN (12, 1, 2) THEN 'winter' WHEN month(timestamp) IN (3, 4, 5) THEN 'spring' "
    "WHEN month(timestamp) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season",
    "date_format(timestamp, 'EEEE') AS day_name",
    "CAST(weekday(timestamp) >= 5 AS INT) AS is_weekend",
    "CAST(hour(timestamp) IN (7, 8, 9, 17, 18, 19) AS INT) AS is_rush_hour",
    "CAST(hour(timestamp) < 6 OR hour(timestamp) >= 22 AS INT) AS is_night",
    f"{_HOLIDAY} AS holiday_name",
    f"CAST(({_HOLIDAY}) IS NOT NULL AS INT) AS is_holiday",
]
# Event behind each kind of traffic; purchases with an odd k count in the total only.
TRAFFIC_EVENTS = [
    "event_type = 'view'",
    "event_type = 'click' AND value < 50",
    "event_type = 'click' AND value >= 50",
    "event_type = 'signup'",
    "event_type = 'error'",
    "event_type = 'purchase' AND k % 2 = 0",
]


def _sum(condition: str, x: str, out: str):
    return F.expr(f"coalesce(sum(CASE WHEN {condition} THEN {x} END) / 100.0D, 0.0D) AS {out}")


def _count(condition: str, out: str):
    return F.expr(f"count(CASE WHEN {condition} THEN 1 END) AS {out}")


def hourly_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly facts of all stations, without gaps.

    The aggregate keeps numbers only, so that it hashes instead of sorting the events.
    """
    events = table(spark, folder, "events").selectExpr(
        f"user_id DIV {ACCOUNTS_PER_STATION} AS station_id",
        f"{_HOUR} AS timestamp",
        "event_id",
        "event_type",
        "value",
        f"{cents('value')} AS cents",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
    )
    types = ", ".join(f"'{t}'" for t in EVENT_TYPES)
    busy = events.groupBy("station_id", "timestamp").agg(
        *[_sum(f"k BETWEEN {lo} AND {hi}", "cents", t) for t, (lo, hi) in TARGET_RANGES.items()],
        *[_count(c, t) for c, t in zip(TRAFFIC_EVENTS, roles.TRAFFIC, strict=True)],
        F.expr("count(1) AS total_traffic"),
        *[F.expr(f"max(CAST(event_id % 10 = {i} AS INT)) AS {p}") for i, p in enumerate(roles.PROMOTIONS)],
        F.expr(
            "min(CASE WHEN event_id % 10 BETWEEN 3 AND 5 "
            f"THEN event_id * 8 + array_position(array({types}), event_type) END) AS advert"
        ),
        F.expr("sum(k) / count(1) AS k_mean"),
        F.expr("min(k) AS k_min"),
        F.expr("max(k) AS k_max"),
    )
    spans = events.groupBy("station_id").agg(
        F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts")
    )
    zero = list(TARGET_RANGES) + roles.TRAFFIC + ["total_traffic"] + roles.PROMOTIONS
    prices = []
    for g, off in PRICE_OFFSETS.items():
        price = f"(480 + (station_id % 7) * 3 + {off}) / 10.0D"
        if g == "DT_TANEKO":
            price = f"CASE WHEN station_id % 4 = 3 THEN 0.0D ELSE {price} END"
        prices.append(f"{price} AS price_{g}")
    return hourly_spine(busy, zero_cols=zero, spans=spans).selectExpr(
        "station_id",
        "timestamp",
        *zero,
        f"get(array({types}), CAST(advert % 8 - 1 AS INT)) AS ad_channel",
        f"{_NAME} AS station_name",
        "k_mean * 0.5D - 20.0D AS temperature",
        "k_min / 10.0D AS precipitation_mm",
        "k_max / 10.0D AS visibility_km",
        "(k_max - k_min) / 10.0D AS wind_speed_ms",
        "CAST(coalesce(k_mean < 30, false) AS INT) AS is_rain",
        "CAST(coalesce(k_mean >= 30 AND k_mean < 40, false) AS INT) AS is_snow",
        "CAST(coalesce(k_mean >= 70 AND k_mean < 80, false) AS INT) AS is_fog",
        "CASE WHEN k_mean < 30 THEN 'rain' WHEN k_mean < 40 THEN 'snow' "
        "WHEN k_mean >= 70 AND k_mean < 80 THEN 'fog' WHEN k_mean IS NOT NULL THEN 'clear' END AS weather_condition",
        "CAST(advert IS NOT NULL AS INT) AS ad_active",
        "50.0D + (k_mean - 50.0D) / 25.0D AS competitor_price_AI92",
        "54.0D + (k_max - 50.0D) / 25.0D AS competitor_price_AI95",
        "52.0D + (k_min - 50.0D) / 25.0D AS competitor_price_DT",
        *prices,
        *CALENDAR,
    )


# Customer segment behind the pump count of the first five grades, in name order.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def passport(spark: SparkSession, folder: str) -> DataFrame:
    """One row of attributes per station, from one pass over the accounts."""
    # nation and region are fixed lists of 25 and 5 rows.
    regions = F.broadcast(table(spark, folder, "region"))
    nations = F.broadcast(table(spark, folder, "nation").select("n_nationkey", "n_regionkey"))
    accounts = table(spark, folder, "customer").join(nations, F.expr("c_nationkey = n_nationkey"))
    conditions = [f"c_mktsegment = '{s}'" for s in SEGMENTS]
    conditions += ["c_nationkey % 2 = 0", "c_nationkey % 3 = 0"]
    stations = accounts.groupBy(station_of("c_custkey").alias("station_id")).agg(
        F.expr("CAST(min(c_custkey * 8 + n_regionkey) % 8 AS INT) AS r_regionkey"),
        F.expr(f"sum({cents('c_acctbal')}) AS cents"),
        F.expr("count(1) AS n"),
        F.expr("CAST(bit_count(bit_or(shiftleft(1L, c_nationkey))) * 10 + 50 AS INT) AS shop_area_m2"),
        F.expr("CAST(bit_count(bit_or(shiftleft(1L, n_regionkey))) AS INT) AS competitors_within_5km"),
        *[_count(c, p) for c, p in zip(conditions, roles.PUMPS, strict=True)],
        *[
            F.expr(f"max(CAST(c_nationkey = {i + 1} AS INT)) AS {s}")
            for i, s in enumerate(roles.SERVICES[:4])
        ],
    )
    most = f"greatest({', '.join(roles.PUMPS[:5])})"
    road = " ".join(
        f"WHEN {p} = {most} THEN '{s}'" for s, p in zip(SEGMENTS, roles.PUMPS, strict=False)
    )
    mark = "pmod(cents, 500)"
    bases = [
        f"({480 + off} + pmod({mark}, 40)) / 10.0D AS base_price_{g}" for g, off in PRICE_OFFSETS.items()
    ]
    return stations.join(regions, "r_regionkey").selectExpr(
        "station_id",
        f"{_NAME} AS station_name",
        f"CASE {road} END AS road_type",
        "r_name AS direction",
        "CASE WHEN cents / n < 400000 THEN 'village' WHEN cents / n < 500000 THEN 'town' ELSE 'city' END AS settlement_size",
        f"{mark} / 10.0D AS distance_to_city_km",
        *[f"CAST({p} AS INT) AS {p}" for p in roles.PUMPS],
        f"CAST({' + '.join(roles.PUMPS)} AS INT) AS total_pumps",
        "shop_area_m2",
        *roles.SERVICES[:4],
        "1 AS has_shop",
        "competitors_within_5km",
        *bases,
        f"50.0D + {mark} / 10.0D AS customer_loyalty_score",
        f"50.0D + pmod({mark} * 3, 500) / 10.0D AS staff_quality_score",
        f"pmod({mark}, 50) / 100.0D AS corporate_customer_ratio",
        f"50.0D + pmod({mark} * 7, 500) / 10.0D AS staff_engagement_score",
    )


def merged(spark: SparkSession, folder: str) -> DataFrame:
    return merge_metadata(hourly_facts(spark, folder), passport(spark, folder))


def daily_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Daily facts over several years; a supplier is a station."""
    flows = zip(("AF", "AO", "NF", "NO", "RF", "RO"), roles.TRAFFIC, strict=True)
    taxes = zip(("7, 8", "5, 6", "0, 1"), roles.PROMOTIONS, strict=True)
    lines = table(spark, folder, "lineitem").selectExpr(
        "l_suppkey AS station_id",
        "l_shipdate AS timestamp",
        "l_linenumber",
        "l_returnflag",
        "l_linestatus",
        f"{cents('l_extendedprice')} AS price",
        f"{cents('l_quantity')} AS amount",
        f"{cents('l_discount')} AS off",
        f"{cents('l_tax')} AS tax",
    )
    days = lines.groupBy("station_id", "timestamp").agg(
        *[_sum(f"l_linenumber = {i + 1}", "price", t) for i, t in enumerate(roles.FUEL_TARGETS)],
        *[_sum(f"off % 5 = {i}", "amount", t) for i, t in enumerate(roles.SHOP_TARGETS)],
        *[_count(f"l_returnflag = '{f[0]}' AND l_linestatus = '{f[1]}'", t) for f, t in flows],
        F.expr("count(1) AS total_traffic"),
        *[F.expr(f"max(CAST(tax IN ({v}) AS INT)) AS {p}") for v, p in taxes],
    )
    places = (
        table(spark, folder, "nation")
        .join(F.broadcast(table(spark, folder, "region")), F.expr("n_regionkey = r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    stations = (
        table(spark, folder, "supplier")
        .join(F.broadcast(places), F.expr("s_nationkey = n_nationkey"))
        .selectExpr(
            "s_suppkey AS station_id",
            "s_name AS station_name",
            "r_name AS road_type",
            "n_name AS settlement_size",
            "CAST(s_nationkey % 3 AS STRING) AS direction",
            f"{cents('s_acctbal')} / 10000.0D AS distance_to_city_km",
        )
    )
    return days.join(stations, "station_id", "left").selectExpr("*", *CALENDAR)


def training_scalars(spark: SparkSession, folder: str) -> DataFrame:
    """A training log: runs lack the finer loss tags in turn."""
    run = station_of("user_id")
    kind = F.col("event_type")
    tag = (
        F.when((kind == "view") & (run % 3 == 0), "train_loss_step")
        .when((kind == "click") & (run % 3 <= 1), "train_loss_epoch")
        .when(kind == "signup", "train_loss")
        .when((kind == "purchase") & (run % 5 != 4), "val_loss")
        .otherwise("lr")
    )
    return table(spark, folder, "events").select(
        run.alias("run"),
        tag.alias("tag"),
        F.col("event_id").alias("step"),
        F.col("value"),
        F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("wall_micros"),
    ).withColumn("wall_time", F.floor(F.col("wall_micros") / 1e6).cast("double")).drop("wall_micros")
