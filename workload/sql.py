"""DuckDB text of the stand-in tables and small helpers for the oracle queries."""

from forecourt import roles
from forecourt.sources import standins as s

ACC = s.ACCOUNTS_PER_STATION


def _k(lo, hi):
    return f"k BETWEEN {lo} AND {hi}"


def r(expr, alias, digits=6):
    return f"round(CAST({expr} AS DOUBLE), {digits}) AS {alias}"


def null_nan(expr):
    """NaN of an undefined correlation or skewness as NULL."""
    return f"(CASE WHEN isnan({expr}) THEN NULL ELSE {expr} END)"


def corr(x, y):
    return null_nan(f"corr(CAST({y} AS DOUBLE), CAST({x} AS DOUBLE))")


def total(cols):
    return "(" + " + ".join(f"coalesce(CAST({c} AS DOUBLE), 0)" for c in cols) + ")"


def case_label(col, mapping):
    whens = " ".join(
        f"WHEN {k!r} THEN '{v}'" if isinstance(k, str) else f"WHEN {k} THEN '{v}'"
        for k, v in mapping.items()
    )
    return f"(CASE {col} {whens} ELSE CAST({col} AS VARCHAR) END)"


_HOLIDAY = "CASE " + " ".join(
    f"WHEN month(timestamp) = {m} AND day(timestamp) = {d} THEN '{t}'"
    for (m, d), t in s.HOLIDAYS.items()
) + " END"

_CALENDAR = f"""
  CAST(hour(timestamp) AS INTEGER) AS hour,
  CAST(isodow(timestamp) - 1 AS INTEGER) AS day_of_week,
  CAST(weekofyear(timestamp) AS INTEGER) AS week_of_year,
  CAST(month(timestamp) AS INTEGER) AS month,
  CAST(quarter(timestamp) AS INTEGER) AS quarter,
  CASE WHEN month(timestamp) IN (12, 1, 2) THEN 'winter' WHEN month(timestamp) IN (3, 4, 5) THEN 'spring'
       WHEN month(timestamp) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
  dayname(timestamp) AS day_name,
  CAST(isodow(timestamp) >= 6 AS INTEGER) AS is_weekend,
  CAST(hour(timestamp) IN (7, 8, 9, 17, 18, 19) AS INTEGER) AS is_rush_hour,
  CAST(hour(timestamp) < 6 OR hour(timestamp) >= 22 AS INTEGER) AS is_night,
  {_HOLIDAY} AS holiday_name,
  CAST(({_HOLIDAY}) IS NOT NULL AS INTEGER) AS is_holiday
"""

_SALES = ",\n  ".join(
    f"coalesce(CAST(sum(CASE WHEN {_k(lo, hi)} THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE), 0) AS {t}"
    for t, (lo, hi) in s.TARGET_RANGES.items()
)
_TRAFFIC = dict(
    zip(
        roles.TRAFFIC,
        (
            "event_type = 'view'",
            "event_type = 'click' AND value < 50",
            "event_type = 'click' AND value >= 50",
            "event_type = 'signup'",
            "event_type = 'error'",
            "event_type = 'purchase' AND k % 2 = 0",
        ),
        strict=True,
    )
)
_ZERO = list(s.TARGET_RANGES) + roles.TRAFFIC + ["total_traffic"] + roles.PROMOTIONS
_PRICES = ",\n  ".join(
    (f"CASE WHEN station_id % 4 = 3 THEN 0.0 ELSE (480 + (station_id % 7) * 3 + {off}) / 10.0::DOUBLE END"
     if g == "DT_TANEKO" else f"(480 + (station_id % 7) * 3 + {off}) / 10.0::DOUBLE") + f" AS price_{g}"
    for g, off in s.PRICE_OFFSETS.items()
)

HOURLY = f"""
ev AS (
  SELECT user_id // {ACC} AS station_id, date_trunc('hour', ts) AS timestamp, event_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
busy AS (
  SELECT station_id, timestamp,
  {_SALES},
  {", ".join(f"count(CASE WHEN {c} THEN 1 END) AS {t}" for t, c in _TRAFFIC.items())},
  count(*) AS total_traffic,
  {", ".join(f"max(CAST(event_id % 10 = {i} AS INTEGER)) AS {p}" for i, p in enumerate(roles.PROMOTIONS))},
  arg_min(event_type, CASE WHEN event_id % 10 BETWEEN 3 AND 5 THEN event_id END) AS ad_channel,
  CAST(sum(k) AS DOUBLE) / count(*) AS k_mean, min(k) AS k_min, max(k) AS k_max
  FROM ev GROUP BY ALL),
spine AS (
  SELECT station_id, unnest(generate_series(min(timestamp), max(timestamp), INTERVAL 1 HOUR)) AS timestamp
  FROM ev GROUP BY station_id),
facts AS (
  SELECT station_id, timestamp,
  {", ".join(f"coalesce({c}, 0) AS {c}" for c in _ZERO)},
  ad_channel,
  'Station-' || lpad(CAST(station_id AS VARCHAR), 6, '0') AS station_name,
  k_mean * 0.5::DOUBLE - 20.0::DOUBLE AS temperature,
  k_min / 10.0::DOUBLE AS precipitation_mm, k_max / 10.0::DOUBLE AS visibility_km,
  (k_max - k_min) / 10.0::DOUBLE AS wind_speed_ms,
  CAST(coalesce(k_mean < 30, FALSE) AS INTEGER) AS is_rain,
  CAST(coalesce(k_mean >= 30 AND k_mean < 40, FALSE) AS INTEGER) AS is_snow,
  CAST(coalesce(k_mean >= 70 AND k_mean < 80, FALSE) AS INTEGER) AS is_fog,
  CASE WHEN k_mean < 30 THEN 'rain' WHEN k_mean < 40 THEN 'snow' WHEN k_mean >= 70 AND k_mean < 80 THEN 'fog'
       WHEN k_mean IS NOT NULL THEN 'clear' END AS weather_condition,
  CAST(ad_channel IS NOT NULL AS INTEGER) AS ad_active,
  50.0::DOUBLE + (k_mean - 50.0::DOUBLE) / 25.0::DOUBLE AS competitor_price_AI92,
  54.0::DOUBLE + (k_max - 50.0::DOUBLE) / 25.0::DOUBLE AS competitor_price_AI95,
  52.0::DOUBLE + (k_min - 50.0::DOUBLE) / 25.0::DOUBLE AS competitor_price_DT,
  {_PRICES},
  {_CALENDAR}
  FROM spine LEFT JOIN busy USING (station_id, timestamp))
"""

_PUMPS = [f"count(CASE WHEN c_mktsegment = '{g}' THEN 1 END)" for g in s.SEGMENTS] + [
    "count(CASE WHEN c_nationkey % 2 = 0 THEN 1 END)",
    "count(CASE WHEN c_nationkey % 3 = 0 THEN 1 END)",
]
_BASE = ",\n  ".join(
    f"(480 + {off} + m % 40) / 10.0::DOUBLE AS base_price_{g}" for g, off in s.PRICE_OFFSETS.items()
)
PASSPORT = f"""
acc AS (
  SELECT c_custkey // {ACC} AS station_id, c_custkey, c_mktsegment, c_nationkey, n_regionkey, r_name,
         CAST(round(c_acctbal * 100) AS BIGINT) AS cents
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
road AS (
  SELECT station_id, c_mktsegment AS road_type FROM (
    SELECT station_id, c_mktsegment, row_number() OVER (PARTITION BY station_id ORDER BY count(*) DESC, c_mktsegment) AS rn
    FROM acc GROUP BY station_id, c_mktsegment) WHERE rn = 1),
st AS (
  SELECT station_id, arg_min(r_name, c_custkey) AS direction, CAST(sum(cents) AS BIGINT) AS cents, count(*) AS n,
  CAST(count(DISTINCT c_nationkey) * 10 + 50 AS INTEGER) AS shop_area_m2,
  CAST(count(DISTINCT n_regionkey) AS INTEGER) AS competitors_within_5km,
  {", ".join(f"CAST({e} AS INTEGER) AS {p}" for e, p in zip(_PUMPS, roles.PUMPS, strict=True))},
  {", ".join(f"max(CAST(c_nationkey = {i + 1} AS INTEGER)) AS {v}" for i, v in enumerate(roles.SERVICES[:4]))}
  FROM acc GROUP BY station_id),
marks AS (SELECT *, ((cents % 500) + 500) % 500 AS m FROM st),
passport AS (
  SELECT station_id, 'Station-' || lpad(CAST(station_id AS VARCHAR), 6, '0') AS station_name, road_type, direction,
  CASE WHEN cents / n < 400000 THEN 'village' WHEN cents / n < 500000 THEN 'town' ELSE 'city' END AS settlement_size,
  m / 10.0::DOUBLE AS distance_to_city_km, {", ".join(roles.PUMPS)},
  {" + ".join(roles.PUMPS)} AS total_pumps, shop_area_m2, {", ".join(roles.SERVICES[:4])}, 1 AS has_shop,
  competitors_within_5km,
  {_BASE},
  50.0::DOUBLE + m / 10.0::DOUBLE AS customer_loyalty_score,
  50.0::DOUBLE + (m * 3 % 500) / 10.0::DOUBLE AS staff_quality_score,
  (m % 50) / 100.0::DOUBLE AS corporate_customer_ratio,
  50.0::DOUBLE + (m * 7 % 500) / 10.0::DOUBLE AS staff_engagement_score
  FROM marks JOIN road USING (station_id))
"""
EXTRA = [
    "road_type", "direction", "settlement_size", "distance_to_city_km", *roles.PUMPS, "total_pumps",
    "shop_area_m2", *roles.SERVICES, "competitors_within_5km", *roles.BASE_PRICES,
    "customer_loyalty_score", "staff_quality_score", "corporate_customer_ratio", "staff_engagement_score",
]
#: Columns of the merged table in order, with their types.
MERGED_TYPES = (
    {"station_id": "bigint", "timestamp": "timestamp_ntz"}
    | dict.fromkeys(s.TARGET_RANGES, "double")
    | dict.fromkeys([*roles.TRAFFIC, "total_traffic"], "bigint")
    | dict.fromkeys(roles.PROMOTIONS, "int")
    | dict.fromkeys(["ad_channel", "station_name"], "string")
    | dict.fromkeys(["temperature", "precipitation_mm", "visibility_km", "wind_speed_ms"], "double")
    | dict.fromkeys(["is_rain", "is_snow", "is_fog"], "int")
    | {"weather_condition": "string", "ad_active": "int"}
    | dict.fromkeys([*roles.RIVAL_PRICES, *(f"price_{g}" for g in s.PRICE_OFFSETS)], "double")
    | dict.fromkeys(["hour", "day_of_week", "week_of_year", "month", "quarter"], "int")
    | dict.fromkeys(["season", "day_name"], "string")
    | dict.fromkeys(["is_weekend", "is_rush_hour", "is_night"], "int")
    | {"holiday_name": "string", "is_holiday": "int"}
    | dict.fromkeys(["road_type", "direction", "settlement_size"], "string")
    | {"distance_to_city_km": "double"}
    | dict.fromkeys([*roles.PUMPS, "total_pumps", "shop_area_m2", *roles.SERVICES, "competitors_within_5km"], "int")
    | dict.fromkeys([*roles.BASE_PRICES, "customer_loyalty_score", "staff_quality_score", "corporate_customer_ratio", "staff_engagement_score"], "double")
)
NUMERIC = [c for c, t in MERGED_TYPES.items() if t in ("double", "bigint", "int")]
MERGED = (
    HOURLY + "," + PASSPORT
    + f", merged AS (SELECT f.*, {', '.join('p.' + c for c in EXTRA)} FROM facts f LEFT JOIN passport p USING (station_id))"
)

_TOTALS = f"""{total(roles.FUEL_TARGETS)} AS total_sales, {total(roles.SHOP_TARGETS)} AS total_shop_sales"""
_RATIO = ", ".join(
    f"CASE WHEN {own[0]} <> 0 THEN {rival} / {own[0]} END AS {out}"
    for out, (rival, own) in roles.PRICE_RATIOS.items()
)


def _hub(source):
    ratios = f", {_RATIO}" if source == "merged" else ""
    fill = (
        f"* REPLACE (coalesce(holiday_name, '{roles.NO_HOLIDAY}') AS holiday_name, "
        f"coalesce(ad_channel, '{roles.NO_ADVERT}') AS ad_channel)"
        if source == "merged"
        else f"* REPLACE (coalesce(holiday_name, '{roles.NO_HOLIDAY}') AS holiday_name)"
    )
    return f"""SELECT {fill}, {total(roles.FUEL_TARGETS)} AS total_fuel_sales,
    {total(roles.SHOP_TARGETS)} AS shop_total_revenue{ratios}, {_TOTALS} FROM {source}"""


HUB = MERGED + f", hub AS ({_hub('merged')})"

_FLOWS = dict(zip(roles.TRAFFIC, ("AF", "AO", "NF", "NO", "RF", "RO"), strict=True))
_TAX = dict(zip(roles.PROMOTIONS, ("7, 8", "5, 6", "0, 1"), strict=True))
DAILY_FACTS = f"""
days AS (
  SELECT l_suppkey AS station_id, l_shipdate AS timestamp,
  {", ".join(f"coalesce(CAST(sum(CASE WHEN l_linenumber = {i + 1} THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE), 0) AS {t}" for i, t in enumerate(roles.FUEL_TARGETS))},
  {", ".join(f"coalesce(CAST(sum(CASE WHEN CAST(round(l_discount * 100) AS INTEGER) % 5 = {i} THEN CAST(l_quantity AS DECIMAL(18,2)) END) AS DOUBLE), 0) AS {t}" for i, t in enumerate(roles.SHOP_TARGETS))},
  {", ".join(f"count(CASE WHEN l_returnflag || l_linestatus = '{c}' THEN 1 END) AS {t}" for t, c in _FLOWS.items())},
  count(*) AS total_traffic,
  {", ".join(f"max(CAST(CAST(round(l_tax * 100) AS INTEGER) IN ({v}) AS INTEGER)) AS {p}" for p, v in _TAX.items())}
  FROM lineitem GROUP BY ALL),
daily_facts AS (
  SELECT days.*, s_name AS station_name, r_name AS road_type, n_name AS settlement_size,
  CAST(s_nationkey % 3 AS VARCHAR) AS direction,
  CAST(round(s_acctbal * 100) AS BIGINT) / 10000.0::DOUBLE AS distance_to_city_km,
  {_CALENDAR}
  FROM days LEFT JOIN (supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
  ON station_id = s_suppkey)
"""
DAILY = DAILY_FACTS + f", daily AS ({_hub('daily_facts')})"


def hourly(body):
    return f"WITH {HOURLY} {body}"


def merged(body):
    return f"WITH {MERGED} {body}"


def hub(body, extra=""):
    return f"WITH {HUB}{extra} {body}"


def daily(body, extra=""):
    return f"WITH {DAILY}{extra} {body}"
