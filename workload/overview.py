"""Queries of the sales overview and the station comparison."""

from pyspark.sql import functions as F

from forecourt import roles
from forecourt.functions import labels
from forecourt.operators import overview as o
from workload import base, sql
from workload.registry import query, rounded


def unpivot(source, cols, var, val):
    return f"{source} UNPIVOT ({val} FOR {var} IN ({', '.join(cols)}))"


@query(
    "kpis",
    sql.daily(
        f"""SELECT {sql.r('sum(total_sales)', 'fuel_total', 2)}, {sql.r('sum(total_shop_sales)', 'shop_total', 2)},
        {sql.r('avg(total_traffic)', 'mean_traffic', 2)}, count(DISTINCT station_name) AS n_stations,
        (SELECT month FROM daily GROUP BY month ORDER BY sum(total_sales) DESC, month LIMIT 1) AS peak_month FROM daily"""
    ),
)
def kpis(spark, folder):
    return rounded(o.kpis(base.daily(spark, folder)), 2)


@query(
    "monthly_sales",
    sql.daily(
        f"""SELECT month, {sql.r('s', 'total_sales', 2)}, CAST(month = first_value(month) OVER (ORDER BY s DESC, month) AS INTEGER) AS is_peak,
        {sql.case_label('month', labels.MONTH_SHORT)} AS label FROM (SELECT month, sum(total_sales) AS s FROM daily GROUP BY month)"""
    ),
)
def monthly_sales(spark, folder):
    return rounded(o.monthly_sales(base.daily(spark, folder)), 2)


def _mix(cols, how, names):
    parts = unpivot(f"(SELECT {', '.join(f'CAST({how}({c}) AS DOUBLE) AS {c}' for c in cols)} FROM daily)", cols, "target", "value")
    return sql.daily(
        f"SELECT target, {sql.r('value', 'value', 2)}, {sql.r('value / sum(value) OVER ()', 'share')}, "
        f"{sql.case_label('target', names)} AS label FROM {parts}"
    )


@query("fuel_mix", _mix(roles.FUEL_TARGETS, "sum", labels.FUEL))
def fuel_mix(spark, folder):
    out = o.fuel_mix(base.daily(spark, folder))
    return out.withColumns({"value": F.round("value", 2), "share": F.round("share", 6)})


@query("shop_mix", _mix(roles.SHOP_TARGETS, "avg", labels.SHOP))
def shop_mix(spark, folder):
    out = o.shop_mix(base.daily(spark, folder))
    return out.withColumns({"value": F.round("value", 2), "share": F.round("share", 6)})


def _grouped_long(key, alias, cols, how, var, val, names, table="daily", digits=6):
    inner = f"(SELECT {key} AS {alias}, {', '.join(f'CAST({how}({c}) AS DOUBLE) AS {c}' for c in cols)} FROM {table} GROUP BY 1)"
    make = sql.daily if table == "daily" else sql.hub
    return make(
        f"SELECT {alias}, {var}, {sql.r(val, val, digits)}, {sql.case_label(var, names)} AS label FROM {unpivot(inner, cols, var, val)}"
    )


@query(
    "shop_by_station",
    _grouped_long("station_name", "station_name", roles.SHOP_TARGETS, "sum", "category", "revenue", labels.SHOP),
)
def shop_by_station(spark, folder):
    return rounded(o.shop_by_station(base.daily(spark, folder)))


@query(
    "fuel_by_station",
    _grouped_long("station_name", "station_name", roles.FUEL_TARGETS, "sum", "fuel", "sales", labels.FUEL, digits=2),
)
def fuel_by_station(spark, folder):
    return rounded(o.fuel_by_station(base.daily(spark, folder)), 2)


@query(
    "sales_by_station",
    sql.daily(f"SELECT station_name, {sql.r('sum(total_sales)', 'total_sales', 2)} FROM daily GROUP BY station_name"),
)
def sales_by_station(spark, folder):
    return rounded(o.sales_by_station(base.daily(spark, folder)), 2)


@query(
    "traffic_by_month",
    sql.daily(
        f"SELECT month, {', '.join(sql.r(f'avg({c})', c) for c in roles.TRAFFIC)} FROM daily GROUP BY month"
    ),
)
def traffic_by_month(spark, folder):
    return rounded(o.traffic_by_month(base.daily(spark, folder)))


@query(
    "shop_by_hour",
    _grouped_long("hour", "hour", roles.SHOP_TARGETS, "avg", "category", "revenue", labels.SHOP, "hub", 9),
)
def shop_by_hour(spark, folder):
    return rounded(o.shop_by_hour(base.hub(spark, folder)), 9)


@query(
    "hour_profile",
    sql.hub(
        f"""SELECT hour, {sql.r('s', 'total_sales', 9)}, CAST(hour = first_value(hour) OVER (ORDER BY s DESC, hour) AS INTEGER) AS is_peak
        FROM (SELECT hour, avg(total_sales) AS s FROM hub GROUP BY hour)"""
    ),
)
def hour_profile(spark, folder):
    return rounded(o.hour_profile(base.hub(spark, folder)), 9)


@query(
    "weekday_profile",
    sql.hub(
        f"""SELECT day_of_week AS weekday, {sql.r('avg(total_sales)', 'total_sales', 9)},
        {sql.case_label('day_of_week', labels.WEEKDAY)} AS label FROM hub GROUP BY day_of_week"""
    ),
)
def weekday_profile(spark, folder):
    return rounded(o.dow_profile(base.hub(spark, folder)), 9)


def _season(where, digits):
    return f"""SELECT CAST(p.position AS INTEGER) AS position, p.season, {sql.r('s', 'total_sales', digits)}, {sql.case_label('p.season', labels.SEASON)} AS label
    FROM (VALUES (0, 'winter'), (1, 'spring'), (2, 'summer'), (3, 'autumn')) p(position, season)
    LEFT JOIN (SELECT season, avg(total_sales) AS s FROM {where} GROUP BY season) USING (season)"""


@query("season_profile", sql.daily(_season("daily", 4)))
def season_profile(spark, folder):
    return rounded(o.season_profile(base.daily(spark, folder)), 4)


@query("season_profile_one_season", sql.hub(_season("hub", 9)))
def season_profile_one_season(spark, folder):
    """The hourly data covers winter only; the other seasons stay, without a value."""
    return rounded(o.season_profile(base.hub(spark, folder)), 9)


@query(
    "hour_dow_heatmap",
    sql.hub(
        f"""SELECT hour, day_of_week AS weekday, {sql.r('avg(sales_AI92)', 'sales', 9)},
        {sql.case_label('day_of_week', labels.WEEKDAY)} AS label FROM hub GROUP BY hour, day_of_week"""
    ),
)
def hour_dow_heatmap(spark, folder):
    return rounded(o.hour_dow_heatmap(base.hub(spark, folder), "sales_AI92"), 9)


@query(
    "hour_dow_pivot",
    sql.hub(
        "SELECT hour, "
        + ", ".join(sql.r(f"avg(CASE WHEN day_of_week = {d} THEN sales_AI95 END)", f"day_{d}", 9) for d in range(7))
        + " FROM hub GROUP BY hour"
    ),
)
def hour_dow_pivot(spark, folder):
    return rounded(o.hour_dow_pivot(base.hub(spark, folder), "sales_AI95"), 9)


def flag_sql(flags, names, source="hub", zero=False, drop_null=False):
    parts = []
    for f in flags:
        for v in (0, 1):
            mean = f"avg(CASE WHEN {f} = {v} THEN total_sales END)"
            mean = f"coalesce({mean}, 0)" if zero else mean
            text = names[f][v] if isinstance(names[f], dict) else names[f]
            parts.append(f"SELECT '{f}' AS flag, {v} AS active, {sql.r(mean, 'mean_sales', 9)}, '{text}' AS label FROM {source}")
    body = " UNION ALL ".join(parts)
    return f"SELECT * FROM ({body}) WHERE mean_sales IS NOT NULL" if drop_null else body


@query("promo_effect", sql.hub(flag_sql(roles.PROMOTIONS, labels.PROMOTION, zero=True)))
def promo_effect(spark, folder):
    return rounded(o.promo_effect(base.hub(spark, folder)), 9)


@query(
    "weekly_by_station",
    sql.daily(
        f"""SELECT week_of_year AS week, station_name, {sql.r('sum(total_sales)', 'total_sales', 2)}
        FROM daily GROUP BY week_of_year, station_name"""
    ),
)
def weekly_by_station(spark, folder):
    return rounded(o.weekly_by_station(base.daily(spark, folder)), 2)


@query(
    "by_road_type",
    sql.daily(f"SELECT road_type, {sql.r('avg(total_sales)', 'total_sales', 4)} FROM daily GROUP BY road_type"),
)
def by_road_type(spark, folder):
    return rounded(o.by_road_type(base.daily(spark, folder)), 4)


@query(
    "by_settlement",
    sql.daily(f"SELECT settlement_size, {sql.r('avg(total_sales)', 'total_sales', 4)} FROM daily GROUP BY settlement_size"),
)
def by_settlement(spark, folder):
    return rounded(o.by_settlement(base.daily(spark, folder)), 4)


@query(
    "station_profile",
    sql.hub(
        f"SELECT station_name, {sql.r('avg(total_sales)', 'avg_sales', 9)}, "
        + ", ".join(f"arg_min({c}, timestamp) AS {c}" for c in roles.PROFILE_ATTRIBUTES)
        + " FROM hub GROUP BY station_name"
    ),
)
def station_profile(spark, folder):
    return rounded(o.station_profile(base.hub(spark, folder)), 9)


@query(
    "station_competitors",
    sql.hub("SELECT station_name, min(competitors_within_5km) AS competitors_within_5km FROM hub GROUP BY station_name"),
)
def station_competitors(spark, folder):
    return o.station_competitors(o.station_profile(base.hub(spark, folder)))


@query(
    "station_scores",
    sql.hub(
        f"SELECT station_name, metric, value, {sql.case_label('metric', labels.SCORE)} AS label FROM "
        + unpivot(
            f"(SELECT station_name, {', '.join(f'min({c}) AS {c}' for c in roles.SCORES)} FROM hub GROUP BY station_name)",
            roles.SCORES, "metric", "value",
        )
    ),
)
def station_scores(spark, folder):
    return o.station_scores(o.station_profile(base.hub(spark, folder)))


@query(
    "service_matrix",
    sql.hub(f"SELECT station_name, {', '.join(f'max({c}) AS {c}' for c in roles.SERVICES)} FROM hub GROUP BY station_name"),
)
def service_matrix(spark, folder):
    return o.service_matrix(base.hub(spark, folder))
