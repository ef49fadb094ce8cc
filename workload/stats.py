"""Queries over correlations, trends and distributions."""

from forecourt import roles
from forecourt.operators import stats as st
from forecourt.sources import scratch
from workload import base, sql
from workload.registry import query, rounded

SMALL = ["sales_AI92", "sales_AI95", "sales_DT_SUMMER", "temperature", "total_traffic", "ad_active", "is_weekend", "is_holiday"]


def matrix_sql(cols, source="hub", make=sql.hub, digits=4):
    rows = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            value = sql.corr(a, b)
            rows.append((a, b, f"round({value}, {digits})"))
            if a != b:
                rows.append((b, a, f"round({value}, {digits})"))
    wide = ", ".join(f"{e} AS v{i}" for i, (_, _, e) in enumerate(rows))
    pick = " UNION ALL ".join(
        f"SELECT '{a}' AS row_name, '{b}' AS col_name, v{i} AS r FROM wide" for i, (a, b, _) in enumerate(rows)
    )
    return make(pick, f", wide AS (SELECT {wide} FROM {source})")


def block_sql(rows, cols, digits=6, source="hub", make=sql.hub):
    cells = [(a, b) for a in rows for b in cols]
    wide = ", ".join(f"round({sql.corr(a, b)}, {digits}) AS v{i}" for i, (a, b) in enumerate(cells))
    pick = " UNION ALL ".join(
        f"SELECT '{a}' AS row_name, '{b}' AS col_name, v{i} AS r FROM wide" for i, (a, b) in enumerate(cells)
    )
    return make(pick, f", wide AS (SELECT {wide} FROM {source})")


@query("corr_matrix", matrix_sql(roles.FUEL_TARGETS + roles.FACTORS))
def corr_matrix(spark, folder):
    """All fuels and factors, pairwise complete: 24 columns."""
    return st.corr_matrix(base.hub_table(spark, folder), roles.FUEL_TARGETS + roles.FACTORS, 4)


_DAILY = ["sales_AI92", "sales_AI95", "shop_coffee", "total_traffic", "distance_to_city_km", "promotion_fuel_active", "is_weekend", "month"]


@query("corr_matrix_daily", matrix_sql(_DAILY, "daily", sql.daily))
def corr_matrix_daily(spark, folder):
    return st.corr_matrix(base.daily_table(spark, folder), _DAILY, 4)


@query("corr_traffic_fuels", block_sql(roles.TRAFFIC, roles.FUEL_TARGETS))
def corr_traffic_fuels(spark, folder):
    return rounded(st.corr_block(base.hub(spark, folder), roles.TRAFFIC, roles.FUEL_TARGETS))


def rank_sql(factors, target, limit=""):
    cells = ", ".join(f"abs({sql.corr(f, target)}) AS v{i}" for i, f in enumerate(factors))
    pick = " UNION ALL ".join(f"SELECT '{f}' AS factor, round(v{i}, 6) AS strength FROM wide" for i, f in enumerate(factors))
    return sql.hub(f"SELECT * FROM ({pick}) {limit}", f", wide AS (SELECT {cells} FROM hub)")


@query("factors_ranked", rank_sql(roles.FACTORS, "total_sales"))
def factors_ranked(spark, folder):
    return rounded(st.rank_factors(base.hub(spark, folder), roles.FACTORS))


def _group_columns(group):
    return list(dict.fromkeys(roles.FUEL_TARGETS + roles.FACTOR_GROUPS[group]))


def _add_group(group):
    @query(f"corr_group_{group}", matrix_sql(_group_columns(group), digits=2))
    def run(spark, folder):
        return st.group_corr(base.hub(spark, folder), group)


for _name in roles.FACTOR_GROUPS:
    _add_group(_name)


@query(
    "top_factors",
    rank_sql(roles.FACTOR_GROUPS["weather"], "sales_AI92", "ORDER BY strength DESC NULLS LAST, factor LIMIT 5"),
)
def top_factors(spark, folder):
    return rounded(st.top_factors(base.hub(spark, folder), "sales_AI92", "weather"))


def trend_sql(pairs, source="hub", make=sql.hub, digits=6):
    out = []
    for x, y in pairs:
        both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
        m, b = f"regr_slope({y}, {x})", f"regr_intercept({y}, {x})"
        m, b = sql.null_nan(m), sql.null_nan(b)
        lo, hi = f"min(CAST({x} AS DOUBLE))", f"max(CAST({x} AS DOUBLE))"

        def guard(e):
            return f"CASE WHEN count(*) >= 5 THEN {e} END"

        out.append(
            f"""SELECT '{x}' AS x_name, '{y}' AS y_name, count(*) AS n, {sql.r(guard(m), 'slope', digits)},
            {sql.r(guard(b), 'intercept', digits)}, {sql.r(guard(sql.corr(x, y)), 'r', digits)}, {sql.r(guard(lo), 'x_from', digits)},
            {sql.r(guard(hi), 'x_to', digits)}, {sql.r(guard(f'{b} + {m} * {lo}'), 'y_from', digits)},
            {sql.r(guard(f'{b} + {m} * {hi}'), 'y_to', digits)} FROM {source} WHERE {both}"""
        )
    return make(" UNION ALL ".join(out))


TREND_PAIRS = [
    (x, "total_sales")
    for x in ("temperature", "total_traffic", "traffic_Passengers_cars", "precipitation_mm", "visibility_km", "wind_speed_ms")
]


@query("trends", trend_sql(TREND_PAIRS))
def trends(spark, folder):
    return rounded(st.trends(base.hub(spark, folder), TREND_PAIRS))


@query(
    "truck_diesel_trend",
    trend_sql([("trucks", "sales_DT_EURO")], "with_trucks", lambda body: sql.hub(body, f", with_trucks AS (SELECT *, {sql.total(roles.TRUCKS)} AS trucks FROM hub)")),
)
def truck_diesel_trend(spark, folder):
    from forecourt.operators.features import with_row_sum

    hub = with_row_sum(base.hub(spark, folder), "trucks", roles.TRUCKS)
    return rounded(st.trends(hub, [("trucks", "sales_DT_EURO")]))


@query("price_ratio_trend", trend_sql([("comp_ratio_AI92", "sales_AI92"), ("comp_ratio_AI95", "sales_AI95"), ("comp_ratio_DT", "sales_DT_EURO")]))
def price_ratio_trend(spark, folder):
    return rounded(st.price_ratio_trend(base.hub(spark, folder)))


@query(
    "scatter_sample",
    sql.hub(
        f"""SELECT station_id, timestamp, {sql.r('temperature', 'temperature')}, {sql.r('total_sales', 'total_sales')} FROM hub
        ORDER BY md5(CAST(station_id AS VARCHAR) || '|' || strftime(timestamp, '%Y-%m-%d %H:%M:%S') || '|42'), station_id, timestamp LIMIT 3000"""
    ),
)
def scatter_sample(spark, folder):
    hub = base.hub(spark, folder).select("station_id", "timestamp", "temperature", "total_sales")
    return rounded(st.scatter_sample(hub, 3000, 42))


def skew_sql(targets, source, make):
    return make(
        " UNION ALL ".join(
            f"""SELECT '{t}' AS target, {sql.r(f'min({t})', 'low', 4)}, {sql.r(f'max({t})', 'high', 4)},
            {sql.r(sql.null_nan(f'skewness({t})'), 'skew_raw', 4)}, {sql.r(sql.null_nan(f'skewness(ln(1 + {t}))'), 'skew_log', 4)} FROM {source}"""
            for t in targets
        )
    )


@query("skewness", skew_sql(roles.TARGETS, "facts", sql.hourly))
def skewness(spark, folder):
    return rounded(st.skew_table(base.hourly(spark, folder), roles.TARGETS), 4)


@query("skewness_daily", skew_sql(roles.TARGETS, "daily", sql.daily))
def skewness_daily(spark, folder):
    return rounded(st.skew_table(base.daily(spark, folder), roles.TARGETS), 4)


def hist_sql(x, bins, source, make, digits=6):
    return make(
        f"""SELECT bin, {sql.r(f'lo + bin * ((hi - lo) / {bins})', 'bin_from', digits)}, {sql.r(f'lo + (bin + 1) * ((hi - lo) / {bins})', 'bin_to', digits)}, count(*) AS n_rows
        FROM (SELECT coalesce(least(CAST(floor(CASE WHEN hi <> lo THEN (x - lo) * {bins} / (hi - lo) END) AS INTEGER), {bins - 1}), 0) AS bin, lo, hi
          FROM (SELECT {x} AS x FROM {source} WHERE {x} IS NOT NULL), (SELECT min({x}) AS lo, max({x}) AS hi FROM {source}))
        GROUP BY bin, lo, hi"""
    )


@query("histogram_raw", hist_sql("total_sales", 60, "hub", sql.hub))
def histogram_raw(spark, folder):
    return rounded(st.histogram(base.hub(spark, folder), "total_sales", 60))


@query("histogram_log", hist_sql("ln(1 + total_sales)", 60, "daily", sql.daily))
def histogram_log(spark, folder):
    from pyspark.sql import functions as F

    logs = base.daily(spark, folder).select(F.log1p("total_sales").alias("y"))
    return rounded(st.histogram(logs, "y", 60))


@query("histogram_error", hist_sql("sales_AI95 - sales_AI92", 50, "facts", sql.hourly))
def histogram_error(spark, folder):
    from forecourt.operators.features import with_error

    errors = with_error(base.hourly(spark, folder), "sales_AI95", "sales_AI92").select("error")
    return rounded(st.histogram(errors, "error", 50))


@query(
    "histogram_prices",
    hist_sql("CAST(l_extendedprice AS DOUBLE)", 60, "lineitem", lambda body: body),
)
def histogram_prices(spark, folder):
    from forecourt.sources import standins

    return rounded(st.histogram(standins.table(spark, folder, "lineitem"), "l_extendedprice", 60))


def box_sql(column, by, source, make, digits=6):
    return make(
        f"""SELECT d.{by}, {sql.r('q1', 'q1', digits)}, {sql.r('med', 'median', digits)}, {sql.r('q3', 'q3', digits)},
        {sql.r(f'min(CASE WHEN {column} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN {column} END)', 'whisker_low', digits)},
        {sql.r(f'max(CASE WHEN {column} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN {column} END)', 'whisker_high', digits)},
        count(CASE WHEN {column} < q1 - 1.5 * (q3 - q1) OR {column} > q3 + 1.5 * (q3 - q1) THEN 1 END) AS n_outliers
        FROM {source} d JOIN (SELECT {by}, quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.5) AS med, quantile_cont({column}, 0.75) AS q3
          FROM {source} GROUP BY {by}) q USING ({by}) GROUP BY d.{by}, q1, med, q3"""
    )


@query("box_stats", box_sql("total_sales", "station_name", "hub", sql.hub))
def box_stats(spark, folder):
    return rounded(st.box_stats(base.hub_table(spark, folder), "total_sales"))


@query("box_stats_daily", box_sql("total_sales", "road_type", "daily", sql.daily))
def box_stats_daily(spark, folder):
    return rounded(st.box_stats(base.daily_table(spark, folder), "total_sales", "road_type"))


@query(
    "density_by_station",
    sql.hub(
        """SELECT station_name, bin, count(*) AS n_rows, round(count(*) * 1.0::DOUBLE / sum(count(*)) OVER (PARTITION BY station_name), 6) AS share
        FROM (SELECT station_name, coalesce(least(CAST(floor(CASE WHEN hi <> lo THEN (x - lo) * 60 / (hi - lo) END) AS INTEGER), 59), 0) AS bin
          FROM (SELECT station_name, total_sales AS x FROM hub), (SELECT min(total_sales) AS lo, max(total_sales) AS hi FROM hub))
        GROUP BY station_name, bin"""
    ),
)
def density_by_station(spark, folder):
    return rounded(st.density(base.hub_table(spark, folder), "total_sales"))


_OUTLIERS = [c for c in sql.NUMERIC if c not in roles.STATIC_REALS]


def outlier_sql(cols, source, make, digits=4):
    parts = [
        f"""SELECT '{c}' AS "column", count(CASE WHEN {c} < q[1] - 1.5 * (q[2] - q[1]) OR {c} > q[2] + 1.5 * (q[2] - q[1]) THEN 1 END) AS n_outliers,
        {sql.r('any_value(q[1] - 1.5 * (q[2] - q[1]))', 'low', digits)}, {sql.r('any_value(q[2] + 1.5 * (q[2] - q[1]))', 'high', digits)}
        FROM {source}, (SELECT quantile_cont(CAST({c} AS DOUBLE), [0.25, 0.75]) AS q FROM {source}) HAVING bool_or({c} NOT IN (0, 1))"""
        for c in cols
    ]
    return make(f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE n_outliers > 0")


@query("iqr_outliers", outlier_sql(_OUTLIERS, "merged", sql.merged))
def iqr_outliers(spark, folder):
    """All numeric columns that are neither 0/1 nor fixed for a station."""
    merged = base.merged_table(spark, folder)
    return rounded(st.iqr_outliers(merged, st.measured_columns(merged)), 4)


_DAILY_OUTLIERS = [*roles.TARGETS, "total_traffic"]


@query("iqr_outliers_daily", outlier_sql(_DAILY_OUTLIERS, "daily", sql.daily))
def iqr_outliers_daily(spark, folder):
    """More rows than the exact path of small tables handles, so the bracket path runs."""
    return rounded(st.iqr_outliers(base.daily_table(spark, folder), _DAILY_OUTLIERS), 4)


@query(
    "order_price_quantiles",
    " UNION ALL ".join(
        f"SELECT o_orderpriority, {p}::DOUBLE AS prob, round(quantile_cont(o_totalprice, {p}), 4) AS value FROM orders GROUP BY 1"
        for p in roles.QUANTILES
    ),
)
def order_price_quantiles(spark, folder):
    from forecourt.operators.quantiles import exact_quantiles
    from forecourt.sources import standins

    orders = standins.table(spark, folder, "orders")
    out = exact_quantiles(orders, ["o_totalprice"], roles.QUANTILES, ["o_orderpriority"], 500, 500)
    return rounded(out.select("o_orderpriority", "prob", "value"), 4)
