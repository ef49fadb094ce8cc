"""Recommendations for every station and target, as rows.

Each function returns (station_name, target, kind, subject, other, value, text).
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt import roles
from forecourt.functions.expressions import change_pct
from forecourt.operators.features import present
from forecourt.operators.overview import STATION
from forecourt.plans.accuracy import band

COLUMNS = [STATION, "target", "kind", "subject", "other", "value", "text"]
IDS = [STATION, "target"]
#: Correlations with traffic that are worth a word, and those that are strong.
WEAK, STRONG = 0.25, 0.5


def tenths(x):
    """A number with one decimal as text."""
    return F.round(x, 1).cast("decimal(18,1)").cast("string")


def _rows(df: DataFrame, kind: str, subject, other, value, text) -> DataFrame:
    none = F.lit(None).cast("string")
    return df.select(
        *IDS,
        F.lit(kind).alias("kind"),
        (none if subject is None else subject.cast("string")).alias("subject"),
        (none if other is None else other.cast("string")).alias("other"),
        value.cast("double").alias("value"),
        text.alias("text"),
    )


#: Rules by kind: the columns their groups need, and the words before the best group.
KINDS = {
    "promotion": (["promotion_fuel_active", "promotion_shop_active"], None),
    "ad_channel": (["ad_channel"], "best channel "),
    "hour": (["hour"], "peak hour "),
    "weekday": (["weekday"], "best weekday "),
    "traffic": ([], None),
}
#: A spread below this part of the sum of squares is rounding noise.
NOISE = 1e-12
SUMS = ["n", "s", "pairs", "sx", "sy", "sxx", "syy", "sxy"]


def group_sums(hub: DataFrame, targets: list[str] = roles.TARGETS, kinds: tuple = tuple(KINDS)) -> DataFrame:
    """Sums of every target by station and the group of each rule: ``kind``, with ``number`` or ``name`` of the group.

    The hub is read once. Sums are taken over all targets side by side, by the few combinations of the columns that the rules
    look at; only then do they become one row per target and rule.
    """
    names = present(hub, targets)
    keys = list(dict.fromkeys(c for k in kinds for c in KINDS[k][0]))
    own = {"hour": F.hour("timestamp"), "weekday": F.weekday("timestamp")}
    x = F.col("total_traffic").cast("double")
    sums = []
    for t in names:
        y = F.col(t).cast("double")
        a, b = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
        cells = [F.count(y), F.sum(y), F.count(a * b), F.sum(a), F.sum(b), F.sum(a * a), F.sum(b * b), F.sum(a * b)]
        sums += [c.alias(f"{t}_{n}") for c, n in zip(cells, SUMS)][: None if "traffic" in kinds else 2]
    cells = hub.groupBy(STATION, *[own.get(k, F.col(k)).alias(k) for k in keys]).agg(*sums)
    there = SUMS if "traffic" in kinds else SUMS[:2]
    entries = [F.struct(F.lit(t).alias("target"), *[F.col(f"{t}_{n}").alias(n) for n in there]) for t in names]
    long = cells.select(STATION, *keys, F.inline(F.array(*entries)))
    fuel = F.col("target").startswith("sales_")
    none = F.lit(None)
    groups = {
        "promotion": lambda: (F.when(fuel, F.col("promotion_fuel_active")).otherwise(F.col("promotion_shop_active")), none),
        "ad_channel": lambda: (none, F.col("ad_channel")),
        "hour": lambda: (F.col("hour"), none),
        "weekday": lambda: (F.col("weekday"), none),
        "traffic": lambda: (none, none),
    }
    parts = []
    for kind in kinds:
        number, name = groups[kind]()
        parts.append(F.struct(F.lit(kind).alias("kind"), number.cast("int").alias("number"), name.cast("string").alias("name")))
    rows = long.select(*IDS, F.inline(F.array(*parts)), *there)
    rows = rows.where("kind IN ('promotion', 'traffic') OR number IS NOT NULL OR name IS NOT NULL")
    return rows.groupBy(*IDS, "kind", "number", "name").agg(*[F.sum(n).alias(n) for n in there]).where("n > 0")


def rules(sums: DataFrame) -> DataFrame:
    """Recommendations from ``group_sums``: one row per station, target and rule that has something to say."""
    mean = F.col("s") / F.col("n")
    group = F.struct("number", "name")
    rows = sums.withColumn("m", mean)
    ends = [
        F.min_by(group, F.struct(-F.col("m"), "number", "name")).alias("best"),
        F.min_by(group, F.struct("m", "number", "name")).alias("worst"),
        F.max("m").alias("top"),
        F.min("m").alias("low"),
        F.max(F.when(F.col("number") == 1, F.col("m"))).alias("on"),
        F.max(F.when(F.col("number") == 0, F.col("m"))).alias("off"),
        *([F.max(n).alias(n) for n in SUMS[2:]] if "sxy" in sums.columns else [F.lit(None).cast("double").alias(n) for n in SUMS[2:]]),
    ]
    found = rows.groupBy(*IDS, "kind").agg(*ends)
    lift = change_pct("on", "off")
    gain = F.coalesce(F.when(F.col("low") > 0, change_pct("top", "low")), F.lit(0.0))
    vx, vy = (F.col(f"s{c}{c}") - F.try_divide(F.col(f"s{c}") * F.col(f"s{c}"), F.col("pairs")) for c in "xy")
    spread = (vx > F.col("sxx") * NOISE) & (vy > F.col("syy") * NOISE)
    r = F.when(spread, (F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("pairs"))) / (F.sqrt(vx) * F.sqrt(vy)))
    found = found.withColumns({"lift": lift, "gain": gain, "r": r})

    def named(end):
        return F.coalesce(F.col(f"{end}.name"), F.col(f"{end}.number").cast("string"))

    is_promotion, is_traffic = F.col("kind") == "promotion", F.col("kind") == "traffic"
    words = F.create_map(*[F.lit(x) for k, (_, w) in KINDS.items() if w for x in (k, w)])
    level = F.when(F.col("r") > STRONG, F.lit("strong")).otherwise(F.lit("moderate"))
    sign = F.when(F.col("lift") > 0, F.lit("promotion raises sales by ")).otherwise(F.lit("promotion lowers sales by "))
    extremes = F.concat(
        words[F.col("kind")], named("best"), F.lit(" ("), tenths(F.col("top")),
        F.lit("), worst "), named("worst"), F.lit(" ("), tenths(F.col("low")), F.lit(")"),
    )
    promoted = F.concat(sign, tenths(F.abs("lift")), F.lit(" %"))

    def pick(promotion, traffic, other):
        return F.when(is_promotion, promotion).when(is_traffic, traffic).otherwise(other)

    known = pick((F.col("off") > 0) & F.col("on").isNotNull(), F.abs("r") > WEAK, F.lit(True))
    return found.where(known).select(
        *IDS,
        "kind",
        pick(tenths(F.col("on")), level, named("best")).alias("subject"),
        pick(tenths(F.col("off")), F.lit(None).cast("string"), named("worst")).alias("other"),
        pick(F.col("lift"), F.col("r"), F.col("gain")).alias("value"),
        pick(promoted, F.concat(level, F.lit(" link with traffic")), extremes).alias("text"),
    )


def promo(hub: DataFrame, targets: list[str] = roles.TARGETS) -> DataFrame:
    """Lift of the fuel promotion for fuels and of the shop promotion for shop goods."""
    return rules(group_sums(hub, targets, ("promotion",)))


def channel(hub: DataFrame, targets: list[str] = roles.TARGETS) -> DataFrame:
    """Best and worst advert channel by mean, and the gain of one over the other."""
    return rules(group_sums(hub, targets, ("ad_channel",)))


def hour(hub: DataFrame, targets: list[str] = roles.TARGETS) -> DataFrame:
    return rules(group_sums(hub, targets, ("hour",)))


def weekday(hub: DataFrame, targets: list[str] = roles.TARGETS) -> DataFrame:
    return rules(group_sums(hub, targets, ("weekday",)))


def traffic(hub: DataFrame, targets: list[str] = roles.TARGETS) -> DataFrame:
    """Traffic as a signal where the correlation is clear."""
    return rules(group_sums(hub, targets, ("traffic",)))


HINTS = {
    "good": "reliable, use for planning",
    "fair": "approximate, keep a margin",
    "poor": "unstable, indicative only",
}


def reliability(metrics: DataFrame, stations: DataFrame) -> DataFrame:
    """How far the forecast of each series can be trusted, by mean MAPE."""
    named = metrics.join(stations.select("station_id", STATION), "station_id")
    means = named.groupBy(*IDS).agg(F.avg("MAPE_%").alias("mape"))
    means = means.where(F.col("mape").isNotNull()).withColumn("band", band(F.col("mape")))
    hint = F.create_map(*[F.lit(x) for kv in HINTS.items() for x in kv])[F.col("band")]
    return _rows(means, "reliability", F.col("band"), None, F.col("mape"), hint)


def scenario(summary: DataFrame, stimuli: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """Mean, peak, delta, stimuli and price effect of each scenario, station and target."""
    out = summary.join(stimuli, "scenario_id", "left")
    active = F.concat_ws(
        ", ",
        F.when(F.col("any_promo_fuel") == 1, "fuel promotion"),
        F.when(F.col("any_promo_shop") == 1, "shop promotion"),
        F.when(F.col("any_ad") == 1, "advertising"),
    )
    out = out.withColumn("active_stimuli", active)
    if prices is not None:
        out = out.join(prices, ["scenario_id"], "left")
        up = F.col("price_delta_pct") > 0
        move = F.when(up, "price raised").when(F.col("price_delta_pct") < 0, "price cut")
        out = out.withColumn("price_effect", move)
    return out.drop("any_promo_fuel", "any_promo_shop", "any_ad")


def scenario_rows(delta: DataFrame, stimuli: DataFrame, stations: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """What each scenario does to a station's target, as recommendations.

    ``delta`` comes from ``scenario.scenario_delta``, ``stimuli`` and ``prices`` as in ``scenario``. ``subject`` is the
    scenario, ``other`` the active stimuli, ``value`` the change of the mean in percent.
    """
    out = scenario(delta, stimuli, prices).join(stations.select("station_id", STATION), "station_id")
    up = F.when(F.col("delta_pct") >= 0, F.lit("scenario raises the mean by ")).otherwise(F.lit("scenario lowers the mean by "))
    change = F.coalesce(F.concat(up, tenths(F.abs("delta_pct")), F.lit(" %")), F.lit("scenario"))
    means = F.concat(F.lit(" ("), tenths(F.col("mean_p50")), F.lit(" against "), tenths(F.col("base_p50")), F.lit(")"))
    text = F.concat(change, means)
    if prices is not None:
        moved = F.concat(F.lit(", "), F.col("price_effect"), F.lit(" by "), tenths(F.abs("price_delta_pct")), F.lit(" %"))
        text = F.concat(text, F.coalesce(moved, F.lit("")))
    return _rows(out, "scenario", F.col("scenario_id"), F.col("active_stimuli"), F.col("delta_pct"), text)


def recommendations(
    hub: DataFrame,
    metrics: DataFrame | None = None,
    targets: list[str] = roles.TARGETS,
    stations: DataFrame | None = None,
    scenarios: DataFrame | None = None,
) -> DataFrame:
    """All seven rules for every station and target in one table.

    The five rules over the hub share one scan. ``stations`` (station_id, station_name) names the stations of ``metrics``;
    ``scenarios`` comes from ``scenario_rows``.
    """
    parts = [rules(group_sums(hub, targets))]
    if metrics is not None:
        stations = hub.select("station_id", STATION).distinct() if stations is None else stations
        parts.append(reliability(metrics, stations))
    if scenarios is not None:
        parts.append(scenarios)
    return reduce(DataFrame.unionByName, parts)
