"""URL filters: host-suffix and path-prefix rules looked up by hashed expressions.

A url is expanded into all pairs of a suffix of its host (whole labels) and a prefix of its path. Rules and
expressions meet in an equi-join on the first eight hex digits of a SHA-256 digest; equal full digests
confirm a match, and the longest rule wins. Only path lengths that occur among the rules are expanded.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)\A.*?://([^/?#]*+)([^?#]*+)"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _SMALL), F.lit(""))


def path(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _digest(host_part: Column, path_part: Column) -> Column:
    return F.sha2(F.concat(host_part, path_part), 256)


def _suffixes(name: Column) -> Column:
    labels = F.split(name, r"\.", -1)
    return F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels) - i), "."))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``, which replace columns of these names.

    ``rules`` holds ``host, path, verdict``: a rule fits its host and all subdomains if the url's path starts
    with the rule's. The longest fitting rule wins; of equal ones the stricter (block). Without a rule
    ``rule`` is null and the verdict is ``default``. A null url, or one without ``://``, has an empty host and
    path and fits no rule. Equal urls are looked up once; all rows and other columns stay.
    """
    pages = pages.drop("host", "path", "rule", "verdict")
    pages = pages.withColumns({"host": host(F.col(url)), "path": path(F.col(url))})
    rules = rules.where("host IS NOT NULL AND path IS NOT NULL AND host != ''").select(
        F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict")
    )
    rules = rules.withColumn("rule_full", _digest(F.col("rule_host"), F.col("rule_path"))).withColumn("short", F.substring("rule_full", 1, 8))
    lengths = rules.agg(F.collect_set(F.length("rule_path"))).scalar()
    wanted = F.filter("lengths", lambda n: n <= F.length("path"))
    addresses = pages.select("host", "path").where("host != ''").distinct().withColumn("lengths", lengths)
    expressions = addresses.select(
        "host", "path", F.explode(F.transform(wanted, lambda n: F.substr(F.col("path"), F.lit(1), n))).alias("prefix")
    ).select("host", "path", "prefix", F.explode(_suffixes(F.col("host"))).alias("suffix"))
    expressions = expressions.select("host", "path", _digest(F.col("suffix"), F.col("prefix")).alias("full"))
    expressions = expressions.withColumn("short", F.substring("full", 1, 8))
    found = expressions.join(rules, "short").where("full = rule_full")
    weight = F.struct(
        F.length("rule_host") + F.length("rule_path"), F.length("rule_host"), F.col("rule_verdict").alias("rule_verdict")
    )
    best = found.groupBy("host", "path").agg(
        F.max(F.struct(weight.alias("w"), F.concat("rule_host", "rule_path").alias("rule"))).alias("best")
    )
    return pages.join(best, ["host", "path"], "left").select(
        *[c for c in pages.columns],
        F.col("best.rule").alias("rule"),
        F.coalesce("best.w.rule_verdict", F.lit(default)).alias("verdict"),
    )
