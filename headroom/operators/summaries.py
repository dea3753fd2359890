"""Hourly summaries over all hosts, by tag value and by scope, in one pass of grouping sets.

Percentiles are exact, and the three of a group share one buffer. Rows with a null group key belong to no
group. host_count of the history is the number of values, that of the trend the number of distinct hosts:
the points of a host in an hour (a few, one an item) meet first, the first of them in each group is marked, and
a group's hosts are the sum of its marks, so that no level needs a distinct of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def _aggregates(value: str, low: str, high: str) -> list[Column]:
    return [F.avg(value).alias("mean"), F.percentile(value, [0.1, 0.5, 0.9]).alias("q"), F.min(low).alias("low"), F.max(high).alias("high")]


def _history_aggregates() -> list[Column]:
    v = "utilization_pct"
    return [F.count(v).alias("host_count"), *_aggregates(v, v, v)]


def _named(rows: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """rows of _aggregates() with their public names."""
    q = lambda k: F.get("q", F.lit(k))
    return rows.select(*keys, "host_count", F.col("mean").alias(f"{prefix}_mean"), q(1).alias(f"{prefix}_median"), F.col("low").alias("util_min"), F.col("high").alias("util_max"), q(0).alias(f"{prefix}_p10"), q(2).alias(f"{prefix}_p90"))


def _marked(trend: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Points (metric, clock, by, util_avg, util_min, util_max) with a mark new_k: 1 on the first of its host in the hour and the first k of `by`."""
    fields = [*by, "util_avg", "util_min", "util_max"]
    hosts = trend.dropna(subset=["metric", *by, "clock"]).groupBy("metric", "clock", "hostid").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("points"))
    each = hosts.select("metric", "clock", "hostid", "points", F.posexplode("points").alias("i", "x"))
    before = F.get("points", F.col("i") - 1)
    marks, same = [], F.lit(True)
    for k in range(len(by) + 1):
        same = same & (before[by[k - 1]] == F.col("x")[by[k - 1]]) if k else same
        marks.append((F.col("hostid").isNotNull() & ((F.col("i") == 0) | ~same)).cast("int").alias(f"new_{k}"))
    return each.select("metric", "clock", *[F.col("x")[f].alias(f) for f in fields], *marks)


def _trend_aggregates(by: int) -> list[Column]:
    return [*[F.sum(f"new_{k}").alias(f"new_{k}") for k in range(by + 1)], *_aggregates("util_avg", "util_min", "util_max")]


def summarize_history(history: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    keys = ["metric", *by, "clock"]
    return _named(history.dropna(subset=keys).groupBy(*keys).agg(*_history_aggregates()), keys, "util")


def summarize_trend(trend: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    keys = ["metric", *by, "clock"]
    rows = _marked(trend, by).groupBy(*keys).agg(*_trend_aggregates(len(by)))
    return _named(rows.withColumnRenamed(f"new_{len(by)}", "host_count"), keys, "util_avg")


def scope_summaries(history: DataFrame) -> DataFrame:
    """All three levels at once: `level` is all, tag or scope; columns that a level doesn't use are ''."""
    return _by_level(history.dropna(subset=["metric", "as_value", "env_group", "clock"]), _history_aggregates(), "util")


def scope_trend_summaries(trend: DataFrame) -> DataFrame:
    """As scope_summaries(), of the trend."""
    hosts = F.when(F.col("g") == 0, F.col("new_2")).when(F.col("g") == 2, F.col("new_1")).otherwise(F.col("new_0"))
    return _by_level(_marked(trend, ("as_value", "env_group")), _trend_aggregates(2), "util_avg", hosts)


def _by_level(points: DataFrame, aggregates: list[Column], prefix: str, hosts: Column | None = None) -> DataFrame:
    """hosts: the count of hosts where no aggregate has it; g is 0 for a scope, 2 for a tag value, else 6."""
    sets = [["metric", "clock"], ["metric", "as_value", "clock"], ["metric", "as_value", "env_group", "clock"]]
    rows = points.groupingSets([[F.col(c) for c in s] for s in sets], "metric", "as_value", "env_group", "clock").agg(F.grouping_id("metric", "as_value", "env_group", "clock").alias("g"), *aggregates)
    level = F.when(F.col("g") == 0, "scope").when(F.col("g") == 2, "tag").otherwise("all")
    rows = rows.withColumn("host_count", hosts) if hosts is not None else rows
    filled = rows.withColumns({"level": level, "as_value": F.coalesce("as_value", F.lit("")), "env_group": F.coalesce("env_group", F.lit(""))})
    return _named(filled, ["level", "metric", "as_value", "env_group", "clock"], prefix)


def host_count(history: DataFrame, trend: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Distinct hosts over both tables."""
    rows = history.select(*by, "hostid").union(trend.select(*by, "hostid")).filter("hostid is not null").distinct()
    return rows.groupBy(*by).agg(F.count("hostid").alias("host_count")) if by else rows.agg(F.count("hostid").alias("host_count"))


def latest_status(summary: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The last hour of each metric (and scope) and its state."""
    last = summary.groupBy("metric", *by).agg(F.max_by(F.struct("util_mean", "util_p90", "clock"), "clock").alias("x")).select("metric", *by, "x.*")
    state = F.when(F.col("util_p90") >= 90, "critical").when(F.col("util_mean") >= 80, "high").otherwise("normal")
    return last.withColumn("state", state)


def daily_means(summary: DataFrame, value: str = "util_avg_mean", by: tuple[str, ...] = ()) -> DataFrame:
    return summary.groupBy("metric", *by, F.to_date("clock").alias("date")).agg(F.avg(value).alias("mean")).filter("mean is not null")


def week_delta(daily: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The last 7 days against the 7 before, where there are 14 days."""
    place = F.row_number().over(Window.partitionBy("metric", *by).orderBy(F.col("date").desc()))
    ranked = daily.withColumn("n", place).filter("n <= 14")
    both = ranked.groupBy("metric", *by).agg(F.count(F.lit(1)).alias("days"), F.avg(F.when(F.col("n") <= 7, F.col("mean"))).alias("recent_7d"), F.avg(F.when(F.col("n") > 7, F.col("mean"))).alias("prev_7d"))
    delta = F.col("recent_7d") - F.col("prev_7d")
    return both.filter("days = 14").select("metric", *by, "recent_7d", "prev_7d", delta.alias("delta_pp"), F.when(delta > 1, "up").when(delta < -1, "down").otherwise("flat").alias("state"))


def unioned_metrics(history: DataFrame, trend: DataFrame) -> DataFrame:
    return history.select("metric").union(trend.select("metric")).filter("metric is not null").distinct()


def heat_map(history: DataFrame, hosts: int = 40) -> DataFrame:
    """Daily mean of the first hosts by name of each metric."""
    daily = history.dropna(subset=["metric", "host"]).groupBy("metric", "host", F.to_date("clock").alias("date")).agg(F.avg("utilization_pct").alias("mean"))
    # rank the host names, not their days
    names = daily.select("metric", "host").distinct().withColumn("place", F.row_number().over(Window.partitionBy("metric").orderBy("host"))).filter(F.col("place") <= hosts)
    return daily.join(names.select("metric", "host"), ["metric", "host"], "left_semi")


def tag_breakdown(by_tag: DataFrame) -> DataFrame:
    """Mean series by tag value, with a name for the empty one."""
    return by_tag.select("metric", F.when(F.col("as_value") == "", "(no tag)").otherwise(F.col("as_value")).alias("series"), "clock", "util_mean")
