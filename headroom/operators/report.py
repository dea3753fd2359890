"""Conclusions, top lists, chart tables and scopes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import bucket_90, confidence_level, days_text, label, percent_text, slug
from ..schemas import SERIES, Params

SCOPE = ("as_value", "env_group")
#: Sections of a scope's text, in order, with the horizon whose probability is told.
SECTIONS = (("critical_now", 30), ("critical_soon", 90), ("risk_6m", 180), ("risk_12m", 365), ("stable", 365), ("overprovisioned", 365))
STATUS_RANK = ("critical", "watch", "stable", "overprovisioned")


def scope_of(rows: DataFrame) -> DataFrame:
    """rows with the scope columns filled: '' and non-prod where missing."""
    return rows.withColumns({"as_value": F.coalesce("as_value", F.lit("")), "env_group": F.coalesce("env_group", F.lit("non-prod"))})


def filter_scope(rows: DataFrame, as_value: str, env_group: str) -> DataFrame:
    return scope_of(rows).filter((F.col("as_value") == as_value) & (F.col("env_group") == env_group))


def scope_list(*tables: DataFrame) -> DataFrame:
    """Distinct scopes of all tables, with a path part that no two values of a tag share."""
    every = reduce(DataFrame.unionByName, [scope_of(t).select(*SCOPE) for t in tables]).distinct()
    return with_slugs(every)


def with_slugs(scopes: DataFrame) -> DataFrame:
    named = scopes.withColumn("slug", slug(F.col("as_value")))
    shared = named.groupBy("slug").agg((F.count_distinct("as_value") > 1).alias("shared"))
    out = named.join(shared, "slug")
    return out.select(*scopes.columns, F.when(F.col("shared"), F.concat("slug", F.lit("-"), F.substring(F.sha2(F.col("as_value").cast("binary"), 256), 1, 8))).otherwise(F.col("slug")).alias("as_slug"))


def bucket_counts(actions: DataFrame) -> DataFrame:
    """Series by section in each scope; the overprovisioned overlap with the others."""
    b = bucket_90(F.col("days_to_90_basis"))
    return scope_of(actions).groupBy(*SCOPE).agg(F.count(F.lit(1)).alias("total"), *[F.count_if(b == s).alias(s) for s, _ in SECTIONS[:5]], F.count_if(F.col("status") == "overprovisioned").alias("overprovisioned"))


def status_counts(actions: DataFrame) -> DataFrame:
    return scope_of(actions).groupBy(*SCOPE, "status").agg(F.count(F.lit(1)).alias("n"))


def top_k(actions: DataFrame, p: Params = Params()) -> DataFrame:
    """The series to chart first: by status, days to the threshold, metric and host."""
    rank = F.array_position(F.array(*map(F.lit, STATUS_RANK)), F.col("status"))
    ranked = actions.withColumn("priority", F.when(rank > 0, rank - 1).otherwise(4))
    return ranked.orderBy("priority", F.coalesce(F.col("days_to_90_basis"), F.lit(1_000_000_000)), "metric", "host", "hostid").limit(p.top_k)


def conclusion_lines(actions: DataFrame, probabilities: DataFrame) -> DataFrame:
    """Text of each scope as rows (scope, section_no, line_no, line)."""
    rows = scope_of(actions).withColumn("bucket", bucket_90(F.col("days_to_90_basis")))
    own = F.array_compact(F.array(F.col("bucket"), F.when(F.col("status") == "overprovisioned", "overprovisioned")))
    number = F.create_map(*[F.lit(x) for i, (s, _) in enumerate(SECTIONS) for x in (s, i + 1)])
    horizon = F.create_map(*[F.lit(x) for s, h in SECTIONS for x in (s, h)])
    placed = rows.withColumn("section", F.explode(own)).withColumns({"section_no": F.element_at(number, F.col("section")), "horizon_days": F.element_at(horizon, F.col("section"))})
    told = probabilities.select(*SERIES, "horizon_days", "prob_cross_adjusted_pct", F.col("confidence_index_pct").alias("sure"))
    joined = placed.drop("confidence_index_pct", "prob_cross_adjusted_pct").join(told, [*SERIES, "horizon_days"], "left")
    order = Window.partitionBy(*SCOPE, "section_no").orderBy(F.col("days_to_90_basis").asc_nulls_last(), "host", "metric", "hostid")
    line = F.concat(
        F.lit("- "), F.coalesce("host", F.lit("")), F.lit(" ["), F.upper("metric"), F.lit("]: to 90% ~ "), days_text(F.col("days_to_90_basis")),
        F.lit(", P(<= "), F.col("horizon_days").cast("string"), F.lit(" d)="), percent_text(F.col("prob_cross_adjusted_pct")),
        F.lit(", confidence="), percent_text(F.col("sure")), F.lit(", status="), F.col("status"), F.lit(", recommendation="), F.col("recommendation"),
    )
    return joined.select(*SCOPE, "section_no", F.row_number().over(order).alias("line_no"), line.alias("line"))


def facts(section: Column | str, values: dict[str, Column], rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """rows as (by, section, key, value) facts, all text; missing values give none."""
    section = F.lit(section) if isinstance(section, str) else section
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in values.items()])
    return rows.select(*by, section.alias("section"), F.explode(pairs).alias("x")).select(*by, "section", "x.*").filter("value is not null")


def conclusion(matched_hosts: DataFrame, counts: DataFrame, latest: DataFrame, delta: DataFrame, risk: DataFrame, actions: DataFrame, selection: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The facts of a run, or of each of its scopes, from its small tables."""
    two = lambda c: F.when(F.col(c).isNotNull(), F.format_string("%.2f", F.col(c)))
    count_by = lambda rows, section, column, prefix: rows.groupBy(*by, F.coalesce(column, F.lit("unknown")).alias("k")).agg(F.count(F.lit(1)).alias("n")).select(*by, F.lit(section).alias("section"), F.concat(F.lit(prefix), "k").alias("key"), F.col("n").cast("string").alias("value"))
    named = {"cpu_target_items": "cpu_target", "ram_target_items": "ram_target", "disk_target_items": "disk_target", "ram_feature_items": "ram_features", "disk_feature_items": "disk_features", "feature_items_total": "feature_total"}
    parts = [
        facts("run", {"matched_hosts": F.col("host_count")}, matched_hosts, by),
        facts("selection", {k: F.col(c) for k, c in named.items()}, counts, by),
        facts(F.col("metric"), {"latest_history_mean_pct": two("util_mean"), "latest_history_p90_pct": two("util_p90"), "status": F.col("state")}, latest, by),
        facts(F.col("metric"), {"trend_recent_7d_mean_pct": two("recent_7d"), "trend_prev_7d_mean_pct": two("prev_7d"), "trend_delta_pp": two("delta_pp"), "trend_state": F.col("state")}, delta, by),
        count_by(risk, "risk", "cluster", "cluster_"),
        facts("risk", {"overprovisioned_hosts": F.col("n")}, risk.groupBy(*by).agg(F.count_if("overprovisioned").alias("n")), by),
        count_by(actions, "actionable", "status", "status_"),
        count_by(selection, "forecast", "selected_model", "model_"),
    ]
    return reduce(DataFrame.unionByName, parts)


def forecast_chart(history: DataFrame, forecast: DataFrame, top: DataFrame, probabilities: DataFrame, p: Params = Params()) -> DataFrame:
    """Chart rows of the chosen series: the last days of actuals, and forecast bands that begin at the last actual day.

    Every row tells the series' confidence, its level, and the adjusted probability of a crossing within each horizon.
    """
    chosen = F.broadcast(top.select("metric", "hostid").distinct())  # at most top_k rows
    actual = history.join(chosen, ["metric", "hostid"], "left_semi")
    last = F.max("date").over(Window.partitionBy("metric", "hostid"))
    shown = actual.withColumn("last", last).filter(F.col("date") >= F.date_sub("last", p.chart_days))
    point = lambda kind, *values: [F.lit(kind).alias("kind"), "metric", "hostid", "date", *[F.col(v).cast("double").alias(n) if v else F.lit(None).cast("double").alias(n) for v, n in zip(values, ("actual", "p50", "p90", "p95"))]]
    anchor = shown.filter("date = last")
    ahead = forecast.join(chosen, ["metric", "hostid"], "left_semi")
    rows = shown.select(*point("actual", "y", None, None, None)).unionByName(anchor.select(*point("forecast", None, "y", "y", "y"))).unionByName(ahead.select(*point("forecast", None, "p50", "p90", "p95")))
    chance = [F.max(F.when(F.col("horizon_days") == h, F.col("prob_cross_adjusted_pct"))).alias(f"prob_cross_90_{h}d_pct") for h in sorted(set(p.horizons))]
    told = with_confidence_level(probabilities.join(chosen, ["metric", "hostid"], "left_semi").groupBy("metric", "hostid").agg(F.max("confidence_index_pct").alias("confidence_index_pct"), *chance))
    return rows.join(F.broadcast(told), ["metric", "hostid"], "left")  # at most top_k rows


def labelled(actions: DataFrame) -> DataFrame:
    """Readable labels of a series' state."""
    return actions.select(*SERIES, label("metric", F.col("metric")).alias("metric_label"), label("status", F.col("status")).alias("status_label"), label("cluster", F.col("cluster")).alias("cluster_label"), label("basis", F.col("risk_basis")).alias("basis_label"), days_text(F.col("days_to_90_basis")).alias("days_label"))


def with_confidence_level(probabilities: DataFrame) -> DataFrame:
    return probabilities.withColumn("confidence_level", confidence_level(F.col("confidence_index_pct")))
