"""Desired forecast items and triggers, and their difference from what exists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import Params

# Horizon, the one before, priority and text of each risk window; the type of calculated items.
WINDOWS = ((30, None, 4, "critical now (<=30d)"), (90, 30, 3, "critical soon (31-90d)"), (180, 90, 2, "risk 6m (91-180d)"), (365, 180, 1, "risk 12m (181-365d)"))
CALCULATED = "15"
COMPARED = ("name", "delay", "params", "units", "status", "value_type")


def item_specs(targets: DataFrame, p: Params = Params()) -> DataFrame:
    """One forecast item for each target (hostid, host, as_value, env_value, env_group, metric, key_, transform) and horizon."""
    horizons = sorted({h for h in p.horizons if h > 0})
    rows = targets.withColumn("horizon_days", F.explode(F.array(*map(F.lit, horizons))))
    base = F.concat(F.lit("forecast(//"), F.col("key_"), F.lit(f",{p.history_window},"), F.col("horizon_days").cast("string"), F.lit(f'd,"{p.fit}","value")'))
    return rows.select(
        "hostid", "host", "as_value", "env_value", "env_group", "metric", "horizon_days",
        F.concat(F.lit("native.forecast.util["), "metric", F.lit(","), F.col("horizon_days").cast("string"), F.lit("d]")).alias("key_"),
        F.concat(F.lit("[NativeForecast] "), F.upper("metric"), F.lit(" utilization +"), F.col("horizon_days").cast("string"), F.lit("d")).alias("name"),
        F.when(F.col("transform") == "invert_100", F.concat(F.lit("100-"), base)).otherwise(base).alias("params"),
        F.lit(p.delay).alias("delay"), F.lit("%").alias("units"), F.lit("0").alias("status"), F.lit(0).alias("value_type"), F.lit(CALCULATED).alias("type"),
    )


def trigger_specs(specs: DataFrame, p: Params = Params()) -> DataFrame:
    """Four risk windows for each host and metric that has the items of all four horizons."""
    own = ["hostid", "host", "as_value", "env_value", "env_group", "metric"]
    keys = specs.groupBy(*own).agg(*[F.max(F.when(F.col("horizon_days") == h, F.col("key_"))).alias(f"k{h}") for h, *_ in WINDOWS]).dropna(subset=[f"k{h}" for h, *_ in WINDOWS])
    level = str(float(p.threshold))
    at = lambda h: F.concat(F.lit("last(/"), "host", F.lit("/"), F.col(f"k{h}"), F.lit(f")>={level}"))
    tag = lambda k, v: F.struct(F.lit(k).alias("tag"), v.alias("value"))
    common = [tag("SOURCE", F.lit("native_forecast")), tag("AS", F.col("as_value")), tag("ENV", F.col("env_value")), tag("ENV_GROUP", F.col("env_group")), tag("METRIC", F.col("metric")), tag("THRESHOLD", F.lit(level))]
    windows = [
        F.struct(
            F.concat(F.lit("[NativeForecast]["), F.upper("metric"), F.lit(f"] {text}")).alias("description"),
            (at(h) if not before else F.concat(F.lit("("), at(h), F.lit(") and not ("), at(before), F.lit(")"))).alias("expression"),
            F.lit(priority).alias("priority"),
            F.lit("0").alias("status"),
            F.array(*common, tag("RISK_WINDOW", F.lit(f"{h}d"))).alias("tags"),
        )
        for h, before, priority, text in WINDOWS
    ]
    return keys.select("hostid", "host", "metric", F.explode(F.array(*windows)).alias("t")).select("hostid", "host", "metric", "t.*")


def item_diff(desired: DataFrame, existing: DataFrame) -> DataFrame:
    """create, update, noop, or skip_conflict where an item of another type has the key."""
    old = existing.groupBy("hostid", "key_").agg(F.min_by(F.struct("itemid", "type", *COMPARED), F.col("itemid").cast("long")).alias("old"))
    rows = desired.join(old, ["hostid", "key_"], "left")
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    same = F.lit(True)
    for c in COMPARED:
        same = same & (text(F.col(c)) == text(F.col(f"old.{c}")))
    action = F.when(F.col("old").isNull(), "create").when(text(F.col("type")) != text(F.col("old.type")), "skip_conflict").when(same, "noop").otherwise("update")
    return rows.select("hostid", "host", "metric", "horizon_days", "key_", action.alias("action"), F.col("old.itemid").alias("itemid"))


def sorted_tags(tags):
    return F.array_sort(F.transform(tags, lambda t: F.concat_ws("=", t["tag"], F.coalesce(t["value"], F.lit("")))))


def trigger_diff(desired: DataFrame, existing: DataFrame) -> DataFrame:
    """create, update or noop by host and description; tags compare without order."""
    old = existing.select("triggerid", "description", "expression", "priority", "status", sorted_tags(F.col("tags")).alias("tags"), F.explode("hosts").alias("h")).groupBy(F.col("h.hostid").alias("hostid"), "description").agg(F.min_by(F.struct("triggerid", "expression", "priority", "status", "tags"), F.col("triggerid").cast("long")).alias("old"))
    rows = desired.join(old, ["hostid", "description"], "left")
    same = (F.col("expression") == F.col("old.expression")) & (F.col("priority").cast("string") == F.col("old.priority").cast("string")) & (F.col("status") == F.col("old.status")) & (sorted_tags(F.col("tags")) == F.col("old.tags"))
    action = F.when(F.col("old").isNull(), "create").when(F.coalesce(same, F.lit(False)), "noop").otherwise("update")
    return rows.select("hostid", "host", "metric", "description", action.alias("action"), F.col("old.triggerid").alias("triggerid"))


def summary(items: DataFrame, triggers: DataFrame) -> DataFrame:
    """Items and triggers in one table with the union of their columns."""
    return items.withColumn("object_type", F.lit("item")).unionByName(triggers.withColumn("object_type", F.lit("trigger")), allowMissingColumns=True)


def action_counts(summary_: DataFrame) -> DataFrame:
    return summary_.groupBy("object_type", "action").agg(F.count(F.lit(1)).alias("n"))
