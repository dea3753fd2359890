"""Daily p95 series and risk metrics of a series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clip
from ..schemas import SERIES


def daily_p95(history: DataFrame) -> DataFrame:
    """target_p95 by series and UTC day."""
    rows = history.select(*SERIES, F.to_date("clock").alias("date"), "utilization_pct").dropna()
    return rows.groupBy(*SERIES, "date").agg(F.percentile("utilization_pct", 0.95).alias("p")).select(*SERIES, "date", clip(F.col("p")).alias("target_p95"))


def cluster() -> Column:
    """hot, cold or warm from the metrics; a missing volatility is never cold."""
    return (
        F.when((F.col("p95") >= 85) | (F.col("duty_cycle_90") >= 0.10), "hot")
        .when((F.col("p50") <= 35) & (F.col("volatility") <= 0.45) & (F.col("duty_cycle_80") <= 0.05), "cold")
        .otherwise("warm")
    )


def risk_metrics(history: DataFrame, value: str = "utilization_pct") -> DataFrame:
    """One aggregation a series. Duty cycles count missing values as below."""
    v = F.col(value)
    share = lambda t: F.avg(F.when(v >= t, 1.0).otherwise(0.0))
    rows = history.dropna(subset=list(SERIES)).groupBy(*SERIES).agg(
        F.count(v).alias("point_count"),
        F.avg(v).alias("util_mean"),
        F.coalesce(F.stddev_samp(v), F.lit(0.0)).alias("util_std"),
        F.percentile(v, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99))).alias("q"),
        share(80).alias("duty_cycle_80"),
        share(90).alias("duty_cycle_90"),
    )
    told = rows.select(*SERIES, "point_count", "util_mean", "util_std", F.get("q", F.lit(0)).alias("p50"), F.get("q", F.lit(1)).alias("p95"), F.get("q", F.lit(2)).alias("p99"), "duty_cycle_80", "duty_cycle_90")
    more = told.withColumns({"burstiness": F.col("p95") - F.col("p50"), "volatility": F.when(F.col("util_mean") > 0, F.col("util_std") / F.col("util_mean"))})
    return more.withColumns({"cluster": cluster(), "overprovisioned": (F.col("p95") <= 25) & (F.col("duty_cycle_80") <= 0.01)})


def risk_counts(risk: DataFrame) -> DataFrame:
    """Clusters in fixed order, and the overprovisioned."""
    n = lambda c, k: F.count_if(c).alias(k)
    return risk.agg(*[n(F.col("cluster") == c, f"cluster_{c}") for c in ("cold", "warm", "hot")], n(F.col("overprovisioned"), "overprovisioned_hosts"))
