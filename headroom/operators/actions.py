"""Threshold crossings, action statuses, crossing probabilities and confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import confidence_index, normal_tail
from ..schemas import MATCH, SERIES, Params

CURVES = ("p50", "p90", "p95")
LEVELS = (80, 90, 95)
Z90 = 1.2815515655446004
RECOMMENDATIONS = {
    "overprovisioned": "consider consolidating or resizing",
    "none": "no crossing of the threshold expected within the forecast",
    "critical": "capacity measures needed within 30 days",
    "watch": "plan a capacity extension within 30 to 90 days",
    "stable": "watch the trend, no immediate action needed",
}


def crossings(forecast: DataFrame) -> DataFrame:
    """First day on which each curve reaches each level, counted from the first forecast day; one aggregation a series."""
    first = forecast.groupBy(*MATCH).agg(
        F.min("date").alias("first_date"),
        *[F.min(F.when(F.col(c) >= t, F.col("date"))).alias(f"date_{t}_{c}") for c in CURVES for t in LEVELS],
    )
    days = [(F.datediff(f"date_{t}_{c}", "first_date") + 1).alias(f"days_to_{t}_{c}") for c in CURVES for t in LEVELS]
    return first.select(*MATCH, *days, *[f"date_90_{c}" for c in CURVES])


def _matched(a: DataFrame, b: DataFrame, keys, how: str = "left") -> DataFrame:
    """a joined with b on keys in which null and '' are the same."""
    named = {k: f"__{k}" for k in keys}
    right = b.select(*[F.coalesce(k, F.lit("")).alias(named[k]) for k in keys], *[c for c in b.columns if c not in keys])
    on = [F.coalesce(a[k], F.lit("")) == right[named[k]] for k in keys]
    return a.join(right, on, how).drop(*named.values())


def status(cluster: Column, overprovisioned: Column, days: Column) -> Column:
    return F.when(overprovisioned & (cluster == "cold"), "overprovisioned").when(days < 30, "critical").when(days <= 90, "watch").otherwise("stable")


def actions(risk: DataFrame, forecast: DataFrame) -> DataFrame:
    """One row a series of risk; series without a forecast cross nothing."""
    rows = _matched(risk, crossings(forecast), MATCH)
    hot = F.col("cluster") == "hot"
    basis = F.when(hot, F.least("days_to_90_p90", "days_to_90_p95")).otherwise(F.col("days_to_90_p50"))
    date = F.when(hot, F.least("date_90_p90", "date_90_p95")).otherwise(F.col("date_90_p50"))
    told = rows.withColumns({"risk_basis": F.when(hot, "hot_p90_p95").otherwise("p50"), "days_to_90_basis": basis, "crossing_date_90_basis": date})
    state = told.withColumn("status", status(F.col("cluster"), F.col("overprovisioned"), F.col("days_to_90_basis")))
    kind = F.when((F.col("status") == "stable") & F.col("days_to_90_basis").isNull(), "none").otherwise(F.col("status"))
    text = F.element_at(F.create_map(*[F.lit(x) for kv in RECOMMENDATIONS.items() for x in kv]), kind)
    return state.withColumn("recommendation", text).select(
        *SERIES, "cluster", "overprovisioned", "p50", "p95", "p99", "duty_cycle_80", "duty_cycle_90", "burstiness", "volatility",
        *[f"days_to_{t}_{c}" for c in CURVES for t in LEVELS], "risk_basis", "days_to_90_basis", "crossing_date_90_basis", "status", "recommendation",
    )


def day_probability(threshold: float) -> Column:
    """Probability that a day's value reaches the threshold, from p50 and the width up to p90."""
    sigma = F.greatest(F.greatest(F.col("p90") - F.col("p50"), F.lit(0.5)) / Z90, F.lit(0.25))
    return normal_tail((F.lit(float(threshold)) - F.col("p50")) / sigma)


def risk_probabilities(forecast: DataFrame, selection: DataFrame, p: Params = Params()) -> DataFrame:
    """Probability of a crossing within each horizon, raw and adjusted by confidence; one aggregation a series."""
    days = forecast.withColumn("p_day", F.greatest(F.lit(0.0), F.least(F.lit(1.0), day_probability(p.threshold))))
    horizons = sorted(set(p.horizons))
    per = days.groupBy(*SERIES).agg(*[(1 - F.product(F.when(F.col("horizon_day") <= h, 1 - F.col("p_day")))).alias(f"h{h}") for h in horizons])
    long = per.select(*SERIES, F.explode(F.array(*[F.struct(F.lit(h).alias("horizon_days"), F.col(f"h{h}").alias("prob")) for h in horizons])).alias("x")).select(*SERIES, "x.*").filter("prob is not null")
    rows = _matched(long, selection.select(*SERIES, "selected_model", "wape", "mae", "pinball_p90", "calibration_p90"), SERIES)
    sure = confidence_index(F.col("wape"), F.col("pinball_p90"), F.col("calibration_p90"))
    adjusted = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("prob") * (0.5 + 0.5 * F.col("confidence_index_pct") / 100)))
    return rows.withColumn("confidence_index_pct", sure).select(*SERIES, "horizon_days", F.lit(p.threshold).alias("threshold"), (F.col("prob") * 100).alias("prob_cross_pct"), (adjusted * 100).alias("prob_cross_adjusted_pct"), "confidence_index_pct", F.coalesce("selected_model", F.lit("")).alias("selected_model"), "wape", "mae", "pinball_p90", "calibration_p90")


def probability_wide(probabilities: DataFrame, p: Params = Params()) -> DataFrame:
    """One column for each horizon; the explicit list saves a job that would look for the values."""
    horizons = sorted(set(p.horizons))
    rows = probabilities.groupBy(*SERIES).pivot("horizon_days", horizons).agg(F.max("prob_cross_adjusted_pct"))
    return rows.select(*SERIES, *[F.col(str(h)).alias(f"prob_cross_90_{h}d_pct") for h in horizons])


def complete_actions(actions_: DataFrame, probabilities: DataFrame, p: Params = Params()) -> DataFrame:
    """Actions with the largest confidence and the probabilities by horizon."""
    sure = probabilities.groupBy(*SERIES).agg(F.max("confidence_index_pct").alias("confidence_index_pct"))
    return _matched(_matched(actions_, sure, SERIES), probability_wide(probabilities, p), SERIES)
