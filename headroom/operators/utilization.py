"""Raw points to utilization and feature tables.

Points are the large side; the selection is one row an item. It is broadcast only after a check of
its size, else both sides are shuffled by item id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clip
from ..schemas import FEATURE_HISTORY, FEATURE_TREND, UTIL_HISTORY, UTIL_TREND

#: Rows of the selection that may be broadcast, some 100 bytes each.
BROADCAST_ITEMS = 500_000


def checked_broadcast(small: DataFrame, most: int = BROADCAST_ITEMS) -> DataFrame:
    """small, to be broadcast if it has at most `most` rows. Counting stops beyond that."""
    return F.broadcast(small) if small.limit(most + 1).count() <= most else small


def invert(transform: Column, value: Column) -> Column:
    return F.when(transform == "invert_100", 100 - value).otherwise(value)


def _selected(selected: DataFrame, source: str) -> DataFrame:
    return checked_broadcast(selected.filter(F.col("source") == source).drop("key_", "value_type", "source"))


def in_window(points: DataFrame, selected: DataFrame, since, until) -> DataFrame:
    """Points of selected items between two timestamps, both included. Points stored by month are read for those months alone."""
    items = checked_broadcast(selected.select("itemid").distinct())
    return between(points, since, until).join(items, "itemid", "left_semi")


def between(points: DataFrame, since, until) -> DataFrame:
    rows = points.filter(F.col("clock").between(F.lit(since), F.lit(until)))
    if "month" not in points.columns:
        return rows
    month = lambda t: F.date_format(F.lit(t).cast("timestamp"), "yyyy-MM")
    return rows.filter(F.col("month").between(month(since), month(until)))


def derive_history(trend: DataFrame, history_days: int, now, keep: tuple[str, ...] = ()) -> DataFrame:
    """History points from trend averages; 0 days: all. keep: further columns of the points that stay, here and below."""
    kept = trend.filter(F.col("clock") >= F.lit(now) - F.expr(f"interval {int(history_days)} days")) if history_days else trend
    return kept.select("itemid", "clock", F.col("value_avg").alias("value"), F.lit(0).cast("long").alias("ns"), *keep)


def util_history(history: DataFrame, selected: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return target_history(history.join(_selected(selected, "target"), "itemid"), keep)


def target_history(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """History points that have met their targets."""
    return rows.withColumn("utilization_pct", clip(invert(F.col("transform"), F.col("value")))).select(*UTIL_HISTORY, *keep)


def util_trend(trend: DataFrame, selected: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return target_trend(trend.join(_selected(selected, "target"), "itemid"), keep)


def target_trend(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Trend points that have met their targets. Inverted items swap their minimum and maximum."""
    inverted = F.col("transform") == "invert_100"
    low = F.when(inverted, 100 - F.col("value_max")).otherwise(F.col("value_min"))
    high = F.when(inverted, 100 - F.col("value_min")).otherwise(F.col("value_max"))
    return rows.withColumns({"util_min": clip(low), "util_avg": clip(invert(F.col("transform"), F.col("value_avg"))), "util_max": clip(high)}).select(*UTIL_TREND, *keep)


def _feature(value: str) -> Column:
    return F.when(F.col("feature").endswith("_pct"), clip(F.col(value))).otherwise(F.col(value))


def feature_history(history: DataFrame, selected: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return own_feature_history(history.join(_selected(selected, "feature"), "itemid"), keep)


def own_feature_history(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """History points that have met their features."""
    return rows.withColumn("value", _feature("value")).select(*FEATURE_HISTORY, *keep)


def feature_trend(trend: DataFrame, selected: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return own_feature_trend(trend.join(_selected(selected, "feature"), "itemid"), keep)


def own_feature_trend(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Trend points that have met their features."""
    return rows.withColumns({c: _feature(c) for c in ("value_min", "value_avg", "value_max")}).select(*FEATURE_TREND, *keep)
