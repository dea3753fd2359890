"""Tables of the library and the parameters of its jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

#: What identifies one series.
SERIES = ("metric", "hostid", "host", "as_value", "env_value", "env_group")
#: What a forecast and a risk row are matched by: a renamed host keeps its forecast.
MATCH = ("metric", "hostid", "env_value", "env_group")


def table(**columns: str) -> T.StructType:
    """Schema from column names and DDL types."""
    return T._parse_datatype_string(", ".join(f"`{k}` {v}" for k, v in columns.items()))


_S, _D = "string", "double"
_SERIES = {k: _S for k in SERIES}
HOSTS = dict(hostid=_S, host=_S, name=_S, status=_S, tags="array<struct<tag: string, value: string>>")
ITEMS = dict(itemid=_S, hostid=_S, name=_S, key_=_S, value_type="int", status=_S, units=_S, type=_S, params=_S, delay=_S, lastvalue=_S, lastclock="bigint")
TREND_RAW = dict(itemid=_S, clock="timestamp", num="int", value_min=_D, value_avg=_D, value_max=_D)
HISTORY_RAW = dict(itemid=_S, clock="timestamp", value=_D, ns="bigint")
SELECTED = dict(hostid=_S, host=_S, as_value=_S, env_value=_S, env_group=_S, metric=_S, source=_S, feature=_S, entity=_S, itemid=_S, key_=_S, value_type="int", transform=_S)
UTIL_HISTORY = dict(metric=_S, clock="timestamp", hostid=_S, host=_S, as_value=_S, env_value=_S, env_group=_S, itemid=_S, utilization_pct=_D)
UTIL_TREND = dict(metric=_S, clock="timestamp", hostid=_S, host=_S, as_value=_S, env_value=_S, env_group=_S, itemid=_S, num="int", util_min=_D, util_avg=_D, util_max=_D)
FEATURE_HISTORY = dict(metric=_S, feature=_S, entity=_S, clock="timestamp", hostid=_S, host=_S, as_value=_S, itemid=_S, value=_D)
FEATURE_TREND = dict(metric=_S, feature=_S, entity=_S, clock="timestamp", hostid=_S, host=_S, as_value=_S, itemid=_S, num="int", value_min=_D, value_avg=_D, value_max=_D)
DAILY = dict(**_SERIES, date="date", target_p95=_D)
FORECAST = dict(**_SERIES, date="date", horizon_day="int", model=_S, p50=_D, p90=_D, p95=_D)


@dataclass(frozen=True)
class Params:
    """Defaults of the jobs."""

    as_key: str = "AS"
    env_key: str = "ENV"
    as_values: tuple[str, ...] = ()
    match: str = "equals"
    disk_fs: tuple[str, ...] = ("/", "C:")
    history_days: int = 0  # 0: the whole trend window
    trend_days: int = 365
    horizons: tuple[int, ...] = (30, 90, 180, 365)
    threshold: float = 90.0
    folds: int = 3
    fold_days: int = 30
    min_train: int = 90
    top_k: int = 12
    heat_hosts: int = 40
    chart_days: int = 90
    fit: str = "linear"
    history_window: str = "365d"
    delay: str = "1h"
