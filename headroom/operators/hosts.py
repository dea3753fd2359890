"""Hosts: selection by tag, tag values and environment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import env_group, preferred_value, tag_value
from ..schemas import Params


def hosts_by_tag(hosts: DataFrame, p: Params = Params()) -> DataFrame:
    """Enabled hosts with the application tag and, if values are given, one of these (equal or contained)."""
    has = lambda t: t["tag"] == p.as_key
    if p.as_values:
        values = F.array(*map(F.lit, p.as_values))
        wanted = (lambda v: F.array_contains(values, v)) if p.match == "equals" else (lambda v: F.exists(values, lambda x: F.contains(v, x)))
        hit = F.exists("tags", lambda t: has(t) & wanted(t["value"]))
    else:
        hit = F.exists("tags", has)
    return hosts.filter((F.col("status") == "0") & hit)


def host_scope(hosts: DataFrame, p: Params = Params()) -> DataFrame:
    """hostid, host, as_value, env_value, env_group; one row a host."""
    env = tag_value(F.col("tags"), p.env_key)
    rows = hosts.select("hostid", "host", preferred_value(F.col("tags"), p.as_key, p.as_values).alias("as_value"), env.alias("env_value"), env_group(env).alias("env_group"))
    return rows.groupBy("hostid").agg(F.min(F.struct("host", "as_value", "env_value", "env_group")).alias("x")).select("hostid", "x.*")


def attach_scope(rows: DataFrame, scope: DataFrame) -> DataFrame:
    """rows with env_value and env_group of their host; else what they have, else '' and non-prod."""
    known = scope.groupBy("hostid").agg(F.min(F.struct("env_value", "env_group")).alias("__scope"))
    own = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    out = rows.join(known, "hostid", "left").withColumns({"env_value": F.coalesce("__scope.env_value", own("env_value"), F.lit("")), "env_group": F.coalesce("__scope.env_group", own("env_group"), F.lit("non-prod"))})
    return out.drop("__scope")
