"""End-to-end jobs: input tables in, folders of result tables out.

Tables that several later steps read are written and read back, so that no step computes an earlier
one again and a lost executor costs one step.
"""

from __future__ import annotations

from dataclasses import asdict

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import actions as A
from ..operators import domains as D
from ..operators import dumps as U
from ..operators import forecast as M
from ..operators import forecast_native as N
from ..operators import hosts as H
from ..operators import inventory as I
from ..operators import provisioning as V
from ..operators import report as R
from ..operators import risk as K
from ..operators import selection as S
from ..operators import summaries as Y
from ..operators import utilization as Z
from ..schemas import FEATURE_HISTORY, SELECTED, UTIL_HISTORY, UTIL_TREND, Params
from ..sources import sinks, tables


class Folder:
    """Result tables below one path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._counted: dict[str, Observation] = {}
        self._views: dict[str, DataFrame] = {}

    def put(self, name: str, df: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
        self._counted[name] = Observation()
        sinks.write(df, f"{self.path}/{name}", order=order, counted=self._counted[name])
        return self.get(name)

    def put_records(self, checked: DataFrame, points: str, errors: str) -> DataFrame:
        """Points and rejected records by one write; each is a table of its own name."""
        self._views[points], self._views[errors] = sinks.write_records(checked, f"{self.path}/{points}")
        return self._views[points]

    def get(self, name: str) -> DataFrame:
        return self._views[name] if name in self._views else self.spark.read.parquet(f"{self.path}/{name}")

    def counts(self) -> dict[str, int]:
        """Rows of the tables that put() wrote, counted as they were written."""
        return {name: sinks.rows_of(o) for name, o in self._counted.items()}


def collect(spark: SparkSession, hosts: DataFrame, items: DataFrame, trend_raw: DataFrame, out: str, p: Params = Params(), now=None) -> Folder:
    """Hosts by tag, chosen items, and their points as utilization and feature tables. now: end of the trend window."""
    to = Folder(spark, out)
    scope = to.put("hosts", H.host_scope(H.hosts_by_tag(hosts, p), p), ("host", "hostid"))
    selected = to.put("selected_items", S.selection(items, scope, p))
    points = tables.checked_points(trend_raw)
    if now is not None:
        end = F.lit(now).cast("timestamp")
        # a record without a clock is told whatever the window
        points = points.filter(F.col("clock").isNull() | F.col("clock").between(end - F.expr(f"interval {p.trend_days} days"), end))
    # records without an item are told, those of items that were not chosen are nobody's error
    chosen = Z.checked_broadcast(selected.select(F.col("itemid").alias("_item")).distinct())
    kept = points.join(chosen, F.col("itemid") == F.col("_item"), "left").filter("_item is not null or itemid is null").drop("_item")
    trend = to.put_records(kept, "trend_raw", "trend_errors")
    history = Z.derive_history(trend, p.history_days, now)
    to.put("util_trend", Z.util_trend(trend, selected))
    to.put("util_history", Z.util_history(history, selected))
    to.put("feature_trend", Z.feature_trend(trend, selected))
    to.put("feature_history", Z.feature_history(history, selected))
    return to


def checkpointed(spark: SparkSession, *paths: str) -> dict[str, DataFrame]:
    """The tables of an earlier collect() with their schemas, each from the first path that has it, or empty ones."""
    kinds = {"util_history": UTIL_HISTORY, "util_trend": UTIL_TREND, "feature_history": FEATURE_HISTORY, "selected_items": SELECTED}
    place = {n: tables.pick_path(spark, *[f"{p}/{n}" for p in paths]) or f"{paths[0]}/{n}" for n in kinds}
    return {n: tables.timeseries(spark, place[n], k, "parquet") for n, k in kinds.items()}


def analyse(spark: SparkSession, source: str, out: str, p: Params = Params(), legacy: str | None = None) -> Folder:
    """Summaries, risk, forecasts, actions and reports from the tables of collect(), global and by scope."""
    have, to = checkpointed(spark, source, *([legacy] if legacy else [])), Folder(spark, out)
    history, trend, selected = have["util_history"], have["util_trend"], have["selected_items"]
    summary = to.put("history_summary_all", Y.summarize_history(history))
    trend_summary = to.put("trend_summary_all", Y.summarize_trend(trend))
    to.put("history_summary_by_as", Y.summarize_history(history, ("as_value",)))
    to.put("trend_summary_by_as", Y.summarize_trend(trend, ("as_value",)))
    levels = to.put("scope_summaries", Y.scope_summaries(history)), to.put("scope_trend_summaries", Y.scope_trend_summaries(trend))
    risk = to.put("host_risk_metrics", K.risk_metrics(history))
    daily = to.put("daily_target_p95", K.daily_p95(history))
    grid = to.put("daily_grid", N.daily_grid(daily))
    series = to.put("daily_series", M.series_of(grid))
    backtest = to.put("model_backtest", M.model_backtest(series, p))
    selection = to.put("model_selection", M.model_selection(backtest, series))
    forecast = to.put("forecast_daily", M.forecast_daily(series, selection, p))
    chances = to.put("risk_probabilities", A.risk_probabilities(forecast, selection, p))
    actionable = to.put("actionable", A.complete_actions(A.actions(risk, forecast), chances, p))
    facts = lambda summary, trend_summary, by: R.conclusion(Y.host_count(history, trend, by), S.selected_counts(selected, by), Y.latest_status(summary, by), Y.week_delta(Y.daily_means(trend_summary, by=by), by), risk, actionable, selection, by)
    conclusion = to.put("conclusion", facts(summary, trend_summary, ()), ("section", "key"))
    own, own_trend = (t.filter("level = 'scope'").drop("level") for t in levels)
    scope_facts = to.put("scope_facts", facts(own, own_trend, R.SCOPE), (*R.SCOPE, "section", "key"))
    to.put("conclusion_lines", R.conclusion_lines(actionable, chances), (*R.SCOPE, "section_no", "line_no"))
    to.put("forecast_chart", R.forecast_chart(daily.withColumnRenamed("target_p95", "y"), forecast, R.top_k(actionable, p), chances, p))
    to.put("heat_map", Y.heat_map(history, p.heat_hosts))
    scopes = to.put("scopes", R.scope_list(history, trend, actionable, selected), R.SCOPE)
    report = {
        "selected_items": selected, "history_summary_all": summary, "history_summary_by_as": to.get("history_summary_by_as"), "trend_summary_all": trend_summary, "trend_summary_by_as": to.get("trend_summary_by_as"),
        "daily_target_p95": daily, "host_risk_metrics": risk, "model_backtest": backtest, "model_selection": selection, "forecast_daily": forecast, "risk_probabilities": chances, "actionable": actionable, "conclusion": conclusion,
    }
    counts = sinks.write_bundle(report, f"{to.path}/report")
    # one partitioned write a table, not one job a scope; within a scope the summaries of all and by tag value are one
    by_scope = report | {"util_history": history, "util_trend": trend, "history_summary_all": own, "history_summary_by_as": own, "trend_summary_all": own_trend, "trend_summary_by_as": own_trend, "conclusion": scope_facts}
    for name, table in by_scope.items():
        sinks.write_by_scope(R.scope_of(table).join(scopes, list(R.SCOPE)), f"{to.path}/by_scope/{name}")
    sinks.run_context(spark, asdict(p) | {"source": source}, counts, f"{to.path}/run_context")
    return to


def provision(spark: SparkSession, selected: DataFrame, items: DataFrame, triggers: DataFrame, out: str, p: Params = Params()) -> Folder:
    """What has to be created or changed so that forecast items and triggers are as desired."""
    to = Folder(spark, out)
    targets = selected.filter("source = 'target'")
    specs = to.put("native_items", V.item_specs(targets, p))
    wanted = to.put("native_triggers", V.trigger_specs(specs, p))
    told = V.summary(V.item_diff(specs, tables.existing_items(items, specs)), V.trigger_diff(wanted, tables.existing_triggers(triggers, specs.select("hostid").distinct())))
    to.put("provision_counts", V.action_counts(to.put("provision_summary", told)))
    return to


def inventory(spark: SparkSession, tree: DataFrame, hosts: DataFrame, items: DataFrame, out: str, accounts: D.Accounts | None = None) -> Folder:
    """Sections of the inventory, host summary and labels, and the report by domain. accounts: by domain suffix."""
    to, accounts = Folder(spark, out), accounts or {}
    resolved = to.put("hosts", I.resolve_hosts(I.flatten_tree(tree), hosts.filter("status = '0'")), ("system", "role", "host_ref"))
    ids = resolved.select("hostid").distinct()
    own = items.filter("status = '0'").join(ids, "hostid", "left_semi")
    found = to.put("sections", I.in_order(I.extract(own)), ("hostid", "section", "seq"))
    to.put("host_summary", I.host_summary(resolved, own, found), ("system", "role", "host_ref"))
    to.put("host_labels", I.host_labels(hosts.join(ids, "hostid", "left_semi")), ("hostid",))
    named = resolved.filter("hostid is not null").select("system", "role", "host_ref", "hostid")
    told = to.put("domain_paths", D.domain_paths(named.join(I.found_paths(found), "hostid"), accounts), ("domain", "host_ref", "path"))
    to.put("domain_dirs", D.domain_dirs(told), ("domain", "host", "directory"))
    services = I.section(found, "services").select("hostid", F.col("value").alias("unit"), F.col("detail").alias("field"), "lastvalue", "item_key")
    to.put("domain_services", D.with_domain(named.join(services, "hostid"), accounts), ("domain", "host_ref", "unit"))
    return to


def text_dumps(spark: SparkSession, path: str, out: str) -> Folder:
    """Services, paths and directories of command dumps."""
    to = Folder(spark, out)
    units = to.put("unit_lines", U.unit_lines(tables.dump_lines(spark, path)))
    to.put("services", U.services(units))
    to.put("dirs", U.unit_dirs(to.put("paths", U.unit_paths(units))))
    to.put("errors", U.errors(tables.captures(spark, path)), ("host", "file"))
    return to
