"""The registered queries: every job over the tables that adapters derive from the given ones."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import paths as P
from ..functions import scalars as C
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
from ..schemas import SERIES, Params
from ..sources import adapters as X
from ..sources import sinks as W
from ..sources import tables as T_
from ..streaming import ingest as G

Query = Callable[[SparkSession, str], DataFrame]
PARAMS = Params()


def plain(df: DataFrame) -> DataFrame:
    """Doubles to 6 places, dates and timestamps to text, so that engines compare."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c + 0.0, 6)
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def _folder(s: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors see. Only a local session without one gets a temporary folder."""
    shared = s.conf.get("spark.checkpoint.dir", None) or (s.conf.get("spark.sql.warehouse.dir") if not s.sparkContext.master.startswith("local[") else tempfile.mkdtemp(prefix="headroom-"))
    path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    p = s.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(s.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return path


def _kept(s: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """df written and read back, for what a query uses more than once. It goes when the application ends."""
    path = f"{_folder(s, name)}/table"
    df.write.parquet(path)
    return s.read.parquet(path)


def _daily(s: SparkSession, d: str) -> DataFrame:
    return K.daily_p95(X.load(s, d))


def _grid(s: SparkSession, d: str) -> DataFrame:
    return N.daily_grid(_daily(s, d))


def _naive(s: SparkSession, d: str) -> DataFrame:
    return N.seasonal_naive(_grid(s, d), max(PARAMS.horizons))


def _risk(s: SparkSession, d: str) -> DataFrame:
    return K.risk_metrics(X.load(s, d))


def _actions(s: SparkSession, d: str) -> DataFrame:
    return A.actions(_risk(s, d), _naive(s, d))


def _naive_selection(s: SparkSession, d: str) -> DataFrame:
    return N.seasonal_naive_backtest(_grid(s, d)).withColumnRenamed("model", "selected_model")


def _probabilities(s: SparkSession, d: str) -> DataFrame:
    return A.risk_probabilities(_naive(s, d), _naive_selection(s, d))


def _series(s: SparkSession, d: str) -> DataFrame:
    return _kept(s, "series", M.series_of_days(_daily(s, d)))


def _selected(s: SparkSession, series: DataFrame) -> DataFrame:
    return _kept(s, "selection", M.model_selection(M.model_backtest(series), series))


def _selection(s: SparkSession, d: str) -> DataFrame:
    return _selected(s, _series(s, d))


def _forecast(s: SparkSession, d: str) -> DataFrame:
    series = _series(s, d)
    return M.forecast_daily(series, _selected(s, series))


def _selected_actions(s: SparkSession, d: str) -> DataFrame:
    """Risk, crossings, probabilities and actions of every series by its selected model."""
    series = _series(s, d)
    selection = _selected(s, series)
    forecast = _kept(s, "forecast", M.forecast_daily(series, selection))
    return A.complete_actions(A.actions(_risk(s, d), forecast), A.risk_probabilities(forecast, selection))


def _targets(s: SparkSession, d: str) -> DataFrame:
    return X.selected(s, d).filter("source = 'target'")


def _specs(s: SparkSession, d: str) -> DataFrame:
    return V.item_specs(_targets(s, d))


def _existing_items(s: SparkSession, d: str) -> DataFrame:
    """Specs of even hosts; every third host with one field changed, or of another type."""
    rows = _specs(s, d).filter("cast(hostid as long) % 2 = 0")
    n = F.col("hostid").cast("long")
    return rows.select(
        "hostid", "key_", (n * 1000 + F.col("horizon_days")).cast("string").alias("itemid"), "name", "params", "units", "status", "value_type",
        F.when(n % 3 == 0, "2h").otherwise(F.col("delay")).alias("delay"), F.when(n % 10 == 4, "0").otherwise(F.col("type")).alias("type"),
    )


def _triggers(s: SparkSession, d: str) -> DataFrame:
    return V.trigger_specs(_specs(s, d))


def _existing_triggers(s: SparkSession, d: str) -> DataFrame:
    n = F.col("hostid").cast("long")
    return _triggers(s, d).filter(n % 2 == 0).select(
        (n * 10 + F.col("priority")).cast("string").alias("triggerid"), "description", "expression", F.when(n % 3 == 0, F.col("priority") + 1).otherwise(F.col("priority")).alias("priority"), "status",
        F.array(F.struct("hostid", "host")).alias("hosts"), F.reverse("tags").alias("tags"),
    )


def _item_diff(s: SparkSession, d: str) -> DataFrame:
    return V.item_diff(_specs(s, d), _existing_items(s, d))


def _trigger_diff(s: SparkSession, d: str) -> DataFrame:
    return V.trigger_diff(_triggers(s, d), _existing_triggers(s, d))


def _linear(s: SparkSession, d: str) -> DataFrame:
    return N.linear_forecast(_grid(s, d), PARAMS.horizons, F.when(F.col("hostid") == "1", "invert_100").otherwise("identity"))


def _resolved(s: SparkSession, d: str) -> DataFrame:
    return I.resolve_hosts(I.flatten_tree(X.tree(s, d)), X.hosts(s, d).filter("status = '0'"))


def _own_items(s: SparkSession, d: str) -> DataFrame:
    ids = _resolved(s, d).filter("hostid is not null").select("hostid").distinct()
    return X.items(s, d).filter("status = '0'").join(ids, "hostid", "left_semi")


def _extracted(s: SparkSession, d: str) -> DataFrame:
    return I.extract(_own_items(s, d))


def _section(name: str) -> Query:
    return lambda s, d: I.section(_extracted(s, d), name).drop("section")


def _paths(s: SparkSession, d: str) -> DataFrame:
    rows = I.found_paths(_extracted(s, d)).drop("excerpt")
    return _resolved(s, d).filter("hostid is not null").select("system", "role", "host_ref", "hostid").join(rows, "hostid").drop("hostid")


def _services(s: SparkSession, d: str) -> DataFrame:
    rows = I.section(_extracted(s, d), "services").select("hostid", F.col("value").alias("unit"), F.col("detail").alias("field"), "item_key")
    return _resolved(s, d).filter("hostid is not null").select("system", "role", "host_ref", "hostid").join(rows, "hostid").drop("hostid")


def _units(s: SparkSession, d: str) -> DataFrame:
    """Property lines of one unit a host."""
    lines = F.array(
        F.concat(F.lit("ExecStart={ path=; argv[]= /usr/bin/tool"), "hostid", F.lit(" -x }")),
        F.lit("FragmentPath=/usr/lib/systemd/system/app.service"),
        F.concat(F.lit("EnvironmentFile=/etc/app/app.conf /opt/app"), "hostid", F.lit("/env")),
        F.lit("ActiveState=old"),
        F.lit("ActiveState=active"),
    )
    return X.hosts(s, d).select("host", F.lit("app.service").alias("unit"), lines.alias("lines"))


def _known_paths(s: SparkSession, d: str) -> DataFrame:
    rows = _extracted(s, d).filter("section = 'paths_found_in_items'").select("hostid", F.concat(F.lit(" "), "value").alias("path"), F.when(F.col("detail") != "other", F.col("detail")).alias("kind"))
    return D.loaded_paths(X.hosts(s, d).select("hostid", "host").join(rows, "hostid").select("host", "path", "kind")).distinct()


def _verified(s: SparkSession, d: str) -> DataFrame:
    rows = _known_paths(s, d)
    return rows.select("host", "path", P.file_kind(F.col("path")).alias("kind"), F.when(F.length("path") % 5 == 0, "no").otherwise("yes").alias("exists"), F.when(F.length("path") % 3 == 0, "dir").otherwise("file").alias("type"))


def _status_tables(s: SparkSession, d: str) -> list[DataFrame]:
    first = X.hosts(s, d).select(F.upper("host").alias("Host"), F.when(F.col("status") == "0", "Monitored").otherwise("Not monitored").alias("Status"))
    second = X.hosts(s, d).filter("cast(hostid as long) % 7 = 3").select(F.col("host").alias("Host Ref"), F.lit(" Disabled ").alias("Host Status"))
    return [first, second]


def _unit_lists(s: SparkSession, d: str) -> DataFrame:
    rows = _services(s, d).select(F.col("host_ref").alias("host"), "unit")
    return I.unit_lists(rows, I.host_status(*_status_tables(s, d)))


def _dump_units(s: SparkSession, d: str) -> DataFrame:
    return U.unit_lines(X.dumps(s, d))


def _path_kinds(s: SparkSession, d: str) -> DataFrame:
    rows = _extracted(s, d).filter("section = 'paths_found_in_items'").select(F.col("value").alias("path")).distinct()
    p = F.col("path")
    return rows.select("path", P.item_path_kind(p).alias("item_kind"), P.file_kind(p).alias("file_kind"), P.dump_kind(p).alias("dump_kind"), P.directory_kind(P.file_kind(p)).alias("dir_kind"), P.parent(p).alias("parent"))


def _page_paths(s: SparkSession, d: str) -> DataFrame:
    """Paths in the addresses of all pages, with the quirk that a host counts as a part."""
    rows = X.read(s, d, "pages").select("page_id", F.explode(P.item_paths(F.col("url"))).alias("path"))
    return rows.groupBy("path").agg(F.count(F.lit(1)).alias("n"))


def _top(s: SparkSession, d: str) -> DataFrame:
    return R.top_k(_actions(s, d)).select("metric", "hostid", "host", "status", "days_to_90_basis")


def _conclusion(s: SparkSession, d: str) -> DataFrame:
    history, trend = X.util_history(s, d), X.util_trend(s, d)
    summary = Y.summarize_history(history)
    return R.conclusion(
        Y.host_count(history, trend), S.selected_counts(X.selected(s, d)), Y.latest_status(summary), Y.week_delta(Y.daily_means(Y.summarize_trend(trend))), _risk(s, d), _actions(s, d), _naive_selection(s, d)
    )


def _scope_facts(s: SparkSession, d: str) -> DataFrame:
    """The facts of each scope."""
    by = R.SCOPE
    history, trend = X.util_history(s, d), X.util_trend(s, d)
    own = lambda rows: rows.filter("level = 'scope'")
    delta = Y.week_delta(Y.daily_means(own(Y.scope_trend_summaries(trend)), by=by), by)
    return R.conclusion(Y.host_count(history, trend, by), S.selected_counts(X.selected(s, d), by), Y.latest_status(own(Y.scope_summaries(history)), by), delta, _risk(s, d), _actions(s, d), _naive_selection(s, d), by)


def _report_tables(s: SparkSession, d: str) -> dict[str, DataFrame]:
    return {"selected_items": X.selected(s, d), "host_risk_metrics": _risk(s, d), "actionable": _actions(s, d)}


def _bundle(s: SparkSession, d: str) -> DataFrame:
    """A report bundle written and read back: rows and columns of its tables."""
    path = _folder(s, "report")
    tables = _report_tables(s, d)
    W.write_bundle(tables, path)
    back = W.read_bundle(s, path, *tables)
    return W.row_counts(back).withColumn("columns", F.element_at(F.create_map(*[F.lit(x) for n, t in back.items() for x in (n, len(t.columns))]), F.col("name")))


def _run_context(s: SparkSession, d: str) -> DataFrame:
    """Parameters and row counts of a run, one row a table, counted as the report is written."""
    counts = W.write_bundle(_report_tables(s, d), _folder(s, "run"))
    row = W.run_context(s, {"horizons": PARAMS.horizons, "threshold": PARAMS.threshold}, counts)
    return row.select("parameters", F.explode("row_counts").alias("name", "n"))


def _by_scope(s: SparkSession, d: str) -> DataFrame:
    """Tables written by scope folders and read back: rows of each folder."""
    path = _folder(s, "by-scope")
    # written once: the scopes are measured before they are dealt to writers
    tables = {name: _kept(s, name, table) for name, table in _report_tables(s, d).items()}
    scopes = R.scope_list(*tables.values())
    out = []
    for name, table in tables.items():
        W.write_by_scope(R.scope_of(table).join(scopes, list(R.SCOPE)), f"{path}/{name}")
        out.append(s.read.parquet(f"{path}/{name}").groupBy("as_slug", "env_group").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), F.col("as_slug").cast("string").alias("as_slug"), "env_group", "n"))
    return reduce(DataFrame.unionByName, out)


def _ingest(s: SparkSession, d: str) -> DataFrame:
    """The stream over files of raw points, then what its sink holds after it is compacted. The points come twice, as after a re-delivery."""
    root = _folder(s, "ingest")
    X.trend_raw(s, d).write.parquet(f"{root}/raw")
    s.read.parquet(f"{root}/raw").write.mode("append").parquet(f"{root}/raw")
    # the selection is a table of its own, as in production: no batch computes it again
    X.selected(s, d).write.parquet(f"{root}/selected")
    # at any size a few batches, whose points are of all years
    files = max(1, -(-len(s.read.parquet(f"{root}/raw").inputFiles()) // 3))
    G.ingest(s, f"{root}/raw", s.read.parquet(f"{root}/selected"), f"{root}/out", f"{root}/state", files).awaitTermination()
    G.compact(s, f"{root}/out")
    points = G.table(s, f"{root}/out", "util_trend").groupBy("metric", "hostid").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("clock").alias("hours"), F.sum("num").alias("num"), F.avg("util_min").alias("util_min"), F.avg("util_avg").alias("util_avg"), F.avg("util_max").alias("util_max")
    )
    days = G.daily(s, f"{root}/out").groupBy("metric", "hostid").agg(F.count(F.lit(1)).alias("days"), F.avg("target_p95").alias("target_p95"))
    return _off_ties(points.join(days, ["metric", "hostid"]))


def _stored_points(s: SparkSession, d: str) -> DataFrame:
    """Raw records written in one pass as points by month and rejected records; what a window of the points and the errors hold."""
    points, errors = W.write_records(T_.checked_points(X.trend_raw(s, d)), f"{_folder(s, 'records')}/table")
    year = Z.between(points, "2000-01-01 00:00:00", "2000-12-31 23:59:59")
    return year.groupBy(F.lit("point").alias("kind"), F.col("month").alias("key")).agg(F.count(F.lit(1)).alias("n")).unionByName(errors.groupBy(F.lit("error").alias("kind"), F.col("problem").alias("key")).agg(F.count(F.lit(1)).alias("n")))


def _normalize(s: SparkSession, d: str) -> DataFrame:
    return X.trend(s, d)


def _history(s: SparkSession, d: str) -> DataFrame:
    return Z.derive_history(X.trend(s, d), 0, None)


def _window(s: SparkSession, d: str) -> DataFrame:
    rows = Z.in_window(X.trend(s, d), X.selected(s, d), "2000-01-01 00:00:00", "2000-12-31 00:00:00")
    return rows.groupBy("itemid").agg(F.count(F.lit(1)).alias("n"), F.max("clock").alias("last"), F.avg("value_avg").alias("value_avg"))


def _recent_history(s: SparkSession, d: str) -> DataFrame:
    rows = Z.derive_history(X.trend(s, d), 30, F.to_timestamp(F.lit("2001-07-01 00:00:00")))
    return rows.groupBy("itemid").agg(F.count(F.lit(1)).alias("n"), F.sum("ns").alias("ns"))


def _off_ties(df: DataFrame) -> DataFrame:
    """Doubles a billionth up: many here are binary fractions, ties at the sixth place that engines may break either way."""
    return df.withColumns({n: F.col(n) + 1e-9 for n, kind in df.dtypes if kind == "double"})


def _features(s: SparkSession, d: str) -> DataFrame:
    return _off_ties(N.lag_features(_grid(s, d)).drop("host", "as_value", "env_value", "env_group"))


def _scope_slugs(s: SparkSession, d: str) -> DataFrame:
    return R.scope_list(X.util_history(s, d), X.util_trend(s, d), _actions(s, d), X.selected(s, d))


QUERIES: dict[str, Query] = {
    "hosts_by_tag": lambda s, d: H.hosts_by_tag(X.hosts(s, d), Params(as_values=("AS-1", "AS-9"))).select("hostid", "host"),
    "hosts_by_tag_part": lambda s, d: H.hosts_by_tag(X.hosts(s, d), Params(as_values=("9", "-2"), match="contains")).select("hostid", "host"),
    "host_scope": lambda s, d: X.scope(s, d, Params()),
    "select_cpu_items": lambda s, d: S.select_cpu(X.items(s, d).filter("status = '0'")),
    "select_ram_items": lambda s, d: S.select_ram(X.items(s, d).filter("status = '0'")),
    "select_disk_items": lambda s, d: S.select_disk(X.items(s, d).filter("status = '0'")),
    "selection_report": X.selected,
    "selected_counts": lambda s, d: S.selected_counts(X.selected(s, d)),
    "normalize_trend": _normalize,
    "points_in_window": _window,
    "stored_points": _stored_points,
    "derive_history": _recent_history,
    "util_trend": lambda s, d: Z.util_trend(X.trend(s, d), X.selected(s, d)),
    "util_history": lambda s, d: Z.util_history(_history(s, d), X.selected(s, d)),
    "feature_trend": lambda s, d: Z.feature_trend(X.trend(s, d), X.selected(s, d)),
    "feature_history": lambda s, d: Z.feature_history(_history(s, d), X.selected(s, d)),
    "attach_scope": lambda s, d: H.attach_scope(X.items(s, d).select("itemid", "hostid"), X.scope(s, d)),
    "history_summary_all": lambda s, d: Y.summarize_history(X.util_history(s, d)),
    "history_summary_by_tag": lambda s, d: Y.summarize_history(X.util_history(s, d), ("as_value",)),
    "trend_summary_all": lambda s, d: Y.summarize_trend(X.util_trend(s, d)),
    "trend_summary_by_tag": lambda s, d: Y.summarize_trend(X.util_trend(s, d), ("as_value",)),
    "scope_summaries": lambda s, d: Y.scope_summaries(X.util_history(s, d)),
    "scope_trend_summaries": lambda s, d: Y.scope_trend_summaries(X.util_trend(s, d)),
    "tag_breakdown": lambda s, d: Y.tag_breakdown(Y.summarize_history(X.util_history(s, d), ("as_value",))),
    "daily_p95": lambda s, d: K.daily_p95(X.util_history(s, d)),
    "risk_metrics": lambda s, d: K.risk_metrics(X.util_history(s, d)),
    "risk_counts": lambda s, d: K.risk_counts(K.risk_metrics(X.util_history(s, d))),
    "host_count": lambda s, d: Y.host_count(X.util_history(s, d), X.util_trend(s, d)),
    "host_count_by_scope": lambda s, d: Y.host_count(X.util_history(s, d), X.util_trend(s, d), ("as_value", "env_group")),
    "metric_latest_status": lambda s, d: Y.latest_status(Y.summarize_history(X.util_history(s, d))),
    "trend_week_delta": lambda s, d: Y.week_delta(Y.daily_means(Y.summarize_trend(X.util_trend(s, d)))),
    "metrics_union": lambda s, d: Y.unioned_metrics(X.util_history(s, d), X.util_trend(s, d)),
    "heat_map": lambda s, d: Y.heat_map(X.util_history(s, d)),
    "daily_grid": lambda s, d: _off_ties(_grid(s, d)),
    "lag_features": _features,
    "seasonal_naive_forecast": _naive,
    "seasonal_naive_backtest": lambda s, d: N.seasonal_naive_backtest(_grid(s, d)),
    "robust_trend_backtest": lambda s, d: M.model_backtest(_series(s, d), models=("robust_trend",)),
    "model_backtest": lambda s, d: M.model_backtest(_series(s, d)),
    "model_selection": _selection,
    "forecast_daily": _forecast,
    "selected_actions": _selected_actions,
    "days_to_threshold": lambda s, d: A.crossings(_naive(s, d)),
    "actions": _actions,
    "risk_probabilities": lambda s, d: R.with_confidence_level(_probabilities(s, d)),
    "probability_wide": lambda s, d: A.probability_wide(_probabilities(s, d)),
    "complete_actions": lambda s, d: A.complete_actions(_actions(s, d), _probabilities(s, d)),
    "confidence_index": lambda s, d: _naive_selection(s, d).select(*SERIES, C.confidence_index(F.col("wape"), F.col("pinball_p90"), F.col("calibration_p90")).alias("confidence_index_pct"), C.selection_score(F.col("wape"), F.col("pinball_p90"), F.col("calibration_p90")).alias("selection_score")),
    "horizon_buckets": lambda s, d: R.bucket_counts(_actions(s, d)),
    "status_counts": lambda s, d: R.status_counts(_actions(s, d)),
    "top_k_actions": _top,
    "forecast_chart": lambda s, d: R.forecast_chart(_grid(s, d), _naive(s, d), _top(s, d), _probabilities(s, d)),
    "action_labels": lambda s, d: R.labelled(_actions(s, d)),
    "scope_list": _scope_slugs,
    "scope_conclusion": lambda s, d: R.conclusion_lines(_actions(s, d), _probabilities(s, d)),
    "conclusion": _conclusion,
    "scope_facts": _scope_facts,
    "report_bundle": _bundle,
    "run_context": _run_context,
    "by_scope": _by_scope,
    "forecast_item_specs": _specs,
    "trigger_specs": lambda s, d: _triggers(s, d).withColumn("tags", F.array_join(V.sorted_tags(F.col("tags")), ";")),
    "item_diff": _item_diff,
    "trigger_diff": _trigger_diff,
    "provision_counts": lambda s, d: V.action_counts(V.summary(_item_diff(s, d), _trigger_diff(s, d))),
    "linear_forecast": _linear,
    "risk_windows": lambda s, d: N.risk_windows(_linear(s, d), 45.0),
    "host_tree": lambda s, d: I.flatten_tree(X.tree(s, d)),
    "resolve_hosts": _resolved,
    "inv_services": _section("services"),
    "inv_filesystems": _section("filesystems"),
    "inv_devices": _section("block_devices"),
    "inv_interfaces": _section("network_interfaces"),
    "inv_ssl": _section("ssl_targets"),
    "inv_paths": lambda s, d: I.found_paths(_extracted(s, d)),
    "inv_raw": _section("raw_service_related_items"),
    "inv_in_order": lambda s, d: I.in_order(_extracted(s, d)).select("hostid", "section", "seq", "value", "detail", "item_name", "item_key"),
    "host_labels": lambda s, d: I.host_labels(X.hosts(s, d)).select("hostid", *[F.array_join(c, ";").alias(c) for c in ("templates", "groups", "tags")]),
    "scan_errors": lambda s, d: U.errors(X.captures(s, d)),
    "inv_summary": lambda s, d: I.host_summary(_resolved(s, d), _own_items(s, d), _extracted(s, d)),
    "domain_services": lambda s, d: D.with_domain(_services(s, d), X.ACCOUNTS),
    "domain_longest": lambda s, d: D.with_domain(_resolved(s, d).select("system", "role", "host_ref"), X.ACCOUNTS, longest=True),
    "domain_paths": lambda s, d: D.domain_paths(_paths(s, d), X.ACCOUNTS),
    "domain_dirs": lambda s, d: D.domain_dirs(D.domain_paths(_paths(s, d), X.ACCOUNTS)),
    "path_kinds": _path_kinds,
    "page_paths": _page_paths,
    "derived_paths": lambda s, d: D.derived_paths(_known_paths(s, d), _units(s, d)),
    "verified_dirs": lambda s, d: D.verified_dirs(_verified(s, d)),
    "host_status": lambda s, d: I.host_status(*_status_tables(s, d)),
    "unit_lists": _unit_lists,
    "text_units": lambda s, d: U.services(_dump_units(s, d)),
    "text_paths": lambda s, d: U.unit_paths(_dump_units(s, d)),
    "text_dirs": lambda s, d: U.unit_dirs(U.unit_paths(_dump_units(s, d))),
    "ingest_stream": _ingest,
}


def queries() -> dict[str, Query]:
    return {name: (lambda s, d, q=q: plain(q(s, d))) for name, q in QUERIES.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily p95 to actions: the whole of the risk workload over one utilization table."""
    return plain(_actions(spark, sf_dir))
