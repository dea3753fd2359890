import os

import pytest
from pyspark.sql import functions as F

from headroom.plans import jobs
from headroom.schemas import Params
from headroom.sources import adapters as X
from headroom.sources import sinks

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")


def test_collect_and_analyse(spark, tmp_path):
    p = Params(horizons=(30, 90, 180, 365), top_k=3)
    src = jobs.collect(spark, X.hosts(spark, SF), X.items(spark, SF), X.trend_raw(spark, SF), f"{tmp_path}/in", p, "2001-07-01 00:00:00")
    assert src.get("util_history").count() == src.get("util_trend").count() > 0
    assert src.get("trend_raw").filter("clock < '2000-07-01'").count() == 0
    assert src.get("trend_errors").select("problem").distinct().collect()[0].problem == "value" and src.counts()["util_trend"] == src.get("util_trend").count()
    out = jobs.analyse(spark, src.path, f"{tmp_path}/out", p)
    actions = out.get("actionable")
    assert actions.count() == out.get("host_risk_metrics").count() == out.get("model_selection").count()
    own = lambda name: spark.read.parquet(f"{out.path}/by_scope/{name}")
    assert own("actionable").count() == actions.count() and own("trend_summary_all").select("clock").distinct().count() == out.get("trend_summary_all").select("clock").distinct().count()
    assert len(os.listdir(f"{out.path}/by_scope")) == 15 and own("conclusion").filter("key = 'matched_hosts'").count() == out.get("scopes").count()
    context = spark.read.json(f"{out.path}/run_context").first()
    assert context.row_counts.actionable == actions.count() and '"top_k": 3' in context.parameters
    assert sinks.read_bundle(spark, f"{out.path}/report", "conclusion")["conclusion"].count() == out.get("conclusion").count()
    again = jobs.checkpointed(spark, f"{tmp_path}/none", src.path)
    assert again["util_history"].count() == src.get("util_history").count() and again["selected_items"].count() == src.get("selected_items").count()
    assert {r.key for r in out.get("conclusion").collect()} >= {"matched_hosts", "cpu_target_items", "status", "overprovisioned_hosts"}
    chart = out.get("forecast_chart")
    assert chart.select("metric", "hostid").distinct().count() == 3 and chart.filter("kind = 'forecast' and (confidence_level is null or prob_cross_90_365d_pct is null)").count() == 0
    assert out.get("risk_probabilities").filter("prob_cross_adjusted_pct > prob_cross_pct + 1e-9").count() == 0
    assert "prob_cross_90_365d_pct" in actions.columns


def test_analyse_nothing(spark, tmp_path):
    out = jobs.analyse(spark, f"{tmp_path}/none", f"{tmp_path}/out")
    assert out.get("actionable").count() == 0 and out.get("conclusion").filter("key = 'matched_hosts'").first().value == "0"


def test_provision_and_inventory(spark, tmp_path):
    d = str(tmp_path)
    items = X.items(spark, SF)
    triggers = spark.createDataFrame([], "triggerid string, description string, expression string, priority int, status string, hosts array<struct<hostid: string, host: string>>, tags array<struct<tag: string, value: string>>")
    to = jobs.provision(spark, X.selected(spark, SF), items, triggers, f"{d}/p")
    assert {r.action for r in to.get("provision_counts").collect()} == {"create"}
    inv = jobs.inventory(spark, X.tree(spark, SF), X.hosts(spark, SF), items, f"{d}/i", X.ACCOUNTS)
    gone = inv.get("host_summary").filter("matched_by = 'host_not_found'")
    assert gone.count() > 0 and gone.filter("item_count > 0 or services is not null").count() == 0
    assert inv.get("domain_dirs").count() > 0 and inv.get("domain_services").filter(F.col("domain") == "example.com").count() > 0
    first = spark.read.parquet(f"{d}/i/sections").select("hostid", "section", "seq").collect()
    assert first == sorted(first, key=lambda r: (r.hostid, r.section, r.seq)) and inv.get("host_labels").filter("templates[0] = 'Web'").count() > 0


def test_text_dumps(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "report_h9.txt").write_text("--- a.service ---\r\nExecStart=/opt/a/bin/run\nActive: active\n/var/log/a/x.log\n")
    (tmp_path / "d" / "report_h8.txt").write_bytes(b"\xff\xfe nothing")
    (tmp_path / "d" / "report_h7.txt").write_text(" \n")
    to = jobs.text_dumps(spark, f"{tmp_path}/d", f"{tmp_path}/o")
    assert [tuple(r) for r in to.get("errors").collect()] == [("h7", "report_h7.txt", "empty file"), ("h8", "report_h8.txt", "no unit found")]
    assert [tuple(r) for r in to.get("services").collect()] == [("h9", "a.service", "Active: active", "")]
    assert sorted(map(tuple, to.get("dirs").collect())) == [("h9", "app_dir", "/opt/a/bin"), ("h9", "log_dir", "/var/log/a")]
