import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from headroom import schemas as S
from headroom.operators import actions, domains, dumps, forecast, forecast_native, hosts, inventory, provisioning, report, risk, selection, series_models, summaries, utilization
from headroom.schemas import Params
from headroom.sources import sinks, tables

KEY = ("cpu", "1", "h", "a", "dev", "non-prod")
DAY = dt.date(2024, 1, 1)


def items(spark, *rows):
    return spark.createDataFrame([(str(i), h, name, key, 0, "0", "", "0", "", "1h", None, 0) for i, h, name, key in rows], S.table(**S.ITEMS))


def daily(spark, series):
    """series: {hostid: values}, None for a missing day."""
    rows = [("cpu", h, f"h{h}", "a", "dev", "non-prod", DAY + dt.timedelta(i), None if v is None else float(v)) for h, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame([r for r in rows if r[-1] is not None], S.table(**S.DAILY))


def test_cpu_scores_and_ties(spark):
    rows = items(spark, (5, "1", "CPU utilization", "system.cpu.util[all,idle,avg5]"), (4, "1", "x", "system.cpu.util"), (9, "2", "x", "system.cpu.util[]"), (7, "2", "x", "system.cpu.util"), (1, "3", "x", "system.cpu.util[,user]"))
    got = {r.hostid: (r.itemid, r.score, r["transform"]) for r in selection.select_cpu(rows).collect()}
    assert got == {"1": ("5", 260, "invert_100"), "2": ("7", 170, "identity")}


def test_ram_without_target_and_disk_preference(spark):
    rows = items(spark, (1, "1", "", "vm.memory.size[pused]"), (2, "2", "", "vm.memory.size[pavailable,x]"), (3, "2", "", "vm.memory.size[pavailable]"),
                 (4, "1", "", "vfs.fs.size[/boot,used]"), (5, "2", "", "vfs.fs.size[/data,pused]"), (6, "2", "", "vfs.fs.size[C:,pused]"), (7, "2", "", "vfs.fs.size[C:,total]"), (8, "3", "", "vfs.fs.size[/,pused]"), (9, "3", "", "vfs.fs.size[CD,pused]"))
    scope = spark.createDataFrame([(h, f"h{h}", "a", "dev", "non-prod") for h in "123"], "hostid string, host string, as_value string, env_value string, env_group string")
    got = {(r.hostid, r.metric, r.source, r.feature): (r.itemid, r.entity) for r in selection.selection(rows, scope, Params(disk_fs=())).collect()}
    assert ("1", "ram", "target", "") not in got and got["1", "ram", "feature", "pused_pct"] == ("1", "")
    assert got["2", "ram", "target", ""] == ("3", "") and got["2", "disk", "target", ""] == ("6", "C:") and got["2", "disk", "feature", "total_bytes"] == ("7", "C:")
    assert got["3", "disk", "target", ""] == ("8", "/") and not any(k[0] == "1" and k[1] == "disk" for k in got)


def test_inverted_trend_swaps_bounds(spark):
    clock = dt.datetime(2024, 1, 1)
    trend = spark.createDataFrame([("1", clock, 1, 10.0, 20.0, 30.0), ("1", clock, 1, None, -5.0, 120.0)], S.table(**S.TREND_RAW))
    chosen = spark.createDataFrame([("7", "h", "a", "dev", "non-prod", "ram", "target", "", "", "1", "k", 0, "invert_100")], S.table(**S.SELECTED))
    got = [tuple(r)[-3:] for r in utilization.util_trend(trend, chosen).orderBy("util_avg").collect()]
    assert got == [(70.0, 80.0, 90.0), (0.0, 100.0, None)]
    assert utilization.util_history(utilization.derive_history(trend, 0, None), chosen.filter("1 = 0")).count() == 0


def test_host_counts_and_percentiles(spark):
    clock = dt.datetime(2024, 1, 1)
    rows = [("cpu", clock, str(i % 3), "h", "a" if i else None, "e", "g", "i", float(i)) for i in range(11)]
    h = spark.createDataFrame(rows, S.table(**S.UTIL_HISTORY))
    r = summaries.summarize_history(h).first()
    assert (r.host_count, r.util_p10, r.util_p90) == (11, 1.0, 9.0)
    assert summaries.summarize_history(h, ("as_value",)).first().host_count == 10  # a null key is no group
    t = spark.createDataFrame([("cpu", clock, str(i % 3), "h", "a", "e", "g", "i", 1, 0.0, float(i), 9.0) for i in range(11)], S.table(**S.UTIL_TREND))
    assert summaries.summarize_trend(t).first().host_count == 3
    assert summaries.summarize_history(h.limit(0)).columns[-1] == "util_p90"


def test_scope_levels_count_each_host_once(spark):
    clock = dt.datetime(2024, 1, 1)
    point = lambda host, a, e, v: ("cpu", clock, host, "h", a, "e", e, "i", 1, 0.0, v, 9.0)
    rows = [point("1", "a", "prod", 1.0), point("1", "a", "dev", 2.0), point("1", "b", "dev", 3.0), point("2", "b", "dev", 3.0), point("2", "b", "dev", 3.0), point(None, "b", "dev", None), point("3", None, "dev", 5.0)]
    t = spark.createDataFrame(rows, S.table(**S.UTIL_TREND))
    got = {(r.level, r.as_value, r.env_group): (r.host_count, r.util_avg_mean, r.util_avg_median) for r in summaries.scope_trend_summaries(t).collect()}
    assert got == {
        ("all", "", ""): (2, 2.4, 3.0), ("tag", "a", ""): (1, 1.5, 1.5), ("tag", "b", ""): (2, 3.0, 3.0),
        ("scope", "a", "prod"): (1, 1.0, 1.0), ("scope", "a", "dev"): (1, 2.0, 2.0), ("scope", "b", "dev"): (2, 3.0, 3.0),
    }
    assert {r.as_value: r.host_count for r in summaries.summarize_trend(t, ("as_value",)).collect()} == {"a": 1, "b": 2}
    assert summaries.summarize_trend(t).first().host_count == 3 and summaries.scope_trend_summaries(t.limit(0)).count() == 0


def test_risk_of_one_point_and_of_zero_mean(spark):
    clock = dt.datetime(2024, 1, 1)
    rows = [("cpu", clock, "1", "h", "a", "e", "g", "i", 0.0), ("cpu", clock, "2", "h", "a", "e", "g", "i", 90.0), ("cpu", clock, "2", "h", "a", "e", "g", "i", None)]
    got = {r.hostid: r for r in risk.risk_metrics(spark.createDataFrame(rows, S.table(**S.UTIL_HISTORY))).collect()}
    assert (got["1"].util_std, got["1"].volatility, got["1"].cluster) == (0.0, None, "warm") and got["1"].overprovisioned
    assert got["2"].point_count == 1 and got["2"].duty_cycle_80 == 0.5 and got["2"].cluster == "hot"


@pytest.mark.parametrize("p50, p95, vol, d80, d90, want", [(50, 85, 0.1, 0, 0, "hot"), (50, 60, 0.1, 0, 0.1, "hot"), (30, 60, 0.4, 0.05, 0, "cold"), (30, 60, 0.5, 0, 0, "warm")])
def test_cluster(spark, p50, p95, vol, d80, d90, want):
    row = spark.createDataFrame([(float(p50), float(p95), float(vol), float(d80), float(d90))], "p50 double, p95 double, volatility double, duty_cycle_80 double, duty_cycle_90 double")
    assert row.select(risk.cluster()).first()[0] == want


def test_grid_fills_gaps(spark):
    got = forecast_native.daily_grid(daily(spark, {"1": [10, None, None, 40, 120], "2": [5]})).orderBy("hostid", "date").collect()
    assert [r.y for r in got] == [10, 20, 30, 40, 100, 5]


def test_series_without_a_grid(spark):
    """Gaps, clipped ends, one day, days that are no number or infinite: the same arrays, with no row for a filled day."""
    days = daily(spark, {"1": [10, None, None, 40, 120], "2": [5], "3": [None, -3, None, 50, float("nan"), 7, None], "4": [float("inf"), None, 101.5, 33.3, None, None, None, 0.1]})
    key = lambda rows: sorted((r.hostid, r.y, r.last, r.first_day) for r in rows.collect())
    got = forecast.series_of_days(days)
    assert key(got) == key(forecast.series_of(forecast_native.daily_grid(days))) and len(key(got)) == 4
    assert key(got)[0][1] == [10, 20, 30, 40, 100]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Generate" not in plan and forecast.series_of_days(days.limit(0)).count() == 0


SERIES = {
    "constant": [50] * 200,
    "rising": list(np.linspace(40, 95, 200)),
    "saw": [20 + 10 * (i % 7) for i in range(200)],
    "five": [1, 2, 3, 4, 5],
    "seven": [1, 2, 3, 4, 5, 6, 9],
    "sixty": [30 + (i * 7) % 11 for i in range(60)],
    "hundred": [30 + (i * 5) % 13 for i in range(100)],
    "fold": [30 + (i * 5) % 13 for i in range(130)],
}


def naive(y, h):
    """Plain seasonal-naive fit: the last week again, and residual quantiles."""
    r = np.abs(y[7:] - y[:-7]) if len(y) >= 7 else np.abs(y - y[-1])
    q90, q95 = np.quantile(r, [0.9, 0.95]) if len(r) else (0.0, 0.0)
    return np.resize(y[-7:], h) if len(y) >= 7 else np.full(h, y[-1]), q90, q95


def brute_trend(y, start, horizon):
    """The reweighted line by least squares, and the median residual of each weekday."""
    x, w = np.arange(len(y), dtype=float), np.ones(len(y))
    for _ in range(8):
        (c, m), *_ = np.linalg.lstsq(np.column_stack([np.ones(len(y)), x]) * w[:, None], y * w, rcond=None)
        r = y - (c + m * x)
        w = 1 / np.maximum(1.0, np.abs(r) / (1.5 * (np.median(np.abs(r)) + 1e-9)))
    day = (start + np.arange(len(y) + horizon) + 3) % 7
    term = [np.median(r[day[: len(y)] == d]) if (day[: len(y)] == d).any() else 0.0 for d in range(7)]
    ahead = np.arange(len(y), len(y) + horizon)
    return np.clip(c + m * ahead + np.array(term)[day[len(y) :]], 0, 100), *np.quantile(np.abs(r), [0.9, 0.95])


def one_boosted(y, start, horizon):
    return series_models.gbdt_lag([y], [start], horizon)[0]


def brute_backtest(y, model, start, h=30, folds=3, least=90):
    """Mean errors by loops over folds and days."""
    rows = []
    for k in range(1, folds + 1):
        split = len(y) - k * h
        if len(y) < least + h or split < least:
            continue
        own = y[:split]
        short = model == "seasonal_naive" or model == "gbdt_lag" and len(own) < series_models.LEAST_DAYS
        p50, q90, _ = naive(own, h) if short else (brute_trend if model == "robust_trend" else one_boosted)(own, start, h)
        e = m = pin = cal = 0.0
        for v, f in zip(y[split : split + h], p50):
            p90 = min(max(f + q90, 0), 100)
            e, m = e + abs(v - f), m + abs(v)
            pin += 0.9 * (v - p90) if v >= p90 else -0.1 * (v - p90)
            cal += v <= p90 + 1e-9
        rows.append((e / m if m > 1e-9 else e / h, e / h, pin / h, cal / h))
    return [sum(x) / len(rows) for x in zip(*rows)] if rows else [math.nan] * 4, len(rows)


def errors_of(r):
    return [math.nan if x is None else x for x in (r.wape, r.mae, r.pinball_p90, r.calibration_p90)]


def test_naive_columns_against_loops(spark):
    grid = forecast_native.daily_grid(daily(spark, SERIES))
    native = {(r.hostid, r.horizon_day): (r.p50, r.p90, r.p95) for r in forecast_native.seasonal_naive(grid, 20).collect()}
    tested = {r.hostid: r for r in forecast_native.seasonal_naive_backtest(grid).collect()}
    for name, values in SERIES.items():
        y = np.clip(np.array(values, float), 0, 100)
        p50, q90, q95 = naive(y, 20)
        for i in range(20):
            assert native[name, i + 1] == pytest.approx((p50[i], min(p50[i] + q90, 100), min(p50[i] + q95, 100)), rel=1e-6)
        want, folds = brute_backtest(y, "seasonal_naive", 0)
        r = tested[name]
        assert r.folds == folds and errors_of(r) == pytest.approx(want, rel=1e-6, nan_ok=True)
    assert tested["hundred"].folds == 0 and tested["fold"].folds == 1 and tested["rising"].folds == 3


def test_backtest_selection_and_forecast_of_series(spark):
    p = Params(horizons=(30, 60))
    grid = forecast.series_of(forecast_native.daily_grid(daily(spark, SERIES))).persist()
    tested = forecast.model_backtest(grid, p).persist()
    start = (DAY - dt.date(1970, 1, 1)).days
    for r in tested.collect():
        want, folds = brute_backtest(np.clip(np.array(SERIES[r.hostid], float), 0, 100), r.model, start)
        assert r.folds == folds and errors_of(r) == pytest.approx(want, rel=1e-6, nan_ok=True)
    assert tested.count() == 3 * len(SERIES)
    selection = forecast.model_selection(tested, grid).persist()
    chosen = {r.hostid: r for r in selection.collect()}
    assert chosen["hundred"].selected_model == "seasonal_naive" and chosen["hundred"].selection_score == 21.0 and chosen["hundred"].series_days == 100
    assert chosen["rising"].selected_model == "robust_trend" and chosen["saw"].selected_model == "seasonal_naive"
    rows = forecast.forecast_daily(grid, selection, p).persist()
    assert rows.count() == 60 * len(SERIES) and rows.filter("p50 > p90 or p90 > p95 or p50 < 0 or p95 > 100").count() == 0
    last = rows.filter("hostid = 'rising' and horizon_day = 1").first()
    assert last.date == DAY + dt.timedelta(200) and last.p50 == pytest.approx(95 + 55 / 199, abs=0.01)
    boosted = forecast.forecast_daily(grid, selection.withColumn("selected_model", F.lit("gbdt_lag")), p)
    got = [r.p50 for r in boosted.filter("hostid = 'saw'").orderBy("horizon_day").collect()]
    assert got == pytest.approx(one_boosted(np.array(SERIES["saw"], float), start, 60)[0])
    for df in (grid, tested, selection, rows):
        df.unpersist()


def brute_stumps(x, y, rounds=80):
    """Plain loops over features and thresholds."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0.05, 0.95, 15))) for j in range(x.shape[1])]
    fit = np.full(len(y), y.mean())
    for _ in range(rounds):
        r, best = y - fit, None
        for j, cs in enumerate(cuts):
            for c in cs:
                left = x[:, j] <= c
                if left.sum() < 8 or (~left).sum() < 8:
                    continue
                loss = ((r[left] - r[left].mean()) ** 2).sum() + ((r[~left] - r[~left].mean()) ** 2).sum()
                if best is None or loss < best[0] - 1e-12:
                    best = (loss, left)
        if best is None:
            break
        fit = fit + 0.08 * np.where(best[1], r[best[1]].mean(), r[~best[1]].mean())
    return np.clip(fit, 0, 100)


def test_forecast_fits_once(spark, tmp_path):
    """The explode's filter on the fitted values must not be pushed below the fit."""
    forecast.series_of(forecast_native.daily_grid(daily(spark, SERIES))).write.parquet(f"{tmp_path}/series")
    series = spark.read.parquet(f"{tmp_path}/series")
    told = forecast.forecast_daily(series, series.withColumn("selected_model", F.lit("gbdt_lag")), Params(horizons=(30,)), tasks=2)
    assert told._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_backtest_hands_a_series_over_once(spark, tmp_path):
    """All folds and models of a series are fitted where it is: no copy of it for each fit goes through a shuffle."""
    forecast.series_of(forecast_native.daily_grid(daily(spark, SERIES))).write.parquet(f"{tmp_path}/series")
    told = forecast.model_backtest(spark.read.parquet(f"{tmp_path}/series"), tasks=2)
    plan = told._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("Repartition") == 1


def test_line_of_any_length_and_first_day():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 5, 8, 40, 41, 300):
        for start in range(7):
            y = np.clip(30 + 0.1 * np.arange(n) + rng.normal(0, 5, n) + 40 * (rng.random(n) < 0.1), 0, 100)
            got, want = series_models.robust_trend(y, start, 9), brute_trend(y, start, 9)
            assert got[0] == pytest.approx(want[0], abs=1e-6) and got[1:] == pytest.approx(want[1:], abs=1e-6)


def day_numbers(h, first):
    return np.broadcast_to(first + np.arange(h.shape[1]), h.shape)


def test_stumps_match_loops():
    rng = np.random.default_rng(0)
    series = [50 + 20 * np.sin(np.arange(n) / 5) + rng.normal(0, 4, n) for n in (130, 90, 74)]
    h = np.full((3, 130), np.nan)
    for row, y in zip(h, series):
        row[130 - len(y) :] = y
    x = series_models.features(h, day_numbers(h, 3))
    for i, y in enumerate(series):
        x[i, : 130 - len(y)] = np.nan
    model = series_models.Stumps(x, [y[series_models.FIRST :] for y in series])
    for i, y in enumerate(series):
        own = x[i, -(len(y) - series_models.FIRST) :]
        assert model.fitted(i) == pytest.approx(brute_stumps(own, y[series_models.FIRST :]), rel=1e-6)
        rows = np.repeat(x[:, -1:], 1, axis=1)[:, 0]
        assert model.predict(rows)[i] == pytest.approx(model.fitted(i)[-1])


def test_series_fitted_together_are_as_alone():
    rng = np.random.default_rng(1)
    series = [np.clip(50 + rng.normal(0, 9, n), 0, 100) for n in (200, 73, 120, 200)] + [np.full(100, 7.0)]
    together = series_models.fit_all(series, [3, 4, 5, 6, 7], 40)
    for y, start, (p50, q90, q95) in zip(series, [3, 4, 5, 6, 7], together):
        alone = one_boosted(y, start, 40)
        assert p50 == pytest.approx(alone[0], rel=1e-9) and (q90, q95) == pytest.approx(alone[1:], rel=1e-9)


def test_shared_days_and_folds_of_a_series():
    """What two candidates share by their codes is that of the days themselves; folds that share features are as fits alone."""
    rng = np.random.default_rng(4)
    series = [np.clip(50 + np.round(rng.normal(0, 9, n)), 0, 100) for n in (300, 210, 90)]
    y = series[0]
    x = series_models.features(y[None], day_numbers(y[None], 3))[0]
    model = series_models.Stumps([x], [y[series_models.FIRST :]])
    left = np.concatenate([x[:, j : j + 1] <= series_models.candidate_cuts(x.T)[j] for j in range(series_models.COLUMNS)], axis=1).astype(int)
    assert (series_models.shared_days(model.codes[0]) == left.T @ left).all()
    splits = [[270, 240, 210], [180], []]
    told = series_models.fit_all(series, [3, 4, 5], 30, splits)
    assert list(map(len, told)) == [3, 1, 0]
    for y, start, own, fits in zip(series, [3, 4, 5], splits, told):
        for split, (p50, q90, q95) in zip(own, fits):
            alone = one_boosted(y[:split], start, 30)
            assert p50.tolist() == alone[0].tolist() and (q90, q95) == alone[1:]


def test_features_match_columns(spark):
    values = [40 + (i * 13) % 29 for i in range(60)]
    h = np.array([values], float)
    x = series_models.features(h, day_numbers(h, (DAY - dt.date(1970, 1, 1)).days))[0]
    rows = forecast_native.lag_features(forecast_native.daily_grid(daily(spark, {"1": values}))).orderBy("date")
    names = [f"lag_{k}" for k in series_models.LAGS] + [f"mean_{w}" for w in series_models.WINDOWS] + [f"std_{w}" for w in series_models.WINDOWS] + ["dow_sin", "dow_cos"]
    got = np.array([[r[c] for c in names] for r in rows.collect()])
    assert got == pytest.approx(x, abs=1e-9)


def test_weighted_trend_on_outliers_and_one_value(spark):
    y = np.linspace(10, 60, 120)
    y[50] = 100
    rows = spark.createDataFrame([(1, y.tolist(), 5), (2, [4.0], 5), (3, [7.0] * 20, 5)], "k int, y array<double>, first_day int")
    fit = {r.k: r.fit for r in forecast_native.with_trend_fit(rows, 10).collect()}
    assert fit[1].p50 == pytest.approx(60 + np.arange(1, 11) * 50 / 119, abs=0.2)
    assert (fit[1].p50, fit[1].q90, fit[1].q95) == (pytest.approx(brute_trend(y, 5, 10)[0].tolist()), *map(pytest.approx, brute_trend(y, 5, 10)[1:]))
    assert fit[2].p50 == [4.0] * 10 and fit[2].q90 == 0.0 and fit[3].p50 == pytest.approx([7.0] * 10)


def crossing_frame(spark, day):
    rows = [(*KEY, DAY + dt.timedelta(i), i + 1, "m", 95.0 if day and i + 1 >= day else 10.0, 96.0 if day and i + 1 >= day - 5 else 10.0, 97.0) for i in range(400)]
    return spark.createDataFrame(rows, S.table(**S.FORECAST))


def risk_frame(spark, cluster="warm", spare=False):
    return spark.createDataFrame([(*KEY, 5, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0, None, cluster, spare)], "metric string, hostid string, host string, as_value string, env_value string, env_group string, point_count long, util_mean double, util_std double, p50 double, p95 double, p99 double, duty_cycle_80 double, duty_cycle_90 double, burstiness double, volatility double, cluster string, overprovisioned boolean")


@pytest.mark.parametrize("day, want", [(29, "critical"), (30, "watch"), (90, "watch"), (91, "stable"), (None, "stable")])
def test_statuses(spark, day, want):
    r = actions.actions(risk_frame(spark), crossing_frame(spark, day)).first()
    assert (r.status, r.days_to_90_basis, r.risk_basis) == (want, day, "p50")


def test_hot_basis_and_spare(spark):
    r = actions.actions(risk_frame(spark, "hot"), crossing_frame(spark, 40)).first()
    assert (r.days_to_90_basis, r.crossing_date_90_basis) == (1, DAY)
    assert actions.actions(risk_frame(spark, "cold", True), crossing_frame(spark, 5)).first().status == "overprovisioned"
    alone = actions.actions(risk_frame(spark), crossing_frame(spark, 5).filter("1 = 0")).first()
    assert (alone.status, alone.days_to_90_basis) == ("stable", None)


def test_probabilities(spark):
    f = crossing_frame(spark, None).withColumn("p50", F.lit(80.0) + F.col("horizon_day") / 50).withColumn("p90", F.col("p50") + 4)
    none = spark.createDataFrame([], "metric string, hostid string, host string, as_value string, env_value string, env_group string, selected_model string, wape double, mae double, pinball_p90 double, calibration_p90 double")
    got = {r.horizon_days: r for r in actions.risk_probabilities(f, none).collect()}
    sigma = 4 / actions.Z90
    stay = 1.0
    for i in range(1, 31):
        stay *= 0.5 * (1 + math.erf((90 - 80 - i / 50) / sigma / math.sqrt(2)))
    assert got[30].prob_cross_pct == pytest.approx(100 * (1 - stay), rel=1e-9) and got[30].confidence_index_pct == 50.0
    assert got[30].prob_cross_adjusted_pct == pytest.approx(0.75 * got[30].prob_cross_pct)
    assert sorted(got) == [30, 90, 180, 365] and got[365].prob_cross_pct >= got[90].prob_cross_pct
    wide = actions.probability_wide(actions.risk_probabilities(f, none)).first()
    assert wide.prob_cross_90_365d_pct == got[365].prob_cross_adjusted_pct


def test_slugs_that_collide(spark):
    scopes = spark.createDataFrame([("x y", "prod"), ("x/y", "prod"), ("", "prod")], "as_value string, env_group string")
    got = {r.as_value: r.as_slug for r in report.with_slugs(scopes).collect()}
    assert got[""] == "empty_as" and got["x y"] != got["x/y"] and got["x y"].startswith("x_y-")


def test_scope_rows_add_up(spark):
    rows = actions.actions(risk_frame(spark), crossing_frame(spark, 30))
    counts = report.bucket_counts(rows).first()
    assert (counts.total, counts.critical_now, counts.critical_soon) == (1, 1, 0)
    assert report.filter_scope(rows, "a", "non-prod").count() == 1
    assert report.top_k(rows, Params(top_k=5)).count() == 1


def test_diff_applied_is_noop(spark):
    target = spark.createDataFrame([("1", "h", "a", "dev", "non-prod", "cpu", "k[,idle]", "invert_100")], "hostid string, host string, as_value string, env_value string, env_group string, metric string, key_ string, transform string")
    specs = provisioning.item_specs(target)
    assert specs.filter("horizon_days = 30").first().params == '100-forecast(//k[,idle],365d,30d,"linear","value")'
    have = specs.withColumn("itemid", F.lit("5"))
    act = lambda e: {r.action for r in provisioning.item_diff(specs, e).collect()}
    assert act(have) == {"noop"} and act(have.limit(0)) == {"create"} and act(have.withColumn("type", F.lit("0"))) == {"skip_conflict"}
    for c in ("name", "delay", "params", "units", "status"):
        assert act(have.withColumn(c, F.lit("other"))) == {"update"}
    triggers = provisioning.trigger_specs(specs)
    assert sorted(r.priority for r in triggers.collect()) == [1, 2, 3, 4]
    assert provisioning.trigger_specs(specs.filter("horizon_days <> 90")).count() == 0
    old = triggers.withColumns({"triggerid": F.lit("1"), "hosts": F.array(F.struct("hostid", "host")), "tags": F.reverse("tags")})
    tact = lambda e: {r.action for r in provisioning.trigger_diff(triggers, e).collect()}
    assert tact(old) == {"noop"} and tact(old.withColumn("priority", F.lit(9))) == {"update"} and tact(old.limit(0)) == {"create"}
    both = sinks.union_of_columns(provisioning.item_diff(specs, have), provisioning.trigger_diff(triggers, old))
    assert {"key_", "description"} <= set(both.columns)


def test_inventory_hosts(spark):
    hosts_ = spark.createDataFrame([("1", "a", "A"), ("2", "b", "a")], "hostid string, host string, name string")
    refs = spark.createDataFrame([("s", "r", x) for x in ("a", "A", "gone")], "system string, role string, host_ref string")
    got = {r.host_ref: (r.hostid, r.matched_by) for r in inventory.resolve_hosts(refs, hosts_).collect()}
    assert got == {"a": ("1", "host"), "A": ("1", "name"), "gone": (None, "host_not_found")}


def test_inventory_dedupe_keeps_first(spark):
    rows = items(spark, (2, "1", "n", 'systemd.unit.info["x.service",State]'), (1, "1", "m", 'systemd.unit.info["x.service",State]'), (3, "1", "n", "proc.num[bash]"), (4, "1", "grafana", "proc.num[bash]"))
    got = inventory.extract(rows).collect()
    services = [(r.value, r.detail, r.item_name) for r in got if r.section == "services"]
    assert sorted(services, key=str) == [("x.service", "State", "m"), (None, "process_count", "grafana")] or sorted(services, key=str) == [(None, "process_count", "grafana"), ("x.service", "State", "m")]


def test_domains(spark):
    row = spark.createDataFrame([("a.b.ru",), (None,)], "h string")
    got = [r[0] for r in row.select(domains.domain_of(F.col("h"), {"ru": "x", "b.ru": "y"}, longest=True)).collect()]
    assert got == ["b.ru", ""] and row.select(domains.domain_of(F.col("h"), {"ru": "x", "b.ru": "y"})).first()[0] == "ru"


def test_dump_units(spark):
    lines = ["==== app01 ====", "/early", "--- nginx.service ---", "ExecStart=/usr/sbin/nginx", "Active: one", "Active: two", "● other", "Main PID: 5"]
    df = spark.createDataFrame([("inventory_x.txt", i, x) for i, x in enumerate(lines)], "file string, line_no int, line string")
    units = dumps.unit_lines(df)
    assert sorted(map(tuple, dumps.services(units).collect())) == [("app01", "nginx.service", "Active: two", ""), ("app01", "other", "", "Main PID: 5")]
    assert sorted((r.kind, r.path) for r in dumps.unit_paths(units).collect()) == [("binary", "/usr/sbin/nginx"), ("exec", "/usr/sbin/nginx")]


def test_tags_and_scope(spark):
    rows = [("1", "a", "A", "0", [("AS", "x"), ("ENV", " Prod ")]), ("2", "b", "B", "1", [("AS", "x")]), ("3", "c", "C", "0", [("AS", "xy")])]
    df = spark.createDataFrame(rows, S.table(**S.HOSTS))
    ids = lambda p: {r.hostid for r in hosts.hosts_by_tag(df, p).collect()}
    assert ids(Params()) == {"1", "3"} and ids(Params(as_values=("x",))) == {"1"} and ids(Params(as_values=("x",), match="contains")) == {"1", "3"}
    r = hosts.host_scope(df).filter("hostid = '1'").first()
    assert (r.as_value, r.env_value, r.env_group) == ("x", "Prod", "prod")
    more = hosts.attach_scope(spark.createDataFrame([("1",), ("9",)], "hostid string"), hosts.host_scope(df)).orderBy("hostid").collect()
    assert [(m.env_value, m.env_group) for m in more] == [("Prod", "prod"), ("", "non-prod")]


def test_sources_and_sinks(spark, tmp_path):
    d = str(tmp_path)
    assert tables.timeseries(spark, f"{d}/none", S.UTIL_HISTORY).count() == 0 and tables.pick_path(spark, f"{d}/none") is None
    (tmp_path / "h.csv").write_text("metric,clock,utilization_pct\ncpu,2024-01-01 00:00:00,5\ncpu,bad,5\ncpu,2024-01-01 01:00:00,x\n")
    got = tables.timeseries(spark, f"{d}/h.csv", S.UTIL_HISTORY).collect()
    assert [r.utilization_pct for r in got] == [5.0, None] and got[0].hostid is None
    (tmp_path / "s.csv").write_text("hostid,itemid\n1,5\n")
    assert tables.selection_report(spark, f"{d}/s.csv").first().metric == ""
    (tmp_path / "r.json").write_text('{"itemid": "1", "clock": "60", "value": "2"}\nbroken\n')
    good, bad = tables.json_records(spark, f"{d}/r.json", {"itemid": "string", "clock": "string", "value": "string", "ns": "string"})
    assert [tuple(r) for r in tables.history_points(good).select("itemid", "value", "ns").collect()] == [("1", 2.0, 0)] and bad.count() == 1
    (tmp_path / "tree.json").write_text('{"sys": {"db": ["a", "b"]}}')
    assert sorted(map(tuple, inventory.flatten_tree(tables.host_tree(spark, f"{d}/tree.json")).collect())) == [("sys", "db", "a"), ("sys", "db", "b")]
    (tmp_path / "dump").mkdir()
    (tmp_path / "dump" / "out_h.txt").write_text("a\nb")
    assert [tuple(r) for r in tables.dump_lines(spark, f"{d}/dump").orderBy("line_no").collect()] == [("out_h.txt", 0, "a"), ("out_h.txt", 1, "b")]
    df = spark.createDataFrame([("h", 1, "x", "prod"), ("g", 2, "y", "prod")], "host string, v int, as_slug string, env_group string")
    sinks.write_by_scope(df, f"{d}/by")
    assert spark.read.parquet(f"{d}/by").filter("as_slug = 'x'").count() == 1
    sinks.write_bundle({"t": df}, f"{d}/report")
    sinks.write(df, f"{d}/report/t", mode="append")
    assert sinks.read_bundle(spark, f"{d}/report", "t")["t"].count() == 4
    assert sinks.run_context(spark, {"a": 1}, {"t": 2}, f"{d}/ctx").first().row_counts == {"t": 2}
    sinks.write(df, f"{d}/csv", fmt="csv")
    assert spark.read.option("header", True).csv(f"{d}/csv").count() == 2


def test_writers_by_size_and_counts_of_writes(spark, tmp_path):
    d = str(tmp_path)
    files = lambda path: len(spark.read.parquet(path).select("_metadata.file_path").distinct().collect())
    wide = spark.range(2000).selectExpr("'one' host", "id", "repeat('x', 92) text", "case when id < 1990 then 'big' else null end as_slug", "'prod' env_group")
    wide.write.parquet(f"{d}/in")
    rows = spark.read.parquet(f"{d}/in")
    assert rows.filter("id = 0").select(sinks.row_bytes(rows)).first()[0] == 3 + 92 + 3 + 4 + 8
    sinks.write_by_scope(rows, f"{d}/out", writer_bytes=20_000)  # some 220,000 bytes of one host and one scope
    assert files(f"{d}/out/as_slug=big") > 4 and files(f"{d}/out/as_slug=__HIVE_DEFAULT_PARTITION__") == 1
    assert spark.read.parquet(f"{d}/out").select(*rows.columns).exceptAll(rows).count() == 0 and spark.read.parquet(f"{d}/out").count() == 2000
    sinks.write_by_scope(rows, f"{d}/small")
    assert files(f"{d}/small/as_slug=big") == 1
    sinks.write_by_scope(rows.limit(0), f"{d}/none")
    assert sinks.write_bundle({"a": rows, "b": rows.filter("id < 7"), "c": rows.filter("1 = 0"), "d": rows.filter("id < -1")}, f"{d}/report") == {"a": 2000, "b": 7, "c": 0, "d": 0}


def test_records_are_points_or_errors(spark, tmp_path):
    raw = [("1", "60", "1", "1", "5", "9"), ("1", "3600000", "x", "1", "6", "9"), (None, "60", "1", "1", "5", "9"), ("2", "bad", "1", "1", "5", "9"), ("2", "60", "1", "1", "NaN", "9"), (None, None, None, None, None, None)]
    df = spark.createDataFrame(raw, "itemid string, clock string, num string, value_min string, value_avg string, value_max string")
    points, errors = sinks.write_records(tables.checked_points(df), f"{tmp_path}/r")
    want = sorted(map(str, tables.trend_points(df).collect()))
    assert sorted(map(str, points.drop("month").select(*S.TREND_RAW).collect())) == want and len(want) == 2
    assert sorted(r.problem for r in errors.collect()) == ["clock", "item", "item", "value"] and points.count() + errors.count() == df.count()
    assert '"value_avg":"NaN"' in errors.filter("problem = 'value'").first().record
    # a window reads its months alone
    chosen = spark.createDataFrame([("1",)], "itemid string")
    window = utilization.in_window(points, chosen, "1970-02-01 00:00:00", "1970-03-01 00:00:00")
    plan = window._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "FileScan" in x)
    assert "month" in scan.split("PartitionFilters: [")[1].split("PushedFilters")[0] and "1970-03" in scan
    assert [r.value_avg for r in window.collect()] == [6.0]


def test_existing_state(spark):
    hosts_ = spark.createDataFrame([("1",)], "hostid string")
    triggers = spark.createDataFrame([("1", "[NativeForecast] x", [("1", "h")]), ("2", "other", [("1", "h")]), ("3", "[NativeForecast] y", [("9", "h")])], "triggerid string, description string, hosts array<struct<hostid: string, host: string>>")
    assert [r.triggerid for r in tables.existing_triggers(triggers, hosts_).collect()] == ["1"]
    assert tables.existing_items(items(spark, (1, "1", "", "k"), (2, "2", "", "k")), hosts_).count() == 1


def test_plans(spark):
    """Points meet the selection by a broadcast join, and grouping sets cost one exchange."""
    clock = dt.datetime(2024, 1, 1)
    trend = spark.createDataFrame([("1", clock, 1, 10.0, 20.0, 30.0)], S.table(**S.TREND_RAW))
    chosen = spark.createDataFrame([], S.table(**S.SELECTED))
    plan = utilization.util_trend(trend, chosen)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "Cartesian" not in plan
    h = spark.createDataFrame([], S.table(**S.UTIL_HISTORY))
    plan = summaries.scope_summaries(h)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_selection_ignores_input_order(spark):
    keys = ("system.cpu.util", "system.cpu.util[,idle]", "system.cpu.util[,idle,avg1]", "vm.memory.size[pavailable]", "vm.memory.size[pavailable,x]", "vfs.fs.size[/a,pused]", "vfs.fs.size[/b,pused]", "vfs.fs.size[/b,free]")
    rows = items(spark, *[(10 * h + i, str(h), "n", k) for h in range(5) for i, k in enumerate(keys * 2)])
    scope = spark.createDataFrame([(str(h), f"h{h}", "a", "dev", "non-prod") for h in range(5)], "hostid string, host string, as_value string, env_value string, env_group string")
    got = [sorted(map(str, selection.selection(r, scope).collect())) for r in (rows, rows.orderBy(F.desc("itemid")), rows.repartition(7, "key_"))]
    assert got[0] == got[1] == got[2] and len(got[0]) > 0


def test_scopes_sum_to_all(spark):
    clock = dt.datetime(2024, 1, 1)
    rows = [("cpu", clock, str(i), "h", f"a{i % 3}", "e", "prod" if i % 2 else "non-prod", "i", float(i)) for i in range(30)]
    r = summaries.scope_summaries(spark.createDataFrame(rows, S.table(**S.UTIL_HISTORY))).groupBy("level").agg(F.sum("host_count").alias("n"), F.count("*").alias("rows")).collect()
    assert {x.level: (x.n, x.rows) for x in r} == {"all": (30, 1), "tag": (30, 3), "scope": (30, 6)}
