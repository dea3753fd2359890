"""Series preparation, the seasonal-naive model, its backtest and linear extrapolation in columns; the reweighted line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import clip
from ..schemas import SERIES, Params
from .fits import fit_of

LAGS = (1, 2, 3, 7, 14, 21, 28)
WINDOWS = (3, 7, 14)


def by_day():
    """Window over a series in order of days."""
    return Window.partitionBy(*SERIES).orderBy("date")


def daily_grid(daily: DataFrame) -> DataFrame:
    """One row a day from a series' first to its last day; gaps are filled linearly, values are clipped.

    Each known day is paired with the next one and writes the days up to it, so a gap costs no window
    over the filled grid.
    """
    rows = daily.dropna(subset=[*SERIES, "date"]).filter(F.col("target_p95").isNotNull() & (F.abs("target_p95") < float("inf")))
    pair = rows.withColumns({"__to": F.lead("date").over(by_day()), "__y": F.lead("target_p95").over(by_day())})
    span = F.datediff("__to", "date")
    days = pair.withColumn("__k", F.explode(F.sequence(F.lit(0), F.coalesce(span - 1, F.lit(0)))))
    value = F.when(F.col("__k") == 0, F.col("target_p95")).otherwise(F.col("target_p95") + (F.col("__y") - F.col("target_p95")) * F.col("__k") / span)
    return days.select(*SERIES, F.date_add("date", F.col("__k")).alias("date"), clip(value).alias("y"))


def lag_features(grid: DataFrame) -> DataFrame:
    """Lags, shifted rolling mean and deviation, weekday sine and cosine; incomplete rows are dropped."""
    out = grid.withColumns({f"lag_{k}": F.lag("y", k).over(by_day()) for k in LAGS})
    for w in WINDOWS:
        over = by_day().rowsBetween(-w, -1)
        full = F.count("y").over(over) == w
        out = out.withColumns({f"mean_{w}": F.when(full, F.avg("y").over(over)), f"std_{w}": F.when(full, F.stddev_samp("y").over(over))})
    angle = F.lit(2 * 3.141592653589793) * F.weekday("date") / 7
    return out.withColumns({"dow_sin": F.sin(angle), "dow_cos": F.cos(angle)}).dropna()


def as_arrays(grid: DataFrame) -> DataFrame:
    """One row a series: its values in order of days (at most one a day) and its last day."""
    days = F.array_sort(F.collect_list(F.struct("date", "y")))
    return grid.groupBy(*SERIES).agg(days.alias("d")).select(*SERIES, F.transform("d", lambda x: x["y"]).alias("y"), F.element_at("d", -1)["date"].alias("last"))


def filled_arrays(daily: DataFrame) -> DataFrame:
    """as_arrays(daily_grid(daily)) without a row for each filled day: gaps are filled in the array of the known days, at most one a day."""
    rows = daily.dropna(subset=[*SERIES, "date"]).filter(F.abs("target_p95") < float("inf"))
    known = rows.groupBy(*SERIES).agg(F.sort_array(F.collect_list(F.struct("date", F.col("target_p95").alias("y")))).alias("d"))

    def until(day: Column, following: Column) -> Column:
        span = F.datediff(following["date"], day["date"])
        return F.transform(F.sequence(F.lit(0), span - 1), lambda k: clip(day["y"] + (following["y"] - day["y"]) * k / span))

    last, gaps = F.element_at("d", -1), F.size("d") - 1
    filled = F.flatten(F.zip_with(F.slice("d", 1, gaps), F.slice("d", 2, gaps), until))
    return known.select(*SERIES, F.concat(filled, F.array(clip(last["y"]))).alias("y"), last["date"].alias("last"))


def quantile(v: Column, q: float) -> Column:
    """Linearly interpolated quantile of a sorted array; 0 of an empty one."""
    at = (F.size(v) - 1) * F.lit(q)
    low, high = F.get(v, F.floor(at).cast("int")), F.get(v, F.ceil(at).cast("int"))
    return F.when(F.size(v) > 0, low + (high - low) * (at - F.floor(at))).otherwise(0.0)


def weekly_residuals(y: Column, n: Column) -> Column:
    """|y[t] - y[t-7]| of an array of n >= 7 values."""
    return F.zip_with(F.slice(y, 8, F.greatest(n - 7, F.lit(0))), F.slice(y, 1, F.greatest(n - 7, F.lit(0))), lambda a, b: F.abs(a - b))


def _naive_parts(y: Column) -> tuple[Column, Column]:
    """(the last week, or the last value of a short series; the sorted residuals of the same weekday)."""
    n = F.size(y)
    few = n < 7
    residual = F.when(few, F.transform(y, lambda v: F.abs(v - F.element_at(y, -1)))).otherwise(weekly_residuals(y, n))
    return F.when(few, F.slice(y, n, 1)).otherwise(F.slice(y, F.greatest(n - 6, F.lit(1)), 7)), F.array_sort(residual)


def with_naive_fit(rows: DataFrame, days: int) -> DataFrame:
    """rows (y, ...) with the struct `fit`: p50 (array), the last week repeated, and the residual quantiles."""
    week, residual = _naive_parts(F.col("y"))
    # columns of their own, else they would be computed for every day
    parts = rows.withColumns({"__week": week, "__r": residual})
    p50 = F.transform(F.sequence(F.lit(0), F.lit(days - 1)), lambda i: F.get("__week", F.pmod(i, F.size("__week"))))
    fit = F.struct(p50.alias("p50"), quantile(F.col("__r"), 0.9).alias("q90"), quantile(F.col("__r"), 0.95).alias("q95"))
    return parts.withColumn("fit", fit).drop("__week", "__r")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def with_trend_fit(rows: DataFrame, days: int) -> DataFrame:
    """rows (y, first_day, ...) with the struct `fit` of the reweighted line plus the median residual of each weekday."""
    return rows.withColumn("fit", fit_of(F.col("y"), F.col("first_day"), F.lit("robust_trend"), days))


def seasonal_naive(grid: DataFrame, days: int) -> DataFrame:
    """Forecast rows of the last week repeated, with bands from the residuals of the same weekday.

    A series is one array, so all of it costs one shuffle by series; no window, no join.
    """
    week, residual = _naive_parts(F.col("y"))
    rows = as_arrays(grid).withColumns({"r": residual, "week": week})
    bands = rows.select(*SERIES, "last", "week", quantile(F.col("r"), 0.9).alias("q90"), quantile(F.col("r"), 0.95).alias("q95"))
    # in a select of its own: beside an explode the bands would be computed for every day
    told = bands.withColumn("horizon_day", F.explode(F.sequence(F.lit(1), F.lit(days))))
    p50 = F.get("week", F.pmod(F.col("horizon_day") - 1, F.size("week")))
    return told.select(*SERIES, F.expr("date_add(last, horizon_day)").alias("date"), "horizon_day", F.lit("seasonal_naive").alias("model"), p50.alias("p50"), clip(p50 + F.col("q90")).alias("p90"), clip(p50 + F.col("q95")).alias("p95"))


def fold_splits(p: Params = Params()) -> Column:
    """Days before the test of each fold, of the array `y`; none of a series that is too short."""
    n = F.size("y")
    return F.filter(F.transform(F.array(*[F.lit(k) for k in range(1, p.folds + 1)]), lambda k: n - k * p.fold_days), lambda s: (s >= p.min_train) & (n >= p.min_train + p.fold_days))


def fold_errors(fits: DataFrame, h: int) -> DataFrame:
    """fits (test and p50 of h days, q90, ...) with the four errors for these."""
    error = fits.withColumns({"e": F.zip_with("test", "p50", lambda v, f: F.abs(v - f)), "d": F.zip_with("test", "p50", lambda v, f: v - clip(f + F.col("q90")))})
    total = _total
    mass = total(F.transform("test", lambda v: F.abs(v)))
    return error.select(
        *[c for c in fits.columns if c not in ("test", "p50", "q90")],
        F.when(mass <= 1e-9, total(F.col("e")) / h).otherwise(total(F.col("e")) / mass).alias("wape"),
        (total(F.col("e")) / h).alias("mae"),
        (total(F.transform("d", lambda d: F.when(d >= 0, 0.9 * d).otherwise(-0.1 * d))) / h).alias("pinball_p90"),
        # a value on its band is inside, whatever its last bits say
        (F.size(F.filter("d", lambda d: d <= 1e-9)) / h).alias("calibration_p90"),
    )


def seasonal_naive_backtest(grid: DataFrame, p: Params = Params()) -> DataFrame:
    """Mean errors of the seasonal-naive model over the folds of each series; nulls where it is too short."""
    h = p.fold_days
    folds = as_arrays(grid).select(*SERIES, "y", F.explode_outer(fold_splits(p)).alias("split"))
    cut = folds.select(*SERIES, "split", F.slice("y", F.col("split") + 1, h).alias("test"), F.slice("y", 1, F.col("split")).alias("y"))
    per = fold_errors(with_naive_fit(cut, h).select(*SERIES, "split", "test", "fit.p50", "fit.q90"), h)
    return per.groupBy(*SERIES).agg(F.lit("seasonal_naive").alias("model"), *[F.avg(c).alias(c) for c in ("wape", "mae", "pinball_p90", "calibration_p90")], F.count("split").alias("folds"))


def linear_forecast(points: DataFrame, horizons: tuple[int, ...], transform: Column | None = None) -> DataFrame:
    """Straight line through the points (series, date, y) carried on by each horizon; inverted series count down from 100."""
    day = F.datediff("date", F.lit("1970-01-01").cast("date")).cast("double")
    fit = points.withColumn("__d", day).groupBy(*SERIES).agg(F.regr_slope("y", "__d").alias("slope"), F.regr_intercept("y", "__d").alias("intercept"), F.max("__d").alias("last"))
    value = lambda h: F.col("intercept") + F.col("slope") * (F.col("last") + h)
    turned = (lambda x: F.when(transform == "invert_100", 100 - x).otherwise(x)) if transform is not None else (lambda x: x)
    return fit.select(*SERIES, *[turned(value(h)).alias(f"f{h}") for h in horizons])


def risk_windows(linear: DataFrame, threshold: float) -> DataFrame:
    """Which of the four windows fires: each horizon reaches the threshold and the one before doesn't."""
    at = lambda h: F.coalesce(F.col(f"f{h}") >= threshold, F.lit(False))
    return linear.select(*SERIES, at(30).alias("risk_30d"), (at(90) & ~at(30)).alias("risk_90d"), (at(180) & ~at(90)).alias("risk_180d"), (at(365) & ~at(180)).alias("risk_365d"))
