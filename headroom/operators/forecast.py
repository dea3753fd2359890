"""Backtest, selection and forecast of every series.

A series is one array of days, dealt out evenly and handed to numpy once for all its fits (one for each
model and fold). The errors and the choice are columns. The forecast fits the chosen model alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clip, selection_score
from ..schemas import SERIES, Params
from .fits import fit_of, fits
from .forecast_native import as_arrays, filled_arrays, fold_errors, fold_splits

MODELS = ("seasonal_naive", "robust_trend", "gbdt_lag")
ERRORS = ("wape", "mae", "pinball_p90", "calibration_p90")
#: Series that a task gets at least, and at most: these are in one Arrow batch.
LEAST_SERIES, MOST_SERIES = 8, 512


def _dealt(rows: DataFrame, n: int, tasks: int | None) -> DataFrame:
    """n rows, in turn: few would fall unevenly by a hash, and a small table is one partition."""
    return rows.repartition(tasks or max(1, min(3 * rows.sparkSession.sparkContext.defaultParallelism, n // LEAST_SERIES), -(-n // MOST_SERIES)))


def series_of(grid: DataFrame) -> DataFrame:
    """One row a series of a daily grid: y, its last day, and the number of its first day. Write it before it is used more than once."""
    return _numbered(as_arrays(grid))


def series_of_days(daily: DataFrame) -> DataFrame:
    """series_of() the grid of known days, without the grid."""
    return _numbered(filled_arrays(daily))


def _numbered(arrays: DataFrame) -> DataFrame:
    return arrays.withColumn("first_day", F.datediff("last", F.lit("1970-01-01").cast("date")) - F.size("y") + 1)


def model_backtest(series: DataFrame, p: Params = Params(), tasks: int | None = None, models: tuple[str, ...] = MODELS) -> DataFrame:
    """Mean errors of the models over the folds of each series; nulls and 0 folds where it is too short."""
    names, h = F.array(*map(F.lit, models)), p.fold_days
    rows = _dealt(series.select(*SERIES, "y", "first_day"), series.count(), tasks).withColumn("splits", fold_splits(p))
    tests = F.transform("splits", lambda s: F.slice("y", s + 1, h))
    # in a select of its own: beside the explode a whole series would be copied for every fit
    fitted = rows.select(*SERIES, tests.alias("tests"), fits(F.col("y"), F.col("first_day"), F.col("splits"), names, h).alias("fits"))
    each = fitted.select(*SERIES, "tests", F.explode("fits").alias("fit"))
    per = each.select(*SERIES, "fit.model", F.get("tests", F.col("fit.at")).alias("test"), "fit.p50", "fit.q90")
    tested = fold_errors(per, h).groupBy(*SERIES, "model").agg(*[F.avg(c).alias(c) for c in ERRORS], F.count(F.lit(1)).alias("folds"))
    every = series.select(*SERIES, F.explode(names).alias("model"))
    return every.join(tested, [*SERIES, "model"], "left").select(*SERIES, "model", *ERRORS, F.coalesce("folds", F.lit(0)).cast("int").alias("folds"))


def model_selection(backtest: DataFrame, series: DataFrame) -> DataFrame:
    """The model of the lowest score of each series with its errors; of equals the first of MODELS."""
    score = selection_score(F.col("wape"), F.col("pinball_p90"), F.col("calibration_p90"))
    place = F.array_position(F.array(*map(F.lit, MODELS)), F.col("model"))
    best = backtest.groupBy(*SERIES).agg(F.min(F.struct(score.alias("selection_score"), place.alias("place"), F.col("model").alias("selected_model"), *ERRORS)).alias("b"))
    return best.join(series.select(*SERIES, F.size("y").alias("series_days")), list(SERIES)).select(*SERIES, "b.selected_model", "b.selection_score", *[f"b.{e}" for e in ERRORS], "series_days")


def forecast_daily(series: DataFrame, selection: DataFrame, p: Params = Params(), tasks: int | None = None) -> DataFrame:
    """max(horizons) days of each series by its selected model."""
    days = max(p.horizons)
    rows = series.join(selection.select(*SERIES, F.col("selected_model").alias("model")), list(SERIES))
    fit = fit_of(F.col("y"), F.col("first_day"), F.col("model"), days)
    fitted = _dealt(rows, series.count(), tasks).select(*SERIES, "last", "model", fit.alias("fit")).select(*SERIES, "last", "model", "fit.q90", "fit.q95", "fit.p50")
    # in a select of its own: beside an explode the bands would be computed for every day
    told = fitted.select(*SERIES, "last", "model", "q90", "q95", F.posexplode("p50").alias("at", "p50"))
    ahead = F.col("at") + 1
    return told.select(*SERIES, F.expr("date_add(last, at + 1)").alias("date"), ahead.alias("horizon_day"), "model", "p50", clip(F.col("p50") + F.col("q90")).alias("p90"), clip(F.col("p50") + F.col("q95")).alias("p95"))
