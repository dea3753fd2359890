"""Fits of many series as a column: Spark deals the series out, numpy fits those of an Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import series_models as M

FITS = "array<struct<at int, model string, p50 array<double>, q90 double, q95 double>>"


def _lists(lists: pa.ListArray) -> list[np.ndarray]:
    """The lists of an array, without a copy."""
    values, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _packed(values: list, kind: pa.DataType) -> pa.ListArray:
    """One list for each of these arrays."""
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, values)]), pa.int32()), pa.array(np.concatenate([np.empty(0), *values]), kind))


def fit_series(series: list[np.ndarray], starts: list[int], splits: list, models: list, days: int) -> pa.ListArray:
    """FITS of each series: every model on its first `split` values, for every split. One too short for boosted stumps has the seasonal-naive fit."""
    able = [[int(s) for s in splits[i] if s >= M.LEAST_DAYS] if "gbdt_lag" in models[i] else [] for i in range(len(series))]
    boosted = [dict(zip(own, told)) for own, told in zip(able, M.fit_all(series, starts, days, able))]

    def fit(i: int, split: int, model: str) -> M.Fit:
        if model == "robust_trend":
            return M.robust_trend(series[i][:split], starts[i], days)
        return boosted[i][split] if model == "gbdt_lag" and split in boosted[i] else M.seasonal_naive(series[i][:split], days)

    asked = [(i, at, int(split), model) for i in range(len(series)) for at, split in enumerate(splits[i]) for model in models[i]]
    fits = [fit(i, split, model) for i, _, split, model in asked]
    p50 = _packed([f[0] for f in fits], pa.float64())
    columns = [pa.array([a[1] for a in asked], pa.int32()), pa.array([a[3] for a in asked], pa.string()), p50, pa.array([f[1] for f in fits], pa.float64()), pa.array([f[2] for f in fits], pa.float64())]
    ends = np.cumsum([0, *(len(s) * len(m) for s, m in zip(splits, models))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, ["at", "model", "p50", "q90", "q95"]))


def fits(y: Column, first_day: Column, splits: Column, models: Column, days: int) -> Column:
    """FITS of `days` values ahead: of each model (names) on the first `split` values of y, for each split (at: its place in splits, from 0)."""

    @F.arrow_udf(FITS)
    def of(parts: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for values, firsts, ends, names in parts:
            yield fit_series(_lists(values), firsts.to_pylist(), ends.to_pylist(), names.to_pylist(), days)

    # else a filter on the result, which an explode implies, would be pushed below and fit everything once more
    return of.asNondeterministic()(y, first_day, splits, models)


def fit_of(y: Column, first_day: Column, model: Column, days: int) -> Column:
    """The one fit of a model on all of y."""
    return F.get(fits(y, first_day, F.array(F.size(y)), F.array(model), days), F.lit(0))
