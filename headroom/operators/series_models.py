"""The models of a daily series with numpy: the seasonal-naive one, the reweighted line, boosted stumps on lag features.

Stumps are fitted for many series at once: a batch is one array whose rows end on the same column, so that a
step of a fit, or a day ahead, is one operation for all of them. A fit gives the values ahead and the 0.9 and
0.95 quantiles of the absolute residuals.
"""

from __future__ import annotations

import numpy as np

LAGS = (1, 2, 3, 7, 14, 21, 28)
WINDOWS = (3, 7, 14)
#: Passes of the reweighted line.
PASSES = 8
STUMPS, RATE, LEVELS, LEAF = 80, 0.08, 15, 8
FIRST = max(*LAGS, *WINDOWS)
#: A series needs so many days for boosted stumps: 45 complete feature rows.
LEAST_DAYS = 45 + FIRST
COLUMNS = len(LAGS) + 2 * len(WINDOWS) + 2
#: Fits made together: what their candidate splits share, some 200 kB a fit, is held at once.
BATCH = 128

Fit = tuple[np.ndarray, float, float]


def quantile(ordered: np.ndarray, q: float) -> float:
    """Linearly interpolated quantile of a sorted array; 0 of an empty one."""
    if not len(ordered):
        return 0.0
    at = (len(ordered) - 1) * q
    low = int(at)
    return float(ordered[low] + (ordered[min(low + 1, len(ordered) - 1)] - ordered[low]) * (at - low))


def banded(p50: np.ndarray, residual: np.ndarray) -> Fit:
    ordered = np.sort(residual)
    return p50, quantile(ordered, 0.9), quantile(ordered, 0.95)


def seasonal_naive(y: np.ndarray, horizon: int) -> Fit:
    """The last week again, or the last value of a series shorter than that."""
    if len(y) < 7:
        return banded(np.full(horizon, y[-1]), np.abs(y - y[-1]))
    return banded(np.resize(y[-7:], horizon), np.abs(y[7:] - y[:-7]))


def robust_trend(y: np.ndarray, start: int, horizon: int) -> Fit:
    """The reweighted line plus the median residual of each weekday. start: day number of the first value.

    A pass minimises sum(q * (y - c - m * i)**2) and sets q = 1 / max(1, |r| / (1.5 * median |r|))**2.
    """
    n = len(y)
    i, q = np.arange(n, dtype=float), np.ones(n)
    for _ in range(PASSES):
        qi = q * i
        s0, s1, s2, t0, t1 = q.sum(), qi.sum(), qi @ i, q @ y, qi @ y
        det = s0 * s2 - s1 * s1
        m = (s0 * t1 - s1 * t0) / det if det > 0 else 0.0
        c = (t0 - m * s1) / s0
        r = y - (c + m * i)
        size = np.abs(r)
        middle = np.partition(size, ((n - 1) // 2, n // 2))[[(n - 1) // 2, n // 2]]
        q = 1 / np.maximum(1.0, size / (1.5 * (middle[0] + (middle[1] - middle[0]) * 0.5 + 1e-9))) ** 2
    # day 0 was a Thursday; a weekday's residuals are every seventh
    term = np.array([quantile(np.sort(r[(d - start - 3) % 7 :: 7]), 0.5) for d in range(7)])
    ahead = np.arange(n, n + horizon)
    return banded(np.clip(c + m * ahead + term[(start + ahead + 3) % 7], 0, 100), size)


def _angles(day: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sine and cosine of the weekday of day numbers; day 0 was a Thursday."""
    angle = 2 * np.pi * ((day + 3) % 7) / 7
    return np.sin(angle), np.cos(angle)


def features(h: np.ndarray, day: np.ndarray) -> np.ndarray:
    """(series, days from FIRST on, COLUMNS): lags, rolling means and sample deviations before the day, weekday sine and cosine.

    h: series by days, rows of shorter series begin with NaN. day: day numbers of its columns by series.
    """
    shifted = [h[:, FIRST - k : h.shape[1] - k] for k in range(FIRST, 0, -1)]
    cols = [shifted[-k] for k in LAGS], *zip(*(_moments(shifted[-w:], w - 1) for w in WINDOWS)), _angles(day[:, FIRST:])
    return np.stack([c for group in cols for c in group], axis=2)


def _sum(parts: list[np.ndarray]) -> np.ndarray:
    """Sum of arrays, value by value, in the order of numpy's sum of a row of so many values."""
    if len(parts) < 8:
        return sum(parts[1:], parts[0])
    p = parts[:8]
    return sum(parts[8:], ((p[0] + p[1]) + (p[2] + p[3])) + ((p[4] + p[5]) + (p[6] + p[7])))


def _moments(before: list[np.ndarray], divisor: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of the days before, the oldest first; to the last bit the same for a fit and for a day ahead, as cuts are values."""
    mean = _sum(before) / len(before)
    return mean, np.sqrt(_sum([(b - mean) ** 2 for b in before]) / divisor)


def candidate_cuts(x: np.ndarray) -> np.ndarray:
    """(COLUMNS, LEVELS), ascending: interpolated quantiles of each feature. x: features by days."""
    ordered = np.sort(x, axis=1)
    place = (x.shape[1] - 1) * np.linspace(0.05, 0.95, LEVELS)
    low = np.floor(place).astype(int)
    a, b, t = ordered[:, low], ordered[:, low + 1], place - low
    return np.where(t < 0.5, a + (b - a) * t, b - (b - a) * (1 - t))


def shared_days(codes: np.ndarray) -> np.ndarray:
    """(candidates, candidates): days left of both, from the codes of each feature by day."""
    bins = LEVELS + 1
    spread = codes + bins * bins * np.arange(COLUMNS)[:, None]
    out = np.empty((COLUMNS, LEVELS, COLUMNS, LEVELS), np.float32)
    for j in range(COLUMNS):  # with itself and the features after it
        pairs = np.bincount((spread[j:] + (bins * codes[j] - bins * bins * j)).ravel(), minlength=(COLUMNS - j) * bins * bins)
        both = pairs.reshape(-1, bins, bins).cumsum(axis=1).cumsum(axis=2)[:, :LEVELS, :LEVELS]
        out[j, :, j:] = both.transpose(1, 0, 2)
        out[j:, :, j] = both.transpose(0, 2, 1)
    return out.reshape(COLUMNS * LEVELS, COLUMNS * LEVELS)


class Stumps:
    """Gradient boosting of depth-one trees under squared loss, all candidate splits of a round and all series at once.

    A day's code of a feature is how many cuts lie below it, so it is left of those from its code on: sums and
    counts left of all candidates are running sums over the codes. The sums of the residuals are kept up to
    date: a round takes from each what it shares with the chosen split, and how many days two candidates
    share is counted once.
    """

    def __init__(self, x, y: list[np.ndarray]):
        """x: features (days, COLUMNS) of each series; its last len(y) days are those of y."""
        n, rows, columns = len(y), np.array([len(v) for v in y]), np.arange(COLUMNS)[:, None]
        own = [np.ascontiguousarray(x[i][len(x[i]) - rows[i] :].T) for i in range(n)]
        cuts = np.stack([candidate_cuts(v) for v in own])
        self.codes = [np.stack([c.searchsorted(v) for c, v in zip(cuts[i], own[i])]) for i in range(n)]
        self.base = np.array([v.mean() for v in y])
        r = [v - b for v, b in zip(y, self.base)]
        per_code = lambda i, weights: np.bincount((self.codes[i] + columns * (LEVELS + 1)).ravel(), weights, COLUMNS * (LEVELS + 1)).reshape(COLUMNS, LEVELS + 1)
        left = lambda i, weights=None: per_code(i, weights).cumsum(axis=1)[:, :LEVELS].ravel()
        size = np.stack([left(i) for i in range(n)]).astype(float)
        low = np.stack([left(i, np.broadcast_to(r[i], own[i].shape).ravel()) for i in range(n)])
        shared = np.stack([shared_days(codes) for codes in self.codes])
        total = np.array([v.sum() for v in r])
        right = rows[:, None] - size
        again = np.zeros(cuts.shape, bool)  # a cut that equals the one before
        again[:, :, 1:] = cuts[:, :, 1:] == cuts[:, :, :-1]
        able = (size >= LEAF) & (right >= LEAF) & ~again.reshape(n, -1)
        any_able, each = able.any(axis=1), np.arange(n)
        some_left, some_right = np.maximum(size, 1), np.maximum(right, 1)
        chosen, below, above = [], [], []
        for _ in range(STUMPS):
            gain = np.where(able, low**2 / some_left + (total[:, None] - low) ** 2 / some_right, -np.inf)
            k = gain.argmax(axis=1)  # the first of equals
            a = np.where(any_able, low[each, k] / some_left[each, k], 0.0)
            b = np.where(any_able, (total - low[each, k]) / some_right[each, k], 0.0)
            both = shared[each, k]
            low -= RATE * (a[:, None] * both + b[:, None] * (size - both))
            total -= RATE * (a * size[each, k] + b * right[each, k])
            chosen.append(k)
            below.append(RATE * a)
            above.append(RATE * b)
        self.chosen, self.below, self.above = (np.stack(v, axis=1) for v in (chosen, below, above))
        self.column = self.chosen // LEVELS
        self.cut = np.take_along_axis(cuts.reshape(n, -1), self.chosen, axis=1)

    def fitted(self, i: int) -> np.ndarray:
        """What the model says of the days it was fitted on."""
        step = np.zeros((COLUMNS, LEVELS + 1))
        np.add.at(step, (self.column[i], 0), self.below[i])
        np.add.at(step, (self.column[i], self.chosen[i] % LEVELS + 1), self.above[i] - self.below[i])
        told = np.take_along_axis(step.cumsum(axis=1), self.codes[i], axis=1)
        return np.clip(self.base[i] + told.sum(axis=0), 0, 100)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """One row of features a series."""
        side = np.where(np.take_along_axis(x, self.column, axis=1) <= self.cut, self.below, self.above)
        return np.clip(self.base + side.sum(axis=1), 0, 100)


def gbdt_lag(series: list[np.ndarray], starts: list[int], horizon: int, splits: list[list[int]] | None = None) -> list[Fit]:
    """Boosted stumps on lag features, carried on day by day: of each series, or of its first `split` values for each of its
    splits, one series after the other. Each has at least LEAST_DAYS values; starts: day numbers of the first."""
    splits = splits or [[len(y)] for y in series]
    asked = [(i, split) for i, own in enumerate(splits) for split in own]
    series = [y[: max(own)] for y, own in zip(series, splits)]
    lengths = np.array([len(y) for y in series])
    h = np.full((len(series), int(lengths.max())), np.nan)
    for row, y in zip(h, series):
        row[len(row) - len(y) :] = y
    day = (np.array(starts) - (h.shape[1] - lengths))[:, None] + np.arange(h.shape[1])
    # a fit's features are those of its series up to its split
    x = features(h, day)
    model = Stumps([x[i, : x.shape[1] - (lengths[i] - split)] for i, split in asked], [series[i][FIRST:split] for i, split in asked])
    told = np.empty((len(asked), FIRST + horizon))
    for row, (i, split) in zip(told, asked):
        row[:FIRST] = series[i][split - FIRST : split]
    sine, cosine = _angles(np.array([starts[i] + split - FIRST for i, split in asked])[:, None] + np.arange(told.shape[1]))
    for t in range(FIRST, told.shape[1]):
        # at forecast time the deviation is that of the population
        means, deviations = zip(*(_moments([told[:, t - k] for k in range(w, 0, -1)], w) for w in WINDOWS))
        told[:, t] = model.predict(np.stack([*(told[:, t - k] for k in LAGS), *means, *deviations, sine[:, t], cosine[:, t]], axis=1))
    return [banded(told[k, FIRST:], np.abs(series[i][FIRST:split] - model.fitted(k))) for k, (i, split) in enumerate(asked)]


def fit_all(series: list[np.ndarray], starts: list[int], horizon: int, splits: list[list[int]] | None = None) -> list[list[Fit]] | list[Fit]:
    """gbdt_lag in batches of series of about the same length: one fit each, or with splits the list of their fits."""
    own = splits or [[len(y)] for y in series]
    out: list[list[Fit]] = [[] for _ in series]
    order = sorted((i for i in range(len(series)) if own[i]), key=lambda i: len(series[i]))
    size = max(1, BATCH // max([1, *map(len, own)]))
    for k in range(0, len(order), size):
        batch = order[k : k + size]
        fits = iter(gbdt_lag([series[i] for i in batch], [starts[i] for i in batch], horizon, [own[i] for i in batch]))
        for i in batch:
            out[i] = [next(fits) for _ in own[i]]
    return out if splits else [f[0] for f in out]
