"""Column functions shared by the operators. NULL stands for missing; NaN never leaves a source."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_if_nan(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def clip(x: Column, low: float = 0.0, high: float = 100.0) -> Column:
    """x within [low, high]; missing stays missing, which greatest and least alone would lose."""
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def env_group(value: Column) -> Column:
    return F.when(F.lower(F.trim(F.coalesce(value, F.lit("")))) == "prod", "prod").otherwise("non-prod")


def clean_list(text: Column) -> Column:
    """Trimmed, non-blank parts of a comma-separated list."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def int_list(text: Column) -> Column:
    return F.transform(clean_list(text), lambda x: x.cast("int"))


def tag_value(tags: Column, key: str) -> Column:
    """First non-blank trimmed value of a tag, else ''."""
    own = F.filter(F.transform(F.filter(tags, lambda t: t["tag"] == key), lambda t: F.trim(F.coalesce(t["value"], F.lit("")))), lambda v: v != "")
    return F.coalesce(F.get(own, F.lit(0)), F.lit(""))


def preferred_value(tags: Column, key: str, preferred: tuple[str, ...]) -> Column:
    """Among the values of a tag, the one earliest in `preferred`, else the first, else ''."""
    own = F.transform(F.filter(tags, lambda t: t["tag"] == key), lambda t: F.coalesce(t["value"], F.lit("")))
    listed = F.filter(F.array(*map(F.lit, preferred)), lambda p: F.array_contains(own, p)) if preferred else F.array().cast("array<string>")
    return F.coalesce(F.get(listed, F.lit(0)), F.get(own, F.lit(0)), F.lit(""))


def unquote(x: Column) -> Column:
    """Without blanks around, then without double, then without single quotes around."""
    return F.btrim(F.btrim(F.trim(x), F.lit('"')), F.lit("'"))


def slug(x: Column) -> Column:
    """A file-name part; different values may give the same part."""
    named = F.when(F.coalesce(x, F.lit("")) == "", F.lit("_empty_as")).otherwise(x)
    out = F.btrim(F.regexp_replace(named, "[^A-Za-z0-9._-]+", "_"), F.lit("._"))
    return F.when(out == "", "host").otherwise(out)


def iso_utc(seconds: Column) -> Column:
    """ISO text of epoch seconds in UTC; 0 and missing: missing."""
    return F.when(F.coalesce(seconds, F.lit(0)) != 0, F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))


def percent_text(x: Column) -> Column:
    return F.when(x.isNotNull(), F.concat(F.format_string("%.1f", x), F.lit("%"))).otherwise("n/a")


def days_text(x: Column) -> Column:
    return F.coalesce(F.concat(x.cast("int").cast("string"), F.lit(" d")), F.lit("n/a"))


# --- forecasting errors and confidence


def pinball(y: Column, f: Column, q: float) -> Column:
    """Mean pinball loss, an aggregate."""
    d = y - f
    return F.avg(F.when(d >= 0, q * d).otherwise((q - 1) * d))


def wape(y: Column, f: Column) -> Column:
    """Sum of errors over the sum of |y|; the mean error where that sum is nearly zero."""
    total = F.sum(F.abs(y))
    return F.when(total <= 1e-9, F.avg(F.abs(y - f))).otherwise(F.sum(F.abs(y - f)) / total)


def selection_score(wape_: Column, pinball_: Column, calibration: Column) -> Column:
    return F.coalesce(wape_, F.lit(10.0)) + F.coalesce(pinball_, F.lit(10.0)) + F.coalesce(F.abs(calibration - 0.90), F.lit(1.0))


def confidence_index(wape_: Column, pinball_: Column, calibration: Column) -> Column:
    """0 to 100 from backtest errors; a missing error counts one half."""
    a = F.coalesce(1 - clip(wape_, 0.0, 1.5) / 1.5, F.lit(0.5))
    b = F.coalesce(1 - clip(pinball_, 0.0, 20.0) / 20.0, F.lit(0.5))
    c = F.when(calibration.isNull(), 0.5).otherwise(1 - F.least(F.abs(calibration - 0.90), F.lit(0.5)) / 0.5)
    return 100.0 * (0.45 * a + 0.25 * b + 0.30 * c)


# --- the normal distribution

# W. J. Cody's rational approximations of erf and erfc (1969), lowest power last.
ERF = ((1.85777706184603153e-1, 3.16112374387056560e0, 1.13864154151050156e2, 3.77485237685302021e2, 3.20937758913846947e3), (1.0, 2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3, 2.84423683343917062e3))
ERFC = (
    (2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594e0, 6.61191906371416295e1, 2.98635138197400131e2, 8.81952221241769090e2, 1.71204761263407058e3, 2.05107837782607147e3, 1.23033935479799725e3),
    (1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2, 1.62138957456669019e3, 3.29079923573345963e3, 4.36261909014324716e3, 3.43936767414372164e3, 1.23033935480374942e3),
)
ERFC_FAR = ((1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1, 1.60837851487422766e-2, 6.58749161529837803e-4), (1.0, 2.56852019228982242e0, 1.87295284992346047e0, 5.27905102951428412e-1, 6.05183413124413191e-2, 2.33520497626869185e-3))
NEAR, FAR = 0.46875, 4.0
INVERSE_ROOT_PI = 5.6418958354775628695e-1


def _ratio(x: Column, of: tuple[tuple[float, ...], tuple[float, ...]]) -> Column:
    """A ratio of two polynomials by nested multiplication."""
    out = []
    for powers in of:
        y = F.lit(powers[0])
        for p in powers[1:]:
            y = y * x + p
        out.append(y)
    return out[0] / out[1]


def erfc(x: Column) -> Column:
    """1 - erf(x) to about 15 places, in columns."""
    y = F.abs(x)
    square = y * y
    tail = F.when(y <= FAR, _ratio(y, ERFC)).otherwise((INVERSE_ROOT_PI - _ratio(1 / square, ERFC_FAR) / square) / y) * F.exp(-square)
    return F.when(y <= NEAR, 1 - x * _ratio(square, ERF)).when(x < 0, 2 - tail).otherwise(tail)


def normal_tail(z: Column) -> Column:
    """Probability that a standard normal value reaches z."""
    return 0.5 * erfc(z / 2**0.5)


# --- labels

LABELS = {
    "metric": {"cpu": "CPU", "ram": "RAM", "disk": "Disk"},
    "status": {"critical": "critical", "watch": "under watch", "stable": "stable", "overprovisioned": "spare resources"},
    "cluster": {"cold": "cold (low load)", "warm": "warm (working range)", "hot": "hot (raised risk)"},
    "basis": {"p50": "by p50", "hot_p90_p95": "by p90/p95 as hot"},
    "model": {"seasonal_naive": "seasonal_naive", "robust_trend": "robust_trend", "gbdt_lag": "gbdt_lag"},
}


def label(kind: str, x: Column) -> Column:
    """Label of a value; unknown values are their own label."""
    pairs = [F.lit(v) for kv in LABELS[kind].items() for v in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), x), x, F.lit(""))


def confidence_level(x: Column) -> Column:
    return F.when(x >= 75, "high").when(x < 50, "low").otherwise("medium")


def bucket_90(days: Column) -> Column:
    """Which section of a report a series belongs to."""
    return F.when(days <= 30, "critical_now").when(days <= 90, "critical_soon").when(days <= 180, "risk_6m").when(days <= 365, "risk_12m").otherwise("stable")


def status_is_disabled(x: Column) -> Column:
    low = F.lower(F.trim(x))
    return F.coalesce(low.rlike("disabled|not monitored|unmonitored") | low.isin("0", "false", "no"), F.lit(False))
