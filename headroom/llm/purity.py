"""Quality classifier by positive-unlabelled learning.

Trusted positives are the training documents labelled good; all documents, labels hidden, are the
unlabelled text. Labels of bad documents are never read. The class prior is estimated from these two
samples: a model that only tells positives from unlabelled text ranks the documents, and the share of
unlabelled text above a score over that of positives above it falls to the prior where no bad ones are
left. A linear model over statistics of the whole text then minimises the non-negative unbiased risk

    prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)]) + ridge

by Newton-like steps: first with the logistic loss, which is convex, and from there with the sigmoid
loss, whose difference between two samples of positives is small where both are sure. Each step is
one pass of Spark over the narrow feature table, in which every task returns sums of fixed size; all
positives and all unlabelled rows take part, at every size.

Defined cases: null and empty texts have zero features and get the score these give; null doc_ids
count as the empty text in the fold and have no label; if labels repeat for a doc_id, it is trusted only
if all are good; equal texts have equal scores; very long texts are read whole; without positive training
labels every score is 0.5; repeated rows are kept, one
result row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, read, remainder, text_crc32

FOLDS = 5
CUTOFF = 0.3
STEPS = 25
RIDGE = 1e-4
#: Bins of the scores that the prior is estimated from, and the share of positives that must lie above a cut.
BINS, LEAST_SHARE = 512, 0.5
FEATURES = ("log_words", "word_length", "capitals", "symbols", "bangs", "digits", "bars", "lines", "stops", "commas", "distinct", "repeated_lines", "beyond_ascii", "short_words", "blank_runs")


def text_features(text: str | None) -> np.ndarray:
    """Statistics of one text; shares and per-word rates, square roots where they are small."""
    b = (text or "").encode()
    words = b.split()
    if not words:
        return np.zeros(len(FEATURES))
    n, h = len(words), np.bincount(np.frombuffer(b, np.uint8), minlength=256)
    lines = [x for x in b.split(b"\n") if x.strip()]
    chars = int(h.sum() - h[9:14].sum() - h[32])
    letters = max(1, int(h[65:91].sum() + h[97:123].sum()))
    rate = lambda k: (min(float(k) / n, 4.0)) ** 0.5
    return np.array(
        [
            np.log1p(n),
            min(chars / n, 30.0),
            h[65:91].sum() / letters,
            rate(h[[35, 42, 36, 37, 38, 60, 62]].sum()),
            rate(h[[33, 63]].sum()),
            rate(h[48:58].sum()),
            rate(h[124]),
            rate(len(lines)),
            rate(h[46]),
            rate(h[44]),
            len(set(words)) / n,
            1 - len(set(lines)) / len(lines),
            h[128:].sum() / max(1, chars),
            sum(map((4).__gt__, map(len, words))) / n,
            rate(max(0, int(h[9:14].sum() + h[32]) - n)),
        ]
    )


def featured(docs: DataFrame) -> DataFrame:
    """doc_id, held_out and one column for each of FEATURES."""

    @F.pandas_udf(", ".join(f"{c} double" for c in FEATURES))
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(np.array([text_features(t) for t in texts]).reshape(-1, len(FEATURES)), columns=list(FEATURES))

    return docs.select("doc_id", (remainder(F.col("doc_id"), FOLDS) == 0).alias("held_out"), of(F.col("text")).alias("x")).select("doc_id", "held_out", "x.*")


def trusted(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """rows with `label`: 1 for the trusted positives, which may be learned from, else null."""
    quality = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("label"))
    return rows.join(quality, "doc_id", "left").withColumn("label", F.when(~F.col("held_out") & (F.col("label") == 1), 1))


def _sums(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray) -> dict[str, np.ndarray]:
    """One pass: for positives (P) and all rows (U) the number, the losses, and the sums of x, s*x and s*(1-s)*x*x'."""
    d = len(w)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 3 + 2 * d + d * d))
        for b in batches:
            x = np.column_stack([(b.column(c).to_numpy() - m) / s for c, m, s in zip(FEATURES, mean, scale)] + [np.ones(b.num_rows)])
            positive = b.column("label").to_numpy(zero_copy_only=False) == 1
            for k, own in enumerate((x[positive], x)):
                f = own @ w
                p = 1 / (1 + np.exp(-np.clip(f, -500, 500)))
                total[k] += np.concatenate([[len(own), np.logaddexp(0, -f).sum(), np.logaddexp(0, f).sum()], own.sum(0), p @ own, ((p * (1 - p))[:, None] * own).T.dot(own).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], ["i", "v"])

    got = rows.select("label", *FEATURES).mapInArrow(part, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros((2, 3 + 2 * d + d * d))
    for r in got:
        flat.ravel()[r["i"]] = r["v"]
    out = {}
    for name, row in zip("PU", flat):
        n = max(row[0], 1.0)
        out |= {f"{name}n": row[0], f"{name}+": row[1] / n, f"{name}-": row[2] / n, f"{name}x": row[3 : 3 + d] / n, f"{name}s": row[3 + d : 3 + 2 * d] / n, f"{name}h": row[3 + 2 * d :].reshape(d, d) / n}
    return out


def minimised(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, w: np.ndarray, loss) -> np.ndarray:
    """Weights from w on by Newton-like steps of a loss, a function of _sums() to (risk, gradient, curvature)."""
    ridge = np.full(len(w), RIDGE)
    ridge[-1] = 0
    step, s = 1.0, _sums(rows, mean, scale, w)
    at, gradient, bend = loss(s)
    for _ in range(STEPS):
        now = at + 0.5 * (ridge * w * w).sum()
        move = np.linalg.solve(bend + np.diag(ridge + 1e-4), gradient + ridge * w)
        while step > 1e-3:
            w2 = w - step * move
            s2 = _sums(rows, mean, scale, w2)
            if loss(s2)[0] + 0.5 * (ridge * w2 * w2).sum() < now:
                break
            step /= 4
        else:
            break
        w = w2
        at, gradient, bend = loss(s2)
        step = min(1.0, 4 * step)
        if now - at - 0.5 * (ridge * w * w).sum() < 1e-6:
            break
    return w


def estimated_prior(rows: DataFrame, mean: np.ndarray, scale: np.ndarray) -> float:
    """Share of good ones among all rows, from the positives and the unlabelled alone.

    Of all cuts of the score, the one whose ratio of shares has the lowest upper bound (two standard errors). Each half
    of the rows is counted under a ranking learned from the other half, so that no row is ranked by what was learned
    from it; the result is the mean of both.
    """
    half = F.pmod(F.floor(text_crc32(F.col("doc_id")) / FOLDS), F.lit(2))
    apart = lambda s: (0.5 * (s["P+"] + s["U-"]), 0.5 * (s["Ps"] - s["Px"] + s["Us"]), 0.5 * (s["Ph"] + s["Uh"]))
    found = []
    for k in (0, 1):
        w = minimised(rows.filter(half == k), mean, scale, np.zeros(len(FEATURES) + 1), apart)
        told = rows.filter(half != k).select(F.floor(score((mean, scale, w, 0.5)) * (BINS - 1e-6)).cast("int").alias("bin"), "label")
        counts = np.zeros((2, BINS))
        for r in told.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.count("label").alias("p")).collect():  # a row for each bin
            counts[:, r["bin"]] = r["n"], r["p"]
        above = np.cumsum(counts[:, ::-1], axis=1)
        size = above[:, -1:].copy()
        if size.all():
            above = (above / size)[:, above[1] >= LEAST_SHARE * size[1]]
            ratio, error = above[0] / above[1], np.sqrt(((1 - above) / (above * size)).sum(axis=0))
            found.append(float(ratio[np.argmin(ratio * (1 + 2 * error))]))
    return float(np.mean(found)) if found else 0.5


def fit(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, float] | None:
    """(mean, scale, weights, prior) from rows with label and features; None without positives."""
    stats = rows.agg(F.count_if(F.col("label") == 1).alias("positives"), *[F.avg(c).alias(f"m_{c}") for c in FEATURES], *[F.stddev_pop(c).alias(f"s_{c}") for c in FEATURES]).first()
    if not stats["positives"]:
        return None
    mean, scale = np.array([stats[f"m_{c}"] for c in FEATURES]), np.array([max(stats[f"s_{c}"], 1e-9) for c in FEATURES])
    prior = min(max(estimated_prior(rows, mean, scale), 0.01), 0.999)

    def convex(s: dict) -> tuple[float, np.ndarray, np.ndarray]:
        """Risk, gradient and curvature under the logistic loss, whose difference of losses is linear in f."""
        negative = s["U-"] - prior * s["P-"]
        if negative > 0:
            return prior * s["P+"] + negative, s["Us"] - prior * s["Px"], s["Uh"]
        return prior * s["P+"], prior * (s["Ps"] - s["Px"]), prior * s["Ph"]

    def bounded(s: dict) -> tuple[float, np.ndarray, np.ndarray]:
        """The same under the sigmoid loss, whose value and noise are bounded for every row."""
        negative = s["Us"][-1] - prior * s["Ps"][-1]
        positive, slope = prior * (1 - s["Ps"][-1]), prior * s["Ph"][:, -1]
        if negative > 0:
            return positive + negative, s["Uh"][:, -1] - 2 * slope, s["Uh"] + prior * s["Ph"]
        return positive, -slope, prior * s["Ph"]

    w = np.zeros(len(FEATURES) + 1)
    for loss in (convex, bounded):
        w = minimised(rows, mean, scale, w, loss)
    return mean, scale, w, prior


def score(model: tuple[np.ndarray, np.ndarray, np.ndarray, float] | None) -> Column:
    """Probability of label 1 as a column over FEATURES."""
    if model is None:
        return F.lit(0.5)
    mean, scale, w, _ = model
    f = F.lit(float(w[-1]))
    for c, m, s, k in zip(FEATURES, mean, scale, w):
        f = f + (F.col(c) - float(m)) * float(k / s)
    return 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), f))))


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of all rows of docs (doc_id, text)."""
    rows = cut(trusted(featured(docs.select("doc_id", "text")), labels.select("doc_id", "quality")), "purity")
    out = rows.withColumn("score", score(fit(rows)))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted"))


def op4_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
