import random
import zlib

import numpy as np

from headroom.llm import purity as P


def data(spark, n=900):
    rnd = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        good = i % 6 > 0
        word = (lambda: "".join(rnd.choices("aeiounrst", k=rnd.randrange(2, 9)))) if good else (lambda: "".join(rnd.choices("AEIOUNRST", k=rnd.randrange(2, 9))) + "!!")
        rows.append((i, ". ".join(" ".join(word() for _ in range(9)) for _ in range(rnd.randrange(3, 20))), 0.5))
        if rnd.random() < 0.5:
            labels.append((i, int(good)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = data(spark)
    rows += [(None, None, 0.1), (None, "", 0.1), (3, rows[3][1], 0.1)]
    labels += [(None, 1), (5, None), (10**6, 1), (labels[0][0], labels[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    out = P.classified(df, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    assert all(r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 == 0) for r in out)
    held = [r for r in out if r.held_out and r.doc_id is not None]
    assert sum(r.predicted == int(r.doc_id % 6 > 0) for r in held) > 0.97 * len(held)


def test_held_out_labels_change_nothing(spark):
    rows, labels = data(spark, 200)
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    flipped = [(d, 1 - q if zlib.crc32(str(d).encode()) % 5 == 0 else q) for d, q in labels]
    a, b = (sorted(map(tuple, P.classified(df, spark.createDataFrame(x, "doc_id long, quality int")).collect())) for x in (labels, flipped))
    assert a == b


def test_without_labels_and_rows(spark):
    rows, _ = data(spark, 20)
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = P.classified(spark.createDataFrame(rows, "doc_id long, text string, score double"), none).collect()
    assert {r.score for r in out} == {0.5}
    assert P.classified(spark.createDataFrame([], "doc_id long, text string"), none).count() == 0


def test_prior_from_positives_and_unlabelled_alone(spark):
    """Without any label of a bad document the prior is found, and so are the bad documents."""
    rows, labels = data(spark, 1500)
    good = [(d, q) for d, q in labels if q == 1]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    told = P.trusted(P.featured(df.select("doc_id", "text")), spark.createDataFrame(good, "doc_id long, quality int"))
    prior = P.fit(told)[-1]
    assert abs(prior - 5 / 6) < 0.06
    out = P.classified(df, spark.createDataFrame(good, "doc_id long, quality int")).collect()
    assert sum(r.predicted == int(r.doc_id % 6 > 0) for r in out) > 0.97 * len(out)


def test_risk_sums_match_brute_force(spark):
    rows, labels = data(spark, 60)
    rows.append((999, "long text " * 30_000, 0.1))
    told = P.trusted(P.featured(spark.createDataFrame(rows, "doc_id long, text string, score double").select("doc_id", "text")), spark.createDataFrame(labels, "doc_id long, quality int"))
    rnd = np.random.default_rng(1)
    d = len(P.FEATURES)
    mean, scale, w = rnd.normal(size=d), rnd.uniform(1, 2, d), rnd.normal(size=d + 1) / 5
    got = P._sums(told, mean, scale, w)
    x, own = [], []
    for r in told.collect():
        x.append([*((r[c] - m) / s for c, m, s in zip(P.FEATURES, mean, scale)), 1.0])
        own.append(r.label == 1)
    x, own = np.array(x), np.array(own)
    for k, part in (("P", x[own]), ("U", x)):
        f = part @ w
        p = 1 / (1 + np.exp(-f))
        assert got[f"{k}n"] == len(part) and np.isclose(got[f"{k}+"], np.log1p(np.exp(-f)).mean()) and np.isclose(got[f"{k}-"], np.log1p(np.exp(f)).mean())
        assert np.allclose(got[f"{k}x"], part.mean(0)) and np.allclose(got[f"{k}s"], (p[:, None] * part).mean(0)) and np.allclose(got[f"{k}h"], sum(q * (1 - q) * np.outer(v, v) for q, v in zip(p, part)) / len(part))
