import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from headroom.llm import lm


def fold(d):
    return zlib.crc32(str(d if d is not None else "").encode()) % 10


def tokens_of(t):
    return [*(t or "").encode().lower().split(), None]


def em(events):
    """Weights by class from (class, ml / low, held-out count)."""
    m = {b: 0.5 for b, _, _ in events}
    for _ in range(30):
        share = {b: 0.0 for b in m}
        for b, r, n in events:
            share[b] += n * m[b] * r / (m[b] * r + 1 - m[b])
        m = {b: share[b] / sum(n for c, _, n in events if c == b) for b in m}
    return {b: min(max(x, 1e-4), 1 - 1e-4) for b, x in m.items()}


def rounded(ratio):
    return 10 ** (math.floor(math.log10(ratio) * 100 + 0.5) / 100) if ratio else 0.0


def brute(rows, hot):
    """All result columns by dictionaries over every token."""
    counts, pairs = [Counter(), Counter()], [Counter(), Counter()]
    for d, t in rows:
        if f := fold(d):
            counts[f == 1].update(tokens_of(t))
    both = counts[0] + counts[1]
    n, v, kept_n = sum(both.values()), len(both), sum(counts[0].values())
    known = set(sorted((w for w in both if w is not None), key=lambda w: (-both[w], w))[:hot])
    chain = lambda t: list(zip(["<start>", *(w if w in known else "<rare>" for w in tokens_of(t)[:-1])], tokens_of(t)))
    for d, t in rows:
        if f := fold(d):
            pairs[f == 1].update(chain(t))
    contexts = [Counter(), Counter()]
    for k in (0, 1):
        for (c, _), x in pairs[k].items():
            contexts[k][c] += x
    weight = em([(0, rounded(counts[0][w] / kept_n * (v + 1)), x) for w, x in counts[1].items()])[0]
    low = lambda w, c, total: weight * c[w] / total + (1 - weight) / (v + 1)
    bucket = lambda x: int(math.log2(x))
    lam = em([(bucket(contexts[0][c]), rounded(pairs[0][c, w] / contexts[0][c] / low(w, counts[0], kept_n)), x) for (c, w), x in pairs[1].items() if contexts[0][c]])
    all_pairs, all_contexts = pairs[0] + pairs[1], contexts[0] + contexts[1]

    def p(c, w):
        total = all_contexts[c]
        own = lam.get(bucket(total), 0.5) if total else 0.0
        return own * all_pairs[c, w] / max(total, 1) + (1 - own) * low(w, both, n)

    return [
        (d, fold(d) == 0, len(tokens_of(t)), sum(both[w] > 0 for w in tokens_of(t)), n, round(sum(math.log10((both[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens_of(t)), 5), round(sum(math.log10(p(c, w)) for c, w in chain(t)), 5))
        for d, t in rows
    ]


def texts(k, seed):
    """Texts of a small chain, so that a word tells something of the next."""
    rnd = random.Random(seed)
    words = ["".join(rnd.choices(["the", "on", "er", "An", "is", "é"], k=rnd.randrange(1, 6))) for _ in range(150)]
    after = {w: rnd.choices(words, k=4) for w in words}
    out = []
    for i in range(k):
        w, text = rnd.choice(words), []
        for _ in range(rnd.randrange(60)):
            text.append(w if rnd.random() > 0.03 else f"odd{rnd.randrange(10**6)}")
            w = rnd.choice(after[w])
        out.append((i, " ".join(text)))
    return out


@pytest.mark.parametrize("hot, bucket", [(40, 300), (10**5, 10**6)])
def test_counts_weights_and_scores_match_brute_force(spark, hot, bucket):
    rows = texts(300, 3) + [(None, None), (5, "THE the"), (5, "THE the"), (1000, " "), (1001, "x" * 3000), (1002, "again and " * 20_000)]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, word int")
    out = lm.scored(df, hot, bucket).collect()
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5)) for r in out]
    for a, b in zip(sorted(got, key=str), sorted(brute(rows, hot), key=str)):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=2e-5) and a[6] == pytest.approx(b[6], abs=1e-3)


def test_places_of_one_pair_are_spread_over_buckets(spark, monkeypatch):
    """Half of the corpus is one pair: results stay exact, and no bucket holds much more than it is meant to."""
    monkeypatch.setattr(lm, "RUN", 50)
    monkeypatch.setattr(lm, "FLUSH", 9000)
    rows = texts(250, 5) + [(2000 + i, "a " * 90 + "the a") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    counted = lm.counted
    monkeypatch.setattr(lm, "counted", lambda *a: seen.append(counted(*a)) or seen[-1])
    out = lm.scored(df, 30, 500).collect()
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5)) for r in out]
    for a, b in zip(sorted(got, key=str), sorted(brute(rows, 30), key=str)):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=2e-5) and a[6] == pytest.approx(b[6], abs=1e-3)
    blocks = seen[0].filter("words is not null").select("spread", "spread_pairs").collect()
    places = [int(lm._unpack(bytes(r.spread), "u4").sum()) for r in blocks]
    pair = max((p for r in blocks for p in r.spread_pairs), key=lambda p: sum(p in r.spread_pairs for r in blocks))
    assert sum(pair in r.spread_pairs for r in blocks) > 15
    assert sum(places) > 20_000 and max(places) < 4 * 500


def test_ways_are_bounded_by_the_less_frequent_of_a_pair():
    layout = lm.Layout(np.array([10, 950, 420, 30, 1]), 500, 100)
    of = lambda w, c: int(lm.ways(layout.splits, layout.shares, np.array([w], np.uint64), np.array([c], np.uint64))[0])
    assert [of(1, 1), of(1, 2), of(2, 1), of(1, 3), of(3, 1), of(1, 5), of(lm.RARE | 7, 1)] == [10, 5, 5, 1, 1, 5, 1]


def test_model_beats_base_and_word_order_counts(spark):
    rows = texts(400, 7)
    rnd = random.Random(1)
    held = [(d, t) for d, t in rows if fold(d) == 0 and len(t.split()) > 10]
    ids = [i for i in range(10**6, 10**6 + 2000) if fold(i) == 0]
    mixed = [(i, " ".join(rnd.sample(t.split(), len(t.split())))) for i, (_, t) in zip(ids, held)]
    out = {r.doc_id: r for r in lm.scored(spark.createDataFrame(rows + mixed, "doc_id long, text string")).collect()}
    assert sum(out[d].score for d, _ in held) > sum(out[d].base_score for d, _ in held)
    assert sum(out[i].score < out[d].score for (i, _), (d, _) in zip(mixed, held)) > 0.9 * len(held)
    assert all(math.isclose(out[i].base_score, out[d].base_score, rel_tol=1e-9) for (i, _), (d, _) in zip(mixed, held))


def test_arrays_survive_packing():
    a = np.array([0, 5, 5, 2**63 + 7, 3], np.uint64)
    assert (lm._unpack(lm._pack(a), "u8") == a).all() and len(lm._unpack(lm._pack(a[:0]), "u8")) == 0
    layout = lm.Layout(np.array([10, 950, 40, 30, 1]), 500, 100)
    assert layout.splits[1] == 10 and layout.first.max() + 10 <= layout.hot and layout.rare == 6


def test_no_training_rows(spark):
    held = [d for d in range(60) if fold(d) == 0]
    out = lm.scored(spark.createDataFrame([(held[0], "a b")], "doc_id long, text string")).collect()
    assert out[0].train_tokens == 0 and out[0].n_known == 0 and out[0].n_tokens == 3 and np.isfinite(out[0].score)
    assert lm.scored(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_words_that_are_not_hot_are_contexts_of_their_own(spark):
    """Scores of a few hot words and many buckets are those of all words as contexts; pairs of rare words have counts, too."""
    rows = texts(300, 3) + [(2000 + i, f"rare{i % 9} seldom{i % 9} the") for i in range(90)] + [(None, None), (1001, "x" * 3000), (1002, "again and " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(brute(rows, 10**6), key=str)
    for hot, bucket in ((0, 300), (40, 300), (10**5, 10**6)):
        out = lm.scored(df, hot, bucket, every_context=True).collect()
        got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5)) for r in out]
        for a, b in zip(sorted(got, key=str), want):
            assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=2e-5) and a[6] == pytest.approx(b[6], abs=1e-3)


def test_the_query_has_every_context(spark, tmp_path, monkeypatch):
    rows = texts(200, 3)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(lm.scored, "__defaults__", (20, 300, *lm.scored.__defaults__[2:]))
    got = {r.doc_id: r.score for r in lm.op6_lm_scoring(spark, str(tmp_path)).collect()}
    assert all(got[d] == pytest.approx(score, abs=1e-3) for d, *_, score in brute(rows, 10**6))
