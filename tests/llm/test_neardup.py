import random

import numpy as np

from headroom.llm import neardup as N

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for b in "\t\n\x0b\x0c\r":
        low = low.replace(b, " ")
    words = [w for w in low.split(" ") if w]
    return frozenset(" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_groups(texts, similarity=0.8):
    """A number for each text, the same for those that are linked."""
    sets = [shingles_of(t) for t in texts]
    group = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= similarity * (len(sets[i]) + len(sets[j]) - both) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return group


def left(spark, rows):
    df = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], SCHEMA)
    return sorted((r.doc_id for r in N.stage(spark, df, "").collect()), key=str)


def want(rows):
    first = {}
    for g, (d, _) in zip(brute_groups([t for _, t in rows]), rows):
        first[g] = min(first.get(g, (True, 0)), (d is None, d or 0))
    return sorted((d if not none else None for none, d in first.values()), key=str)


def edited(rnd, words, share):
    return [rnd.choice(["new", "other", "again"]) if rnd.random() < share else w for w in words]


def test_stage_matches_brute_force(spark):
    rnd = random.Random(12)
    words = [f"w{i}" for i in range(5000)]
    rows = []
    for i in range(40):
        base = rnd.choices(words, k=rnd.randrange(150, 400))
        rows.append((i, " ".join(base)))
        # from near copies to texts that merely share passages
        rows += [(1000 + 10 * i + k, " ".join(edited(rnd, base, share))) for k, share in enumerate((0.005, 0.015, 0.05, 0.2))]
    rows += [(2000, rows[0][1].upper() + "\n"), (2001, " ".join([rows[0][1]] * 300)), (2002, None), (2003, ""), (2004, "one two"), (2005, "One  two"), (None, "one two three"), (None, rows[5][1])]
    assert left(spark, rows) == want(rows)


def test_chain_of_copies_is_one_group(spark, monkeypatch):
    """Each is like the one before, the ends are not alike: rounds go on until every pair of a bucket is settled."""
    monkeypatch.setattr(N, "CENTRES", (1, 2))
    rnd = random.Random(3)
    words = rnd.choices([f"w{i}" for i in range(5000)], k=200)
    rows = []
    for i in range(40):
        words = [*words[4:], *rnd.choices(["x", "y", "z"], k=4)]
        rows.append((i, " ".join(words)))
    assert left(spark, rows) == want(rows)


def test_bucket_of_texts_that_only_collide(spark, monkeypatch):
    """All meet in one bucket, whatever their texts: every pair is compared, and nothing links that isn't alike."""
    monkeypatch.setattr(N, "CENTRES", (1, 4))
    monkeypatch.setattr(N, "buckets_of", lambda reps: reps.select(N.F.lit(1).cast("long").alias("bucket"), "id", "n"))
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rnd.choices(words, k=40))) for i in range(30)]
    rows += [(100 + i, rows[i][1] + " end") for i in range(6)]
    assert left(spark, rows) == want(rows)


def test_bands_agree_as_often_as_computed():
    rnd = np.random.default_rng(1)
    found = 0
    for _ in range(300):
        common, a, b = rnd.integers(0, 2**63, 400, np.uint64), rnd.integers(0, 2**63, 50, np.uint64), rnd.integers(0, 2**63, 50, np.uint64)
        x, y = (N.least_hashes(np.unique(np.concatenate([common, own]))).reshape(N.BANDS, N.ROWS) for own in (a, b))
        found += (x == y).all(axis=1).any()
    assert found >= 290


def test_only_texts_of_pairs_are_shuffled(spark, monkeypatch):
    texts = spark.range(5000).select("id", N.F.concat(N.F.lit("text "), "id").alias("text"))
    pairs = spark.createDataFrame([(4000, 7), (4999, 7), (300, 20)], "a long, b long")
    got = {r.id for r in N.texts_of(pairs, texts).collect()}
    assert {4000, 4999, 300, 7, 20} <= got and len(got) < 100
    assert N.texts_of(pairs.limit(0), texts).count() == 0
    seen = []
    of = N.salted_join
    monkeypatch.setattr(N, "salted_join", lambda left, right, *a, **k: seen.append(right) or of(left, right, *a, **k))
    N.verified(pairs, texts, 0.8).collect()
    assert seen[0].count() < 100


def test_nothing_and_alone(spark):
    assert left(spark, []) == [] and left(spark, [(None, None)]) == [None] and left(spark, [(1, "a"), (1, "a"), (2, "b")]) == [1, 2]
