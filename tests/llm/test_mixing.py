import random

from headroom.llm import mixing as M


def brute_targets(sizes, weights=M.WEIGHTS, most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = sum(sizes.values())
    capped, target = set(), {}
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        target = {s: most * sizes[s] for s in capped} | {s: left * w[s] / sum(w[x] for x in free) for s in free}
        above = {s for s in free if target[s] > most * sizes[s]}
        if not above:
            return target
        capped |= above


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, h int, size string")
    out = M.mixed(df).collect()
    sizes = {}
    for _, t, s, *_ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes)
    assert len(out) == len(rows)
    for s in sizes:
        own = [r for r in out if r.source == s]
        assert all(abs(r.target - want[s]) < 1e-6 and r.source_size == sizes[s] for r in own)
        assert abs(sum(r.taken for r in own) - want[s]) <= max(r["size"] for r in own), s
        assert all(0 <= r.taken <= 3 * r["size"] for r in own)
    again = M.mixed(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_mix_meets_targets(spark):
    rnd = random.Random(6)
    names = [None, "", "a", "b", "Z", "é", "src10", "src2", "tiny"]
    rows = [(i, " ".join(["w"] * rnd.randrange(40)), "a" if i % 3 else rnd.choice(names), 1, "x") for i in range(900)]
    rows += [(5000, "one two", "tiny", 1, "x"), (None, None, None, None, None), (None, "", "void", 1, "x")]
    check(spark, rows)


def test_copies_and_ties(spark):
    check(spark, [(None, "same text here", "a", 1, "x")] * 300 + [(i, "b c d", "b", 1, "x") for i in range(50)])
    check(spark, [(1, None, "a", 1, "x"), (2, "", None, 1, "x")])


def test_empty_and_stage(spark):
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    assert M.mixed(spark.createDataFrame([], kinds)).count() == 0
    df = spark.createDataFrame([(i, "w " * (1 + i % 5), None, "ab"[i % 2] if i % 9 else None, 3) for i in range(200)], kinds)
    out = M.stage(spark, df, "")
    want = {r.doc_id: r.copies for r in M.mixed(df).collect()}
    assert out.columns == df.columns
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == {k: v for k, v in want.items() if v}


def test_many_sources_and_long_texts(spark):
    rnd = random.Random(3)
    check(spark, [(i, "w " * rnd.randrange(1, 30), f"s{rnd.randrange(400)}", 1, "x") for i in range(1500)] + [(9999, "word " * 200_000, "s1", 1, "x")])


def test_running_sums(spark):
    rnd = random.Random(8)
    rows = [(i, rnd.randrange(50)) for i in range(300)]
    out, every = M.with_running_sums(spark.createDataFrame(rows, "k long, v long"), [M.F.col("v").asc(), M.F.col("k").asc()], ["v"])
    want, at = [], 0
    for place, (k, v) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])), 1):
        want.append((k, place, at))
        at += v
    assert sorted((r.k, r.place, r.before_v) for r in out.collect()) == sorted(want) and every["v"] == at
