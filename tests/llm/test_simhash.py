import random

import numpy as np
import xxhash

from headroom.llm import simhash as S


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for b in "\t\n\x0b\x0c\r":
        low = low.replace(b, " ")
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (fps[i] ^ fps[j]).bit_count() <= 3 and group[i] != group[j]:
                    group[i] = group[j] = min(group[i], group[j])
                    changed = True
    least = {}
    for (d, _), g in zip(rows, group):
        if d is not None:
            least[g] = min(least.get(g, d), d)
    return sorted(((d, f"{f:016x}", least.get(g)) for (d, _), f, g in zip(rows, fps, group)), key=str)


def test_fingerprint_matches_brute_force():
    rnd = random.Random(1)
    for n in (0, 1, 2, 3, 4, 50):
        text = "  ".join(rnd.choice(["Le", "Été", "of\tTHE", "a b", "x"]) for _ in range(n))
        assert S.fingerprint(text) == brute_fingerprint(text)
    assert S.fingerprint(None) == 0


def test_trie_links_find_every_pair():
    rnd = np.random.default_rng(3)
    base = rnd.integers(0, 2**63, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate([base, *[base ^ (np.uint64(1) << rnd.integers(0, 64, 40, dtype=np.uint64)) ^ (np.uint64(1) << rnd.integers(0, 64, 40, dtype=np.uint64)) for _ in range(9)]]))
    a, b = S.trie_links(np.zeros(len(fps), int), fps, 3)
    want = S._roots(np.arange(len(fps)), *np.array([(i, j) for i in range(len(fps)) for j in range(i) if int(fps[i] ^ fps[j]).bit_count() <= 3]).T)
    at = {int(f): i for i, f in enumerate(fps)}
    got = S._roots(np.arange(len(fps)), np.array([at[int(x)] for x in a]), np.array([at[int(x)] for x in b]))
    assert (got == want).all()


def test_components_match_brute_force(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rnd.choices(words, k=120)) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(60):
        t = base[i % 6].split()
        t[rnd.randrange(120)] = "new"
        rows.append((100 + i, " ".join(t)))
    rows += [(7, None), (3, ""), (None, base[0]), (None, "alone here"), (5, base[5]), (5, base[5])]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, fp int, m int")
    got = sorted((tuple(r) for r in S.near_duplicates(df).collect()), key=str)
    assert got == brute_components(rows)
    prints = df.select(S.simhash(df.text).alias("fp")).distinct()
    few = S.connected(S.near_links(prints)).collect()
    assert sorted(map(tuple, S.connected(S.near_links(prints, head_limit=2)).collect())) == sorted(map(tuple, few))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(df).count() == 0


def test_dense_head_folds_links():
    """Many fingerprints that differ in few bits: the same trees as by comparing all pairs, without keeping all links."""
    rnd = np.random.default_rng(2)
    low = np.unique(rnd.integers(0, 2**16, 3000, dtype=np.uint64))
    root = S._descend(low, np.array([0]), np.array([len(low)]), 2, most=500)
    x = np.bitwise_count(low[:, None] ^ low[None, :])
    i, j = np.nonzero(np.tril(x <= 2, -1))
    assert (root == S._roots(np.arange(len(low)), i, j)).all()


def test_hot_heads_are_cut_along_varying_bits(spark):
    rnd = np.random.default_rng(6)
    low = np.unique(rnd.integers(0, 2**18, 4000))
    prints = spark.createDataFrame([(int(x) << 11,) for x in low], "fp long")
    got = {r.v: r.root for r in S.connected(S.near_links(prints, head_limit=200)).collect()}
    x = np.bitwise_count(low[:, None].astype(np.uint64) ^ low[None, :].astype(np.uint64))
    want = S._roots(np.arange(len(low)), *np.nonzero(np.tril(x <= 3, -1)))
    groups = lambda root: sorted(map(sorted, {r: [k for k in range(len(low)) if root[k] == r] for r in set(root)}.values()))
    assert groups([got.get(int(v) << 11, int(v) << 11) for v in low]) == groups(want.tolist())


def test_fingerprints_need_no_pandas(spark):
    """Every worker imports what its functions need: pandas would take memory in each."""
    from pyspark.sql import functions as F

    def loaded(batches):
        import sys

        import pyarrow as pa

        for b in batches:
            S.fingerprint("a b c d")
            yield pa.RecordBatch.from_arrays([pa.array([hasattr(S, "pd")] * b.num_rows)], ["pandas"])

    assert not any(r.pandas for r in spark.range(3).mapInArrow(loaded, "pandas boolean").collect())
    texts = ["a b c d", None, "", "é " * 50]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(F.col("text"), S.simhash(F.col("text")).alias("fp"))
    assert "pandas" not in df._jdf.queryExecution().toString().lower() and {r.text: r.fp for r in df.collect()} == {t: S.signed(brute_fingerprint(t)) for t in texts}
