import hashlib
import random
import zlib
from collections import defaultdict

from headroom.llm import turntrie as T

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - c % 100, [])[:h] + ts[h:])
    nodes = defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            nodes[ts[:d]].append(c)
    out = []
    for p, members in nodes.items():
        sub = [q for q in nodes if q[: len(p)] == p]
        children = lambda q: [x for x in nodes if len(x) == len(q) + 1 and x[: len(q)] == q]
        saved = sum((len(nodes[q]) - 1) * (len(q[-1][1]) if q else 0) for q in sub)
        ends = ",".join(str(c) for c in sorted(c for c in members if built[c] == p))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(children(p)), sum(not children(q) for q in sub), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, schema="conv_id long, turn long, role string, text string"):
    return sorted((tuple(r[c] for c in COLUMNS) for r in T.trie(spark.createDataFrame(rows, schema)).collect()), key=str)


def conversations(rnd, ids, most=6, texts=4):
    return [(c, k, rnd.choice(["user", "assistant", None]), rnd.choice([None, "", "é" * 3, *[f"text {i}" for i in range(texts)]])) for c in ids for k in range(rnd.randrange(1, most))]


def test_nodes_match_brute_force(spark):
    rnd = random.Random(1)
    rows = conversations(rnd, [*range(0, 40), *range(195, 240), 1005, 1006])
    rnd.shuffle(rows)
    assert got(spark, rows) == brute(rows)


def test_blocks_of_places_and_ids(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 4)
    rnd = random.Random(2)
    long = [(7, k, "user", f"turn {k % 3}") for k in range(40)] + [(8, k, "user", f"turn {k % 3}") for k in range(37)]
    copies = [(c, k, "user", "the same") for c in range(300, 340) for k in range(8)]
    rows = long + copies + conversations(rnd, range(500, 520))
    rnd.shuffle(rows)
    assert got(spark, rows) == brute(rows)


def test_nulls_ties_repeats_clashing_columns_and_none(spark):
    rows = [(None, 0, "user", "no id"), (5, None, "user", "first"), (5, 0, None, None), (5, 0, None, None), (6, 1, "a", "b"), (2**40, 0, "x" * 10, "y" * 100_000), (9, 0, "user", "x"), (9, 0, "user", "x")]
    assert got(spark, rows) == brute(rows)
    wide = [(*r, "x", 1, 2, "y") for r in rows]
    assert got(spark, wide, "conv_id long, turn long, role string, text string, node string, depth int, n int, one string") == brute(rows)
    assert got(spark, []) == []
    # a conversation whose turns all go has no turn of its own left
    alone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 2)
    assert got(spark, [(alone, 0, "user", "gone")]) == brute([(alone, 0, "user", "gone")])
