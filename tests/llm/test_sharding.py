import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from headroom.llm import sharding as S


def check(spark, rows, shards):
    out = S.sharded(spark.createDataFrame(rows, "doc_id long, text string, size int"), shards).collect()
    want = sorted(((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, _ in rows), key=str)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in out), key=str) == want
    bytes_, slots = defaultdict(int), defaultdict(list)
    for r in out:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        bytes_[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return out, [bytes_[k] for k in range(shards)]


def test_shards_are_near_equal_and_keep_copies_together(spark):
    rnd = random.Random(1)
    rows = [(i, "".join(rnd.choices("abcé ", k=rnd.randrange(400))), 1) for i in range(3000)]
    rows += [(5000 + i, f"copy of text {i % 20}", 1) for i in range(60)] + [(None, None, 1), (None, "", 1)]
    out, sizes = check(spark, rows, 40)
    assert max(sizes) - min(sizes) < 0.12 * sum(sizes) / 40
    of = defaultdict(set)
    for r in out:
        of[r.text_crc32].add(r.shard)
    assert all(len(of[zlib.crc32(f"copy of text {i}".encode())]) == 1 for i in range(20))


def brute_tree(rows, shards, first, spans, slack, node, seen):
    """Follow the k-d tree over all rows: the widest dimension, and a split at its weighted quantile, found by sorting."""
    seen.append(first)
    if shards == 1:
        assert not node.children
        return {r["__row"]: first for r in rows}
    half = shards // 2
    assert [c.first for c in node.children] == [first, first + half] and [c.shards for c in node.children] == [half, shards - half]
    if not rows:
        return brute_tree([], half, first, spans, slack, node.children[0], seen) | brute_tree([], shards - half, first + half, spans, slack, node.children[1], seen)
    width = {c: (max(r[c] for r in rows) - min(r[c] for r in rows)) / spans[c] for c in S.DIMENSIONS}
    assert width[node.dimension] == max(width.values())
    ordered, want = sorted(rows, key=lambda r: r[node.dimension]), sum(r["size"] for r in rows) * half / shards
    upto, best = 0, want
    for k, r in enumerate(ordered):
        upto += r["size"]
        if k + 1 == len(ordered) or ordered[k + 1][node.dimension] != r[node.dimension]:
            best = min(best, abs(upto - want))
    left, right = ([r for r in rows if (r[node.dimension] < node.split) == side] for side in (True, False))
    assert abs(sum(r["size"] for r in left) - want) <= best + slack
    return brute_tree(left, half, first, spans, slack, node.children[0], seen) | brute_tree(right, shards - half, first + half, spans, slack, node.children[1], seen)


@pytest.mark.parametrize("shards, seed", [(40, 2), (7, 3)])
def test_tree_follows_brute_force(spark, shards, seed):
    """Every node splits where sorting all its rows finds the best split, to the stated tolerance; rows land in its leaves."""
    rnd = random.Random(seed)
    rows = [(i, "".join(rnd.choices("abcé語 ", k=int(rnd.paretovariate(0.9) * 8) % 4000))) for i in range(1200)]
    rows += [(9000 + i, "the same text") for i in range(30)] + [(None, None), (7, ""), (7, ""), (8, "long " * 8000)]
    placed = S.coordinates(spark.createDataFrame(rows, "doc_id long, text string"), shards)
    tree = S.grow(placed, shards)
    table = [r.asDict() for r in placed.collect()]
    spans = {c: max(1, max(r[c] for r in table) - min(r[c] for r in table)) for c in S.DIMENSIONS}
    seen = []
    want = brute_tree(table, shards, 0, spans, S.TOLERANCE * sum(r["size"] for r in table) / shards, tree, seen)
    assert set(range(shards)) <= set(seen)
    got = {r["__row"]: r.shard for r in placed.select("__row", tree.expression(lambda n: F.lit(n.first)).alias("shard")).collect()}
    assert got == want


def test_heavy_group_is_spread(spark):
    rows = [(i, "the same text for all", 1) for i in range(2000)] + [(i, f"own {i}", 1) for i in range(1000)]
    _, sizes = check(spark, rows, 10)
    assert max(sizes) - min(sizes) < 0.05 * sum(sizes) / 10


def test_few_rows_and_none(spark):
    check(spark, [(1, "a", 1), (1, "a", 1), (2, None, 1)], 40)
    assert S.sharded(spark.createDataFrame([], "doc_id long, text string")).count() == 0
