"""Near-duplicates by SimHash fingerprints and a binary-trie self-join.

The links between fingerprints at most `budget` bits apart are found by tries that are traversed
against themselves: a pair of nodes descends together, adds up the bits in which it differs, and is
dropped as soon as the sum exceeds the budget. So that Spark can deal the work out, the 64 bits are
cut into blocks and a trie is built for each choice of blocks that may come first; by the pigeonhole
principle any two linked fingerprints agree on the head of at least one of these tries, so node pairs
inside a head need no error there and each head is an independent sub-trie. The number of blocks
follows the number of fingerprints and the budget. A head that is large nevertheless (many near
copies of one text) is cut again along the bits that vary in it, as often as needed, again without
losing a link. Node pairs are visited by the bits they differ in, and links are folded into a forest
at once: node pairs within one tree of it are dropped, so that a group of near copies costs neither
memory nor time for all its pairs.

Defined cases: null text is the empty text; texts without words have fingerprint zero and link like
any other; rows with equal text always share a component; ties (equal doc_ids) are kept apart by their
rows; null doc_ids are kept, and a component whose doc_ids are all null has a null component_id;
repeated rows stay repeated; very long texts are hashed in slices; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, forget, read, signed

SHINGLE = 3
BUDGET = 3
HASH_SEED = 42
#: Distinct fingerprints that one head may hold before it is cut again.
HEAD_LIMIT = 20_000
#: Microseconds that a head's row and a pair of fingerprints in one head cost, about, as measured; rows count more for the disk that they take.
ROW_COST, PAIR_COST = 3.0, 0.1


def majority(hashes: np.ndarray) -> np.ndarray:
    """The bits set in over half of the hashes (rows of 64-bit words), in slices of bounded memory."""
    total = np.zeros(hashes.shape[1] * 64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        total += np.unpackbits(hashes[k : k + (1 << 16)].view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(total * 2 > len(hashes), bitorder="little").view("<u8")


def shingles(text: str | None, shingle: int) -> list[bytes]:
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and ASCII blanks only
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [joined] if words else []
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1].tolist()
    return [joined[s:e] for s, e in zip(starts, (ends[shingle - 1 :] - 1).tolist())]


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles of a text, as an unsigned 64-bit number."""
    from xxhash import xxh64_intdigest as digest

    parts = shingles(text, shingle)
    return int(majority(np.array([[digest(p, HASH_SEED)] for p in parts], "<u8"))[0]) if parts else 0


def simhash(text):
    """Column of fingerprints (long, the bits of the unsigned value) of a text column."""

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:  # without pandas, which takes memory in every worker
        return pa.array([signed(fingerprint(t.as_py())) for t in texts], pa.int64())

    return of(text)


def head_masks(blocks: int, exact: int, bits: list[int]) -> list[int]:
    """Masks of the heads: every choice of `exact` out of `blocks` nearly equal runs of the given bit places."""
    parts = [sum(1 << int(b) for b in p) for p in np.array_split(np.array(bits), blocks)]
    return [sum(c) for c in combinations(parts, exact)]


def masks_for(n: int, budget: int) -> list[int]:
    """budget + k blocks, k of them in a head: the k of the lowest cost for n fingerprints in rows and in pairs that share a head."""
    cost = lambda k: comb(budget + k, k) * (n * ROW_COST + n * n / 2 ** (64 * k / (budget + k)) / 2 * PAIR_COST)
    exact = min(range(1, 9), key=cost)
    return head_masks(budget + exact, exact, list(range(64)))


def trie_links(group: np.ndarray, fp: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Self-join of one trie for each group; returns a spanning forest of the links, as (fingerprint, root)."""
    order = np.lexsort((fp, group))
    group, fp = group[order], fp[order]
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.empty(0, int)
    ends = np.append(starts[1:], len(group))
    keep = ends - starts > 1
    root = _descend(fp, starts[keep], ends[keep], budget)
    moved = np.flatnonzero(root != np.arange(len(root)))
    return fp[moved], fp[root[moved]]


def _descend(fp: np.ndarray, lo: np.ndarray, hi: np.ndarray, budget: int, leaf: int = 128, most: int = 200_000) -> np.ndarray:
    """Root of each fingerprint in the forest of links. A node is a range of the sorted fingerprints; node pairs that differ in few bits come first."""
    root = np.arange(len(fp))
    todo: dict[tuple[int, int], list[np.ndarray]] = {(0, 63): [np.stack([lo, hi, lo, hi])]}
    ones: dict[int, np.ndarray] = {}
    for differ in range(budget + 1):
        for bit in range(63, -2, -1):
            waiting = todo.pop((differ, bit), [])
            while waiting:
                pairs = waiting.pop()
                if pairs.shape[1] > most:  # so many at a time that their children fit in memory
                    waiting += [pairs[:, k : k + most] for k in range(0, pairs.shape[1], most)]
                    continue
                pairs = pairs[:, ~_one_tree(root, pairs)] if pairs.shape[1] > 1000 or len(fp) < 100_000 else pairs
                product = (pairs[1] - pairs[0]) * (pairs[3] - pairs[2])
                small = (product <= leaf) | (bit < 0)
                own = pairs[:, small]
                # by the number of places, so that a step fits in memory
                steps = np.cumsum(product[small]) // 2_000_000
                for k in np.unique(steps):
                    i, j = _leaf_pairs(own[:, steps == k])
                    near = np.bitwise_count(fp[i] ^ fp[j]) <= budget
                    root = _roots(root, i[near], j[near])
                pairs = pairs[:, ~small]
                if not pairs.shape[1]:
                    continue
                if bit not in ones:
                    ones[bit] = np.concatenate(([0], np.cumsum((fp >> np.uint64(bit)) & np.uint64(1)))).astype(np.int32)
                alo, ahi, blo, bhi = pairs
                amid, bmid = (h - (ones[bit][h] - ones[bit][x]) for x, h in ((alo, ahi), (blo, bhi)))
                other = alo != blo
                same = np.concatenate([np.stack([alo, amid, blo, bmid]), np.stack([amid, ahi, bmid, bhi])], axis=1)
                cross = np.concatenate([np.stack([alo, amid, bmid, bhi]), np.stack([amid, ahi, blo, bmid])[:, other]], axis=1)
                for d, children in ((differ, same), (differ + 1, cross)):
                    children = children[:, (children[0] < children[1]) & (children[2] < children[3]) & ((children[0] != children[2]) | (children[1] - children[0] > 1))]
                    if d <= budget and children.shape[1]:
                        todo.setdefault((d, bit - 1), []).append(children)
    return root


def _one_tree(root: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Whether all fingerprints of both nodes are in one tree of the forest already."""
    alo, ahi, blo, bhi = pairs
    changes = np.concatenate(([0], np.cumsum(root[1:] != root[:-1])))
    return (changes[ahi - 1] == changes[alo]) & (changes[bhi - 1] == changes[blo]) & (root[alo] == root[blo])


def _leaf_pairs(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    alo, ahi, blo, bhi = pairs
    width = bhi - blo
    each = (ahi - alo) * width
    pair = np.repeat(np.arange(pairs.shape[1]), each)
    k = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    i, j = alo[pair] + k // width[pair], blo[pair] + k % width[pair]
    once = (alo[pair] != blo[pair]) | (i < j)
    return i[once], j[once]


def _roots(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The forest `root` (smallest reachable index of each vertex) with the links i, j."""
    apart = root[i] != root[j]
    i, j = i[apart], j[apart]
    while len(i):
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        while (root != root[root]).any():
            root = root[root]
        apart = root[i] != root[j]
        i, j = i[apart], j[apart]
    return root


def _longer(heads: DataFrame, hot: DataFrame, budget: int) -> DataFrame:
    """The rows of hot heads (m, v, varying: the bits that vary in it) under every choice of `budget` of 2 * `budget` blocks of these bits."""
    blocks = 2 * budget
    bits = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.expr("varying").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), b)) != 0)
    n = F.size("bits")
    at = lambda i: F.floor(n * i / blocks).cast("int")
    block = lambda i: F.aggregate(F.slice("bits", at(i) + 1, at(i + 1) - at(i)), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b)))
    cutup = hot.withColumn("bits", bits).select("m", "v", F.array(*[block(i) for i in range(blocks)]).alias("b"))
    masks = [sum(1 << k for k in c) for c in combinations(range(blocks), budget)]
    chosen = lambda c: F.aggregate(F.filter("b", lambda _, k: F.lit(c).bitwiseAND(F.call_function("shiftleft", F.lit(1), k)) != 0), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))
    inner = cutup.select("m", "v", F.explode(F.array(*[chosen(c) for c in masks])).alias("mask")).distinct()
    # a head's number only keeps heads apart: should two get the same one, their pairs are compared as well
    return heads.join(inner, ["m", "v"]).select(*[c for c in heads.columns if c not in ("m", "v")], F.xxhash64("m", "v", "mask").alias("m"), F.col("fp").bitwiseAND(F.col("mask")).alias("v"))


def near_links(prints: DataFrame, budget: int = BUDGET, head_limit: int = HEAD_LIMIT) -> DataFrame:
    """(a, b): a spanning forest of the links within each head, over the distinct fingerprints of column fp."""
    masks = masks_for(prints.count(), budget)
    entry = F.explode(F.array(*[F.struct(F.lit(k).cast("long").alias("m"), F.col("fp").bitwiseAND(F.lit(signed(m)).cast("long")).alias("v")) for k, m in enumerate(masks)]))
    heads = prints.select("fp", entry.alias("h")).select("fp", "h.m", "h.v")
    varying = F.bit_or("fp").bitwiseAND(F.bitwise_not(F.bit_and("fp"))).alias("varying")
    while True:
        hot = heads.groupBy("m", "v").agg(F.count(F.lit(1)).alias("n"), varying).filter(F.col("n") > head_limit)
        # a head in which few bits vary can't be cut further, nor can it hold more than their combinations
        hot = cut(hot.filter(F.bit_count("varying") > 2 * budget + 8), "simhash-hot")
        if not hot.limit(1).count():
            break
        heads = cut(heads.join(hot, ["m", "v"], "left_anti").select("fp", "m", "v").unionByName(_longer(heads, hot, budget).select("fp", "m", "v")), "simhash-heads")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            m, v = (batch.column(k).to_numpy() for k in ("m", "v"))
            if held and sum(b.num_rows for b in held) > 200_000:
                changes = np.flatnonzero((m[1:] != m[:-1]) | (v[1:] != v[:-1]))
                if len(changes):  # what is before the last change is whole
                    last = int(changes[-1]) + 1
                    yield _joined([*held, batch.slice(0, last)], budget)
                    held = [batch.slice(last)]
                    continue
            held.append(batch)
        if held:
            yield _joined(held, budget)

    dealt = heads.repartition("m", "v").sortWithinPartitions("m", "v")
    return dealt.select("fp", "m", "v").mapInArrow(join, "a long, b long").distinct()


def _joined(batches: list[pa.RecordBatch], budget: int) -> pa.RecordBatch:
    m, v, fp = (np.concatenate([b.column(c).to_numpy() for b in batches]) for c in ("m", "v", "fp"))
    new = np.concatenate(([True], (m[1:] != m[:-1]) | (v[1:] != v[:-1])))
    a, b = trie_links(np.cumsum(new), fp.view(np.uint64), budget)
    return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])


def connected(edges: DataFrame) -> DataFrame:
    """(v, root) for each vertex of edges (a, b) but the roots: stars by alternating large-star and small-star steps."""
    edges = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return edges.select(F.col("a").alias("v"), F.col("b").alias("root"))
        before = mark
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("low", "a"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a > b").distinct()
        large = cut(large, "links")
        forget(edges)
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(low.select("a", F.col("low").alias("b")))
        edges = cut(small.filter("a > b").distinct(), "links")
        forget(large)


def components(prints: DataFrame, budget: int = BUDGET) -> DataFrame:
    """(fp, component_id) for rows (fp, doc_id): the smallest doc_id reachable over links."""
    reps = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-reps")
    roots = connected(near_links(reps.select("fp"), budget))
    rooted = reps.join(roots, reps.fp == roots.v, "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of docs (doc_id, text)."""
    prints = cut(docs.select("doc_id", simhash(F.col("text")).alias("fp")), "simhash")
    found = components(prints, budget)
    return prints.join(found, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))

