"""Hard negatives by Fagin's threshold algorithm.

All rows are dealt to blocks by a hash. A task holds one block with, for each dimension, the list of its
rows in the order of that component, and takes the anchors one after the other. An anchor reads every
list from the end that its own component's sign favours, in steps that double; rows that turn up are
scored in full by their integer inner product; and the anchor is done as soon as the threshold, the
score that the components last read would add up to, is strictly below what could still enter: the
score of the last place that counts, or the lower end of a window that isn't full. First the positives
of each anchor are searched in the lists of its label, then the negatives in the windows that follow
from the positives' scores. A task yields the few best of a block, and Spark merges the blocks.

The anchors are a stated query set against all rows: every anchor meets every block, and no pair of
rows is written but the best of a block. In 64 dimensions the threshold falls slowly, so that most rows
of a block are scored before an anchor is done; the blocks bound the memory, not the work.

Defined cases: rows with a null label or vector, or with a null or non-finite component, take no part;
null vec_ids are no anchors, keep their label and come last among ties; rows with equal vec_id and
score are ordered by their row, so repeated rows each count, and repeated anchors each return their
rows; vectors of different lengths meet in the components that both have, and empty ones score zero;
components are limited to what keeps scores in 64 bits, 3.8e8 for 64 dimensions (after the factor of
256); vectors may be long; an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, read, with_row_key

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative's score is at least LOW and at most HIGH percent of the positive's.
LOW, HIGH = 50, 95
ANCHOR_STEP, MOVED_STEP, LABELS = 50, 7, 10
#: Rows of a block: a 256th of all rows, between these.
LEAST_ROWS, MOST_ROWS = 2048, 1 << 18
#: Places that an anchor reads of each list before it first tests the threshold.
FIRST_STEP = 16
NO_ID = np.iinfo(np.int64).max


def prepared(embeddings: DataFrame) -> DataFrame:
    """(row, vec_id, label, q: integer components) of the rows that take part."""
    x = F.col("embedding")
    usable = F.col("label").isNotNull() & x.isNotNull() & F.forall(F.coalesce(x, F.array()), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    most = F.least(F.lit(2.0**31 - 1), F.floor(F.sqrt(F.lit(2.0**63 - 2048) / F.greatest(F.size(x), F.lit(1)))).cast("double"))
    q = F.transform(x, lambda v: F.greatest(-most, F.least(most, F.floor(v.cast("double") * SCALE).cast("double"))).cast("int"))
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % MOVED_STEP == 0, (label + 1) % LABELS).otherwise(label)
    return cut(with_row_key(embeddings.filter(usable), "row").select("row", "vec_id", moved.alias("label"), q.alias("q")), "vectors")


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of integers from an Arrow list column; shorter rows end in zeros."""
    values, lengths = column.flatten().to_numpy(), np.diff(column.offsets.to_numpy())
    width = int(lengths.max()) if len(lengths) else 0
    if len(lengths) and lengths.min() == width:
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), values.dtype)
    out[np.arange(width) < lengths[:, None]] = values
    return out


class Lists:
    """The rows of a block, and for each dimension their order by that component."""

    def __init__(self, row: np.ndarray, vec_id: np.ndarray, label: np.ndarray, q: np.ndarray) -> None:
        self.row, self.vec_id, self.label = row, vec_id, label
        self.q, self.exact = q.astype(np.float64), None
        self.most = float(np.abs(self.q).max()) if q.size else 0.0
        self.order = np.argsort(q, axis=0, kind="stable").T.astype(np.int32)

    def scan(self, anchor: np.ndarray, done: Callable[[np.ndarray, np.ndarray, float], bool]) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the rows read until done(places, scores, threshold) holds or the lists end."""
        n, width = len(self.row), min(self.q.shape[1], len(anchor))
        q, a = self.q, anchor[:width].astype(np.float64)
        if width * self.most * float(np.abs(a).max(initial=0)) >= 2.0**53:  # floats would round
            self.exact = self.q.astype(np.int64) if self.exact is None else self.exact
            q, a = self.exact, anchor[:width].astype(np.int64)
        up, down = np.flatnonzero(a > 0), np.flatnonzero(a < 0)
        seen, scores = np.zeros(n, bool), np.zeros(n, q.dtype)
        start, end = 0, min(FIRST_STEP, n)
        while True:
            # where every row has been reached as good as surely, the rest costs less to score than to look up
            fresh = ~seen
            if end < n and (len(up) or len(down)):
                reached = np.zeros(n, bool)
                reached[self.order[up, n - end : n - start]] = True
                reached[self.order[down, start:end]] = True
                fresh &= reached
            new = np.flatnonzero(fresh)
            scores[new] = q[new, :width] @ a
            seen[new] = True
            places = np.flatnonzero(seen)
            if len(places) == n:
                return places, scores
            edge = np.concatenate([q[self.order[up, n - end], up] * a[up], q[self.order[down, end - 1], down] * a[down]])
            if done(places, scores[places], edge.sum()):
                return places, scores[places]
            start, end = end, min(2 * end, n)

    def first(self, places: np.ndarray, scores: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
        """The `count` first by score, vec_id and row."""
        if len(places) > count:
            near = scores >= np.partition(scores, len(scores) - count)[len(scores) - count]
            places, scores = places[near], scores[near]
        best = np.lexsort((self.row[places], self.vec_id[places], -scores))[:count]
        return places[best], scores[best]


def _kth(scores: np.ndarray, count: int, otherwise: float) -> float:
    return np.partition(scores, len(scores) - count)[len(scores) - count] if len(scores) >= count else otherwise


def best_positives(lists: Lists, row: int, anchor: np.ndarray, count: int) -> list[tuple[int, int]]:
    """(place, score) of the best other rows; lists holds rows of the anchor's label alone."""

    def others(places: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = lists.row[places] != row
        return places[own], scores[own]

    found = others(*lists.scan(anchor, lambda p, s, threshold: threshold < _kth(others(p, s)[1], count, -np.inf)))
    return list(zip(*(x.tolist() for x in lists.first(*found, count))))


def best_negatives(lists: Lists, label: int, anchor: np.ndarray, positives: list[int], count: int) -> list[list[tuple[int, int]]]:
    """For each positive's score the (place, score) of the best rows of other labels in its window."""
    low, high = [-(-LOW * s // 100) for s in positives], [HIGH * s // 100 for s in positives]

    def windows(places: np.ndarray, scores: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        other = lists.label[places] != label
        places, scores = places[other], scores[other]
        for lo, hi in zip(low, high):
            inside = (scores >= lo) & (scores <= hi)
            yield places[inside], scores[inside]

    def done(places: np.ndarray, scores: np.ndarray, threshold: float) -> bool:
        return all(lo > hi or threshold < _kth(s, count, lo) for (_, s), lo, hi in zip(windows(places, scores), low, high))

    return [list(zip(*(x.tolist() for x in lists.first(p, s, count)))) for p, s in windows(*lists.scan(anchor, done))]


def _searched(rows: DataFrame, anchors: DataFrame, find: Callable[..., list[tuple]], columns: dict[str, str], wants: list[str], n: int) -> DataFrame:
    """find(block, anchor's values of wants) for each anchor and block, as rows of columns. A task streams: the rows of a block come first, then its anchors."""
    blocks = max(1, -(-n // min(MOST_ROWS, max(LEAST_ROWS, n // 256))))
    own = [F.lit(0).alias("kind"), "row", "vec_id", "label", "q"]
    more = [F.lit(None).cast("array<long>").alias(c) for c in wants]
    dealt = rows.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), *own, *more)
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), *own[1:], *wants)
    types = [pa.int64() if kind == "long" else pa.int32() for kind in columns.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        block, at = None, None
        for batch in batches:
            out: list[tuple] = []
            if not batch.num_rows:
                continue
            number, kind = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], (number[1:] != number[:-1]) | (kind[1:] != kind[:-1])))).tolist()
            for s, e in zip(starts, [*starts[1:], batch.num_rows]):
                part = batch.slice(s, e - s)
                row, label, q = part.column("row").to_numpy(), part.column("label").to_numpy(), _matrix(part.column("q"))
                vec_id = part.column("vec_id").fill_null(NO_ID).to_numpy()
                if number[s] != at:
                    at, block, held = number[s], None, []
                if kind[s] == 0:
                    held.append((row, vec_id, label, q))
                    continue
                if held:
                    block, held = _Block(held), []
                if block is None:  # a block without rows
                    continue
                asks = [part.column(c).to_pylist() for c in wants]
                for k in range(e - s):
                    out += find(block, int(row[k]), int(vec_id[k]), int(label[k]), q[k], *[a[k] for a in asks])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([None if v == NO_ID else v for v in c], t) for c, t in zip(zip(*out), types)], list(columns))

    schema = ", ".join(f"{c} {t}" for c, t in columns.items())
    return dealt.unionByName(asked).repartition("block").sortWithinPartitions("block", "kind").mapInArrow(run, schema)


class _Block:
    """The rows of a block, with their lists over all and over each label as they are asked for."""

    def __init__(self, parts: list[tuple]) -> None:
        width = max(p[3].shape[1] for p in parts)
        self.parts = [np.concatenate([p[k] for p in parts]) for k in range(3)]
        self.parts.append(np.concatenate([np.pad(p[3], ((0, 0), (0, width - p[3].shape[1]))) for p in parts]))
        self.known: dict[int | None, Lists] = {}

    def of(self, label: int | None) -> Lists:
        if label not in self.known:
            own = slice(None) if label is None else self.parts[2] == label
            self.known[label] = Lists(*[p[own] for p in self.parts])
        return self.known[label]


def _ranked(found: DataFrame, keys: list[str], count: int, out: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("found_id").asc_nulls_last(), "found_row")
    return found.withColumn(out, F.row_number().over(order)).filter(F.col(out) <= count)


def hard_negatives(embeddings: DataFrame, is_anchor: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """(anchor_row, anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score) for each anchor and positive."""
    rows = prepared(embeddings)
    n = rows.count()
    anchors = rows.filter(F.col("vec_id") % ANCHOR_STEP == 0 if is_anchor is None else is_anchor)

    def near(block: _Block, row: int, vec_id: int, label: int, q: np.ndarray) -> list[tuple]:
        lists = block.of(label)
        return [(row, int(lists.row[p]), int(lists.vec_id[p]), int(s)) for p, s in best_positives(lists, row, q, positives)] if len(lists.row) else []

    found = _searched(rows, anchors, near, {"row": "long", "found_row": "long", "found_id": "long", "score": "long"}, [], n)
    best = _ranked(found, ["row"], positives, "place").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "found_id", "score"))).alias("p"))
    best = best.select("row", F.col("p.found_id").alias("ids"), F.col("p.score").alias("scores"))
    asked = cut(anchors.join(best, "row"), "anchors")

    def hard(block: _Block, row: int, vec_id: int, label: int, q: np.ndarray, ids: list[int | None], scores: list[int]) -> list[tuple]:
        lists = block.of(None)
        each = enumerate(zip(ids, scores, best_negatives(lists, label, q, scores, negatives)), 1)
        return [(row, vec_id, k, NO_ID if i is None else i, ps, int(lists.row[p]), int(lists.vec_id[p]), int(s)) for k, (i, ps, got) in each for p, s in got]

    columns = {"anchor_row": "long", "anchor_id": "long", "positive_rank": "int", "positive_id": "long", "positive_score": "long", "found_row": "long", "found_id": "long", "score": "long"}
    ranked = _ranked(_searched(rows, asked, hard, columns, ["ids", "scores"], n), ["anchor_row", "positive_rank"], negatives, "rank")
    return ranked.select("anchor_row", "anchor_id", "positive_id", "positive_rank", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(read(spark, sf_dir, "embeddings")).drop("anchor_row", "positive_rank")


def oracle_sql() -> str:
    """DuckDB SQL that scores every row against every anchor."""
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % {MOVED_STEP} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.rid AS anchor, a.vec_id AS anchor_id, r.rid, r.vec_id, a.label = r.label AS same, list_dot_product(a.q, r.q)::BIGINT AS score
  FROM v a JOIN v r ON a.rid <> r.rid WHERE a.vec_id % {ANCHOR_STEP} = 0
), p AS (
  SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, rid) AS place FROM s WHERE same
), n AS (
  SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY s.score DESC, s.vec_id, s.rid)::INTEGER AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND {LOW} * p.positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.positive_score WHERE p.place <= {POSITIVES}
)
SELECT * FROM n WHERE rank <= {NEGATIVES}"""
