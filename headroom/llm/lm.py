"""Language-model scores by deleted interpolation of word n-grams.

A text is a chain of words and one end. The probability of a token is mixed from the lowest order up:
P1 = m * c(w)/N + (1 - m) / (V + 1), and P2 = l * c(v w)/c(v) + (1 - l) * P1 given the word v before it
(or the start). The weight l depends on the frequency bucket of the context v. Weights are learned by
expectation-maximisation on held-out counts: a part of the training documents is deleted from the
counts for that, and put back for the final estimates. A word that training lacks is one event, as in
the base score.

Counts cover all training documents. The HOT most frequent words are known to every task with their
counts (a fixed number); rarer words go by their 64-bit hash. As contexts these either form one class, or
(every_context, as the query has it) each is one of its own: their pairs are blocks apart in each bucket,
which list their contexts and get the counts of these from the vocabulary by a join.
Every pair (word, context) with its documents is dealt to a bucket: pairs of hot words by ranges of
words of equal mass, very frequent words over several buckets by context, rare words by their hash,
so that a rare word's own count is the sum over its bucket. A pair is no more frequent than either of
its words; where both have more places than a bucket is meant to hold, the places of the pair are
spread over as many buckets as the less frequent of the two may need, and the counts of its parts are
added up before scoring. So a bucket holds about BUCKET places at any size of the input, whatever pair
repeats. Pairs travel as sorted arrays, a few bytes a place. What the buckets of a task add to the
documents is added up once more by ranges of documents.

Defined cases: null and empty texts have the one token `end`; null doc_ids count as the empty text
in the fold (remainder 0: held out); repeated rows are kept, one result row each; words that tie in
frequency are ranked by their bytes; very long texts are cut over several buckets like others and
take memory in proportion to the longest one; without training documents every probability is 1; an
empty table gives an empty result; other columns are ignored. Two words with the same 64-bit hash
would count as one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, forget, read, remainder, with_row_key

FOLDS = 10
#: Of the training folds, the one whose counts the weights are learned on.
DELETED = 1
#: Words that every task knows; codes from 1, by frequency.
HOT = 1 << 18
#: Frequency buckets of contexts, by powers of two.
CLASSES = 24
#: Held-out counts are summed by the ratio of two estimates, in hundredths of a decade, up to this many decades.
DECADES = 30
ALPHA = 0.1
#: Distinct words that a task gathers before it hands them on, and places that it deals out at once.
GATHERED = 400_000
FLUSH = 1_500_000
#: Documents whose sums a task adds up before it hands them on.
SUMMED = 500_000
#: Rare words whose codes a task remembers.
REMEMBERED = 200_000
#: Places that a bucket is meant to hold.
BUCKET = 150_000
#: Neighbouring places of a spread pair that stay together.
RUN = 4096
#: Code of the end as a word and of the start as a context; rare words have the high bit.
END = 0
RARE = 1 << 63
#: Spark's own, so that the vocabulary has the same codes.
HASH_SEED = 42
_CONTEXT, _PLACE = 20, 24  # bits of a context's code, and of a document's place in a flush


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, kept, deleted): counts of the words of training rows (fold, text); the null word counts the documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, ends = (Counter(), Counter()), [0, 0]

        def out() -> pa.RecordBatch:
            words = list(dict.fromkeys([*counts[0], *counts[1]]))
            columns = [pa.array([*words, None], pa.binary())] + [pa.array([*[c[w] for w in words], n], pa.int64()) for c, n in zip(counts, ends)]
            return pa.RecordBatch.from_arrays(columns, ["word", "kept", "deleted"])

        for batch in batches:
            for fold, text in zip(batch.column("fold").to_pylist(), batch.column("text")):
                if fold:
                    k = int(fold == DELETED)
                    ends[k] += 1
                    counts[k].update((text.as_py() or "").encode().lower().split())
            if len(counts[0]) + len(counts[1]) > GATHERED:
                yield out()
                counts, ends = (Counter(), Counter()), [0, 0]
        yield out()

    parts = docs.select("fold", "text").mapInArrow(count, "word binary, kept long, deleted long")
    return parts.groupBy("word").agg(F.sum("kept").alias("kept"), F.sum("deleted").alias("deleted"))


def frequency_class(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(counts, 1)).astype(int), CLASSES - 1)


def learn_weights(ml: np.ndarray, lower: np.ndarray, where: np.ndarray, held: np.ndarray, classes: int = CLASSES, rounds: int = 30) -> np.ndarray:
    """EM: the weight of ml against lower in each class of `where`, on held-out counts."""
    m = np.full(classes, 0.5)
    total = np.bincount(where, held, classes)
    for _ in range(rounds):
        share = m[where] * ml
        share = share / np.maximum(share + (1 - m[where]) * lower, 1e-300)
        m = np.where(total > 0, np.bincount(where, held * share, classes) / np.maximum(total, 1), m)
    return np.clip(m, 1e-4, 1 - 1e-4)


def cell_of(where: np.ndarray, ml: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Number of a cell (class, hundredths of log10(ml / low)): what EM needs, from a set of fixed size."""
    most = 100 * DECADES
    with np.errstate(divide="ignore"):
        step = np.clip(np.floor(np.log10(ml / low) * 100 + 0.5), -most, most)
    return where * (2 * most + 2) + np.where(ml > 0, step + most + 1, 0).astype(np.int64)


def learn_from_cells(cells: np.ndarray, held: np.ndarray) -> np.ndarray:
    most = 100 * DECADES
    where, step = np.divmod(cells.astype(np.int64), 2 * most + 2)
    return learn_weights(np.where(step > 0, 10.0 ** ((step - most - 1) / 100), 0.0), np.ones(len(step)), where, held.astype(float))


def _pack(a: np.ndarray) -> bytes:
    """Differences of an array, all first bytes before all second ones: small numbers leave runs of zeros to compress."""
    d = np.diff(a, prepend=a.dtype.type(0))
    return d.view(np.uint8).reshape(-1, a.itemsize).T.tobytes()


def _unpack(b: bytes, kind: str) -> np.ndarray:
    d = np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()
    return np.cumsum(d, dtype=kind)


class Codes(dict):
    """Codes of words: the hot ones as given, others by their hash."""

    room = REMEMBERED

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        code = xxh64_intdigest(word, HASH_SEED) | RARE
        if self.room:
            self.room -= 1
            self[word] = code
        return code


def ways(splits: np.ndarray, shares: np.ndarray, words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """Over how many buckets the places of each pair are spread; a rare word's pairs are never spread."""
    rare = words >= RARE
    return np.where(rare, 1, np.minimum(splits[np.where(rare, 0, words).astype(np.int64)], shares[contexts.astype(np.int64)]))


class Layout:
    """Which bucket a pair goes to."""

    def __init__(self, mass: np.ndarray, rare: int, bucket: int = BUCKET):
        """mass: training counts of `end` and the hot words; rare: that of all other words."""
        self.splits = np.maximum(1, -(-mass // bucket)).astype(np.int64)
        #: Of contexts (the start, the hot words, all others): buckets that the places of one would fill.
        self.shares = np.append(self.splits, max(1, -(-rare // bucket)))
        small = self.splits == 1
        self.first = np.where(small, np.cumsum(np.where(small, mass, 0)) // bucket, 0)
        used = int(self.first.max()) + 1
        self.first[~small] = used + np.cumsum(self.splits[~small]) - self.splits[~small]
        self.hot = used + int(self.splits[~small].sum())
        self.rare = rare // bucket + 1


def places(word: np.ndarray, first: np.ndarray, splits: np.ndarray, shares: np.ndarray, turn: int, hot_buckets: int, rare_buckets: int, every_context: bool = False) -> list[tuple[np.ndarray, ...]]:
    """(bucket, word, context, document) of every place of a flush, by bucket, word and context: first places of hot
    words, then those of rare words and, with every_context, of rare contexts, whose contexts have 64 bits.

    word: codes of whole texts, one after the other; turn: where this flush begins to deal out spread pairs.
    """
    doc_bits = np.uint64((1 << _PLACE) - 1)
    # the end of a text is followed by the first word of the next: its code is that of the start; all rare words are one context
    rest = np.zeros(len(word), np.uint64)
    rest[1:] = np.minimum(word[:-1], np.uint64(len(splits))) << np.uint64(_PLACE)
    rest[1:] |= np.cumsum(word[:-1] == END, dtype=np.uint64)
    apart = word >= RARE
    if every_context:
        apart[1:] |= word[:-1] >= RARE
    at = np.flatnonzero(apart)
    rare_word, rare_doc = word[at], rest[at] & doc_bits
    rare_context = np.where(at > 0, word[at - 1], np.uint64(END))
    if not every_context:
        rare_context = np.minimum(rare_context, np.uint64(len(splits)))
    np.logical_not(apart, out=apart)
    key, rest = word[apart], rest[apart]
    key <<= np.uint64(_CONTEXT + _PLACE)
    key |= rest
    del word, rest, apart, at
    key.sort()
    hot = (key >> np.uint64(_CONTEXT + _PLACE)).astype(np.uint32)
    d = (key & doc_bits).astype(np.uint32)
    key >>= np.uint64(_PLACE)
    c = (key & np.uint64((1 << _CONTEXT) - 1)).astype(np.uint32)
    del key
    bucket = (np.arange(len(hot)) // RUN + turn) % np.minimum(splits[hot], shares[c])
    bucket += c
    bucket %= splits[hot]
    bucket += first[hot]
    bucket = bucket.astype(np.int32)
    order = np.argsort(bucket, kind="stable").astype(np.uint32)
    out = [(bucket[order], hot[order].astype(np.uint64), c[order], d[order])]
    if len(rare_word):
        by_hash = lambda x, n: (x >> np.uint64(16)).astype(np.int64) % n
        rare = rare_word >= RARE
        of = np.where(rare, 0, rare_word).astype(np.int64)
        bucket = np.where(rare, hot_buckets + by_hash(rare_word, rare_buckets), first[of] + by_hash(rare_context, splits[of])).astype(np.int32)
        order = np.lexsort((rare_doc, rare_context, rare_word, bucket))
        out.append((bucket[order], rare_word[order], rare_context[order], rare_doc[order].astype(np.uint32)))
    return out


def dealt(docs: DataFrame, hot: list[bytes], layout: Layout, every_context: bool = False) -> DataFrame:
    """Pairs of each flush of documents by bucket, and (bucket below 0) the documents themselves."""
    sent = docs.sparkSession.sparkContext.broadcast((hot, layout.first, layout.splits, layout.shares))
    hot_buckets, rare_buckets = layout.hot, layout.rare
    spread = max(512, hot_buckets + rare_buckets)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh32_intdigest

        names, first, splits, shares = sent.value
        code = Codes(zip(names, range(1, len(names) + 1)))
        codes: list[int] = []
        part, classes = 0, []

        def flush(of: pa.DataType) -> Iterator[pa.RecordBatch]:
            turn = xxh32_intdigest(str(part))
            for bucket, w, c, d in places(np.array(codes, np.uint64), first, splits, shares, turn, hot_buckets, rare_buckets, every_context):
                if len(bucket):
                    yield packed_places(bucket, w, c, d << np.uint32(2) | np.array(classes, np.uint32)[d], of)

        def packed_places(bucket: np.ndarray, w: np.ndarray, c: np.ndarray, doc: np.ndarray, of: pa.DataType) -> pa.RecordBatch:
            starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            ends = np.append(starts[1:], len(bucket))
            packed = [pa.array([_pack(a[i:j]) for i, j in zip(starts, ends)], pa.binary()) for a in (w, c, doc)]
            none = len(starts)
            return pa.RecordBatch.from_arrays([pa.array(bucket[starts].astype(np.int32)), pa.array(np.full(none, part)), pa.nulls(none, of), pa.nulls(none, pa.bool_()), *packed], names_of)

        names_of = ["bucket", "row", "doc_id", "held_out", "words", "contexts", "docs"]
        for batch in batches:
            rows = batch.column("__row").to_numpy()
            folds = batch.column("fold").to_numpy()
            none = [pa.nulls(len(rows), pa.binary())] * 3
            yield pa.RecordBatch.from_arrays([pa.array((-1 - rows % spread).astype(np.int32)), batch.column("__row"), batch.column("doc_id"), pa.array(folds == 0), *none], names_of)
            for row, fold, text in zip(rows, folds, batch.column("text")):
                if not codes:
                    part, classes = int(row), []
                classes.append(2 if fold == 0 else int(fold == DELETED))
                codes += map(code.__getitem__, (text.as_py() or "").encode().lower().split())
                codes.append(END)
                if len(codes) >= FLUSH:
                    yield from flush(batch.schema.field("doc_id").type)
                    codes = []
        if codes:
            yield from flush(batch.schema.field("doc_id").type)

    return with_row_key(docs, "__row").select("__row", "doc_id", "fold", "text").mapInArrow(run, f"bucket int, row long, doc_id {kind}, held_out boolean, words binary, contexts binary, docs binary")


def _counts_of(words: np.ndarray, counts: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Count of each pair's word: a hot one's is known, a rare one's is the sum over its contexts."""
    rare = words >= RARE
    out = known[np.where(rare, 0, words).astype(np.int64)].astype(float)
    if rare.any():
        _, of = np.unique(words[rare], return_inverse=True)
        out[rare] = np.bincount(of, counts[rare])[of]
    return out


def counted(pairs: DataFrame, sent, types: int, weight: float) -> DataFrame:
    """One row a bucket: its distinct pairs with their counts, their documents, and held-out counts by cell; and
    another one of its pairs of rare contexts, if it has any.

    Of pairs that are spread over several buckets the counts are this bucket's alone; they are listed in
    `spread_pairs` with these counts, and add nothing to the cells. Nor do pairs of rare contexts: these are
    listed in `rare_contexts`, and their held-out pairs in `told_at` (the place there) and beside it.
    """
    kind = pairs.schema["doc_id"].dataType.simpleString()
    lists = ("cells", "held", "spread_pairs", "spread_kept", "spread_deleted", "rare_contexts", "told_at", "told_kept", "told_deleted")

    def count(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket < 0:
            n = table.num_rows
            return pa.table({**{c: table[c] for c in ("bucket", "row", "doc_id", "held_out")}, **{c: pa.nulls(n, pa.binary()) for c in BLOCKS}, **{c: pa.nulls(n, pa.list_(pa.int64())) for c in lists}, "told_low": pa.nulls(n, pa.list_(pa.float64()))})
        w, d = (np.concatenate([_unpack(x.as_py(), k) for x in table[col]]) for col, k in (("words", "u8"), ("docs", "u4")))
        sizes = [len(x.as_py()) // 4 for x in table["docs"]]
        c = np.concatenate([_unpack(x.as_py(), "u4" if len(x.as_py()) == 4 * n else "u8").astype(np.uint64) for x, n in zip(table["contexts"], sizes)])
        kept_words, kept_contexts, _, _, splits, shares = sent.value
        common = np.uint64(len(kept_contexts))  # codes from here on are places in the list of rare contexts
        named = c >= RARE
        rare_contexts, at = np.unique(c[named], return_inverse=True)
        c[named] = common + at.astype(np.uint64)
        rows = np.repeat(table["row"].to_numpy(), sizes) + (d >> 2)
        part = d & 3
        word, at = np.unique(w, return_inverse=True)
        key, at = np.unique(at.astype(np.uint64) << np.uint64(32) | c, return_inverse=True)
        order = np.argsort(at, kind="stable")
        word, context = word[(key >> np.uint64(32)).astype(np.int64)], (key & np.uint64((1 << 32) - 1)).astype(np.uint32)
        kept, deleted = (np.bincount(at, part == k, len(key)).astype(np.uint32) for k in (0, 1))
        own = context >= common
        known = np.where(own, 0, context)
        spread = ~own & (ways(splits, shares, word, known) > 1)
        low = weight * _counts_of(word, kept, kept_words) / max(float(kept_words[-1]), 1.0) + (1 - weight) / (types + 1)
        used = (deleted > 0) & (kept_contexts[known] > 0) & ~spread & ~own
        total = kept_contexts[known][used].astype(float)
        cells, of = np.unique(cell_of(frequency_class(total), kept[used] / total, low[used]), return_inverse=True)
        held = np.bincount(of, deleted[used].astype(float), len(cells))
        told = own & (deleted > 0)
        none = np.empty(0, np.int64)
        listed = [[cells, held, pair_key(word, context)[spread], kept[spread], deleted[spread], none, none, none, none], [none] * 5 + [rare_contexts, context[told] - common, kept[told], deleted[told]]]
        word_total = np.where(word >= RARE, _counts_of(word, kept.astype(float) + deleted, np.zeros(len(splits))), 0).astype(np.uint32)
        places_of = np.bincount(at).astype(np.uint32)
        rows = rows[order].astype(np.uint64)
        out = []
        for k, these in enumerate((~own, own)):
            if these.any():
                blocks = (word[these], context[these], kept[these], deleted[these], places_of[these], rows[np.repeat(these, places_of)], word_total[these])
                empty = {"row": pa.nulls(1, pa.int64()), "doc_id": pa.nulls(1, table.schema.field("doc_id").type), "held_out": pa.nulls(1, pa.bool_())}
                arrays = {c: pa.array([x.astype(np.int64)], pa.list_(pa.int64())) for c, x in zip(lists, listed[k])}
                out.append(pa.table({"bucket": pa.array([bucket], pa.int32()), **empty, **{c: pa.array([_pack(b)], pa.binary()) for c, b in zip(BLOCKS, blocks)}, **arrays, "told_low": pa.array([low[told] if k else low[:0]], pa.list_(pa.float64()))}))
        return pa.concat_tables(out)

    return pairs.groupBy("bucket").applyInArrow(count, f"bucket int, row long, doc_id {kind}, held_out boolean, {', '.join(f'{c} binary' for c in BLOCKS)}, {', '.join(f'{c} array<long>' for c in lists)}, told_low array<double>")


def pair_key(words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """A pair of a hot word and a context as one number."""
    return words << np.uint64(_CONTEXT) | contexts.astype(np.uint64)


def spread_totals(buckets: DataFrame) -> DataFrame:
    """(pair, kept, deleted) of the pairs that are spread over several buckets."""
    parts = buckets.filter("size(spread_pairs) > 0").select(F.explode(F.arrays_zip("spread_pairs", "spread_kept", "spread_deleted")).alias("x"))
    return parts.groupBy(F.col("x.spread_pairs").alias("pair")).agg(F.sum("x.spread_kept").alias("kept"), F.sum("x.spread_deleted").alias("deleted"))


def cells_of_totals(totals: DataFrame, sent, types: int, weight: float) -> DataFrame:
    """(cell, held) of spread pairs, as counted() has them of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_words, kept_contexts, *_ = sent.value
        for batch in batches:
            key, kept, deleted = (batch.column(c).to_numpy() for c in ("pair", "kept", "deleted"))
            total = kept_contexts[key & ((1 << _CONTEXT) - 1)].astype(float)
            used = (deleted > 0) & (total > 0)
            total = total[used]
            low = weight * kept_words[key[used] >> _CONTEXT] / max(float(kept_words[-1]), 1.0) + (1 - weight) / (types + 1)
            cells = cell_of(frequency_class(total), kept[used] / total, low)
            yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int64)), pa.array(deleted[used])], ["cell", "held"])

    return totals.mapInArrow(run, "cell long, held long")


def context_counts(buckets: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(bucket, context_kept, context_all): training counts of its rare contexts, in their order; 0 for words that
    the vocabulary (word, kept, deleted) lacks."""
    code = F.xxhash64("word").bitwiseOR(F.lit(-RARE).cast("long")).alias("code")
    words = vocabulary.select(code, "kept", "deleted").groupBy("code").agg(F.sum("kept").alias("kept"), F.sum("deleted").alias("deleted"))
    asked = buckets.filter("size(rare_contexts) > 0").select("bucket", F.posexplode("rare_contexts").alias("at", "code"))
    count = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    told = asked.join(words, "code", "left").select("bucket", F.struct("at", count(F.col("kept")).alias("kept"), count(F.col("kept") + F.col("deleted")).alias("n")).alias("x"))
    listed = told.groupBy("bucket").agg(F.sort_array(F.collect_list("x")).alias("x"))
    return listed.select("bucket", F.col("x.kept").alias("context_kept"), F.col("x.n").alias("context_all"))


def cells_of_contexts(buckets: DataFrame, counts: DataFrame) -> DataFrame:
    """(cell, held) of the held-out pairs of rare contexts, as counted() has them of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, kept, deleted, low = (batch.column(c).to_numpy() for c in ("total", "kept", "deleted", "low"))
            used = total > 0
            total = total[used].astype(float)
            cells = cell_of(frequency_class(total), kept[used] / total, low[used])
            yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int64)), pa.array(deleted[used])], ["cell", "held"])

    listed = buckets.filter("size(told_at) > 0").select("bucket", "told_at", "told_kept", "told_deleted", "told_low").join(counts.select("bucket", "context_kept"), "bucket")
    each = listed.select("context_kept", F.explode(F.arrays_zip("told_at", "told_kept", "told_deleted", "told_low")).alias("x"))
    total = F.get("context_kept", F.col("x.told_at").cast("int"))
    return each.select(total.alias("total"), F.col("x.told_kept").alias("kept"), F.col("x.told_deleted").alias("deleted"), F.col("x.told_low").alias("low")).mapInArrow(run, "cell long, held long")


def with_totals(buckets: DataFrame, totals: DataFrame, counts: DataFrame) -> DataFrame:
    """The blocks of all buckets, with `pairs` (sorted) and `pair_counts`: the whole counts of their spread pairs, and
    `context_all`: those of their rare contexts, from counts (as context_counts() gives them).

    A bucket lists no more pairs than it has places. Spark broadcasts the lists while they are small, and
    shuffles the buckets that have any beyond that.
    """
    own = buckets.filter("size(spread_pairs) > 0").select("bucket", F.explode("spread_pairs").alias("pair"))
    listed = own.join(totals, "pair").groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("pair", (F.col("kept") + F.col("deleted")).alias("n")))).alias("of"))
    listed = cut(listed.select("bucket", F.col("of.pair").alias("pairs"), F.col("of.n").alias("pair_counts")), "lm-spread")
    blocks = buckets.filter("words is not null")
    none = F.lit(None).cast("array<long>")
    whole = blocks.filter("size(spread_pairs) = 0 and size(rare_contexts) = 0").select(*BLOCKS, none.alias("pairs"), none.alias("pair_counts"), none.alias("context_all"))
    spread = blocks.filter("size(spread_pairs) > 0").join(listed, "bucket").select(*BLOCKS, "pairs", "pair_counts", none.alias("context_all"))
    rare = blocks.filter("size(rare_contexts) > 0").join(counts, "bucket").select(*BLOCKS, none.alias("pairs"), none.alias("pair_counts"), "context_all")
    return whole.unionByName(spread).unionByName(rare)


#: word_total: of rare words alone, over all blocks of the bucket.
BLOCKS = ("words", "contexts", "kept", "deleted", "spread", "rows", "word_total")


#: Documents of one row of partial sums, as a power of two.
_RANGE = 13
PARTIAL = ("rows", "n", "known", "base", "model")


def partial_sums(blocks: DataFrame, sent, tokens: int, types: int, weight: float, weights: np.ndarray) -> DataFrame:
    """(range, and arrays of row, n, known, base, model): what the buckets of a task (as with_totals() gives them) add to
    the documents of each range of rows."""

    def merged(parts: list[np.ndarray]) -> np.ndarray:
        rows, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return np.stack([rows, *(np.bincount(at, np.concatenate([p[k] for p in parts])) for k in range(1, 5))])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, all_words, all_contexts, *_ = sent.value
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            rows, *sums = merged(held)
            rows = rows.astype(np.uint64)
            of = rows >> np.uint64(_RANGE)
            starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            columns = (rows, *[x.astype(np.uint32) for x in sums[:2]], *[x.view(np.uint64) for x in sums[2:]])
            packed = [pa.array([_pack(c[i:j]) for i, j in zip(starts, np.append(starts[1:], len(rows)))], pa.binary()) for c in columns]
            return pa.RecordBatch.from_arrays([pa.array(of[starts].astype(np.int64)), *packed], ["range", *PARTIAL])

        for batch in batches:
            for *block, pairs, pair_counts, context_all in zip(*[batch.column(c) for c in (*BLOCKS, "pairs", "pair_counts", "context_all")]):
                word, context, kept, deleted, spread, rows, word_total = (_unpack(b.as_py(), k) for b, k in zip(block, ("u8", "u4", "u4", "u4", "u4", "u8", "u4")))
                both = kept.astype(float) + deleted
                if pairs.is_valid:  # words are sorted, and rare ones come last: so are the pairs
                    hot = int(np.searchsorted(word, np.uint64(RARE)))
                    at = np.searchsorted(pair_key(word[:hot], context[:hot]), pairs.values.to_numpy().astype(np.uint64))
                    both[at] = pair_counts.values.to_numpy()
                c = np.where(word >= RARE, word_total, all_words[np.where(word >= RARE, 0, word).astype(np.int64)]).astype(float)
                of_rare = context_all.values.to_numpy() if context_all.is_valid else all_contexts[:0]
                total = np.concatenate([all_contexts, of_rare])[context].astype(float)
                low = weight * c / max(tokens, 1) + (1 - weight) / (types + 1)
                own = np.where(total > 0, weights[frequency_class(total)], 0.0)
                model = np.log10(own * both / np.maximum(total, 1) + (1 - own) * low)
                base = np.log10((c + ALPHA) / (tokens + ALPHA * (types + 1)))
                row, at = np.unique(rows, return_inverse=True)
                add = lambda x: np.bincount(at, np.repeat(x, spread))
                held.append(np.stack([row.astype(float), np.bincount(at), add(c > 0), add(base), add(model)]))
            if sum(h.shape[1] for h in held) > SUMMED:
                held = [merged(held)]
                if held[0].shape[1] > SUMMED // 2:
                    yield out()
                    held = []
        if held:
            yield out()

    return blocks.mapInArrow(score, "range long, " + ", ".join(f"{c} binary" for c in PARTIAL))


def sums_by_document(documents: DataFrame, parts: DataFrame) -> DataFrame:
    """documents (row, doc_id, held_out) with the sums of all their parts."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    none = lambda df, other: df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(other.schema[c].dataType).alias(c) for c in ("range", "row", "doc_id", "held_out", *PARTIAL)])
    ranged = documents.withColumn("range", F.shiftright("row", _RANGE))

    def add(table: pa.Table) -> pa.Table:
        own = table.filter(pa.compute.is_valid(table["row"]))
        some = table.filter(pa.compute.is_valid(table["rows"]))
        rows, n, known, base, model = (np.concatenate([_unpack(x.as_py(), k) for x in some[c]]) for c, k in zip(PARTIAL, ("u8", "u4", "u4", "u8", "u8")))
        order = np.argsort(own["row"].to_numpy())
        at = order[np.searchsorted(own["row"].to_numpy()[order], rows.astype(np.int64))]
        total = lambda x, kind: np.bincount(at, x, own.num_rows).astype(kind)
        return pa.table({"doc_id": own["doc_id"], "held_out": own["held_out"], "n": total(n, np.int64), "known": total(known, np.int64), "base": total(base.view(np.float64), float), "model": total(model.view(np.float64), float)})

    both = none(ranged, parts).unionByName(none(parts, documents))
    return both.groupBy("range").applyInArrow(add, f"doc_id {kind}, held_out boolean, n long, known long, base double, model double")


def scored(docs: DataFrame, hot_words: int = HOT, bucket: int = BUCKET, every_context: bool = False) -> DataFrame:
    """Counts and log10 probabilities of every row of docs (doc_id, text). every_context: words that aren't hot are
    contexts of their own, too, so that the scores don't depend on hot_words."""
    docs = docs.select("doc_id", "text", remainder(F.col("doc_id"), FOLDS).alias("fold"))
    vocabulary = cut(word_counts(docs), "lm-words")
    c = F.col("kept") + F.col("deleted")
    zero = lambda x: F.coalesce(x, F.lit(0))
    of = vocabulary.agg(zero(F.sum("kept")).alias("kept"), zero(F.sum("deleted")).alias("deleted"), F.count_if(c > 0).alias("types")).first()
    tokens, types = of["kept"] + of["deleted"], of["types"]
    hot = vocabulary.filter(c > 0).filter("word is not null").orderBy(c.desc(), "word").limit(hot_words).toArrow()  # a fixed number of rows
    ends = vocabulary.filter("word is null").agg(zero(F.sum("kept")).alias("kept"), zero(F.sum("deleted")).alias("deleted")).first()
    # the weight of the words' own frequencies against equal shares: there is one context, the empty one
    step = F.floor(F.log10(F.col("kept") / F.lit(float(max(of["kept"], 1))) * F.lit(float(types + 1))) * 100 + 0.5)
    steps = vocabulary.filter("deleted > 0").groupBy(F.when(F.col("kept") > 0, step + 100 * DECADES + 1).otherwise(0).cast("long").alias("cell")).agg(F.sum("deleted").alias("n")).toPandas()
    weight = float(learn_from_cells(steps["cell"].to_numpy(), steps["n"].to_numpy())[0]) if of["kept"] else 0.0
    words = [np.concatenate(([ends[k]], hot[k].to_numpy())).astype(np.int64) for k in ("kept", "deleted")]
    # as contexts: the start, the hot words, all others; and last of the words' counts the sum of all
    contexts = [np.append(w, of[k] - w.sum()) for w, k in zip(words, ("kept", "deleted"))]
    layout = Layout(words[0] + words[1], int(contexts[0][-1] + contexts[1][-1]), bucket)
    known = (np.append(words[0], of["kept"]), contexts[0], np.append(words[0] + words[1], tokens), contexts[0] + contexts[1], layout.splits, layout.shares)
    sent = docs.sparkSession.sparkContext.broadcast(known)
    buckets = cut(counted(dealt(docs, hot["word"].to_pylist(), layout, every_context), sent, types, weight), "lm-pairs", 4)
    totals = cut(spread_totals(buckets), "lm-totals")
    told = buckets.select(F.explode(F.arrays_zip("cells", "held")).alias("x")).select(F.col("x.cells").alias("cell"), "x.held")
    # no word above the last hot one is rare
    rarest = int(words[0][-1] + words[1][-1]) if hot.num_rows else tokens
    counts = cut(context_counts(buckets, vocabulary.filter(c > 0).filter("word is not null").filter(c <= rarest)), "lm-contexts")
    forget(vocabulary)
    told = told.unionByName(cells_of_totals(totals, sent, types, weight)).unionByName(cells_of_contexts(buckets, counts)).groupBy("cell").agg(F.sum("held").alias("n")).toPandas()  # classes x ratios
    weights = learn_from_cells(told["cell"].to_numpy(), told["n"].to_numpy()) if len(told) else np.full(CLASSES, 0.5)
    blocks = with_totals(buckets, totals, counts)
    forget(totals)
    parts = partial_sums(blocks, sent, tokens, types, weight, weights)
    told = sums_by_document(buckets.filter("words is null").select("row", "doc_id", "held_out"), parts)
    return told.select("doc_id", "held_out", F.col("n").alias("n_tokens"), F.col("known").alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), F.col("model").alias("score"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(read(spark, sf_dir, "documents"), every_context=True)
