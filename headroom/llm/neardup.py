"""The pipeline's near-dedup: candidates by SimHash tries and min-hash bands, every link verified on the five-word shingles.

Documents with the same set of shingles are one from the start. Of the rest, those meet in a bucket whose
fingerprints are linked by the trie self-join (see simhash), or whose least hashes agree in a band:
SimHash alone finds about half of the pairs of a Jaccard similarity of 0.8, 36 bands of 9 least hashes
find 0.994 of them. A pair of a bucket is compared in full unless four bits of each of 320 least hashes
differ more often than those of 0.9987 of the pairs of that similarity do. It links if its sets of
shingles have the similarity; nothing links unverified.

No bucket is taken apart into all its pairs at once. In a round some of its members, its centres, are
compared with those that are not yet in one group with them; then links are folded into groups, the
centres leave, and a bucket whose other members are all in one group is done. A bucket of near copies so
costs a comparison a member; in one of texts that only collide, every pair is compared in the end. No
pair of a bucket stays unseen, at any size of the bucket.

Defined cases: null text is the empty text; texts without words are one group; texts of fewer than five
words are one shingle; of equal doc_ids the first row stays, null doc_ids come last; repeated rows are
copies; very long texts are hashed whole, in slices; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import DOCUMENT_COLUMNS, bloom_of, cut, forget, may_hold, salted_join, signed, with_row_key
from .simhash import BUDGET, HASH_SEED, connected, majority, near_links, shingles

SHINGLE, SIMILARITY = 5, 0.8
#: At a similarity of 0.8 a band of 9 least hashes agrees with probability 0.134; one of 36 does with 0.994.
BANDS, ROWS = 36, 9
#: Centres of a bucket in the rounds; the last goes on.
CENTRES = (1, 16, 128, 1024)
#: Bits of the Bloom filter of the documents whose texts a round compares; a full filter only lets more texts pass.
MOST_BITS = 1 << 27
#: Words of 64 least hashes of which a sketch keeps so many bits each.
WORDS, PLANES = 5, 4

_factors = np.random.default_rng(HASH_SEED).integers(0, 1 << 32, (2, BANDS * ROWS, 1), np.uint32)
_TIMES, _PLUS = _factors[0] | 1, _factors[1]


def hashes_of(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of the shingles of a text, repeats included."""
    from xxhash import xxh64_intdigest as digest

    return np.array([digest(p, HASH_SEED) for p in shingles(text, shingle)], "<u8")


def least_hashes(distinct: np.ndarray) -> np.ndarray:
    """The least value of each hash function over the distinct hashes of a text."""
    h = (distinct >> np.uint64(32)).astype(np.uint32)
    out = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(h), 512):  # a slice at a time stays in the cache
        np.minimum(out, (_TIMES * h[k : k + 512] + _PLUS).min(axis=1), out=out)
    return out


def planes_of(least: np.ndarray) -> np.ndarray:
    """The low bits of the least hashes: a word of 64 of them and then the next bit of the same 64, as longs."""
    low = least[: 64 * WORDS].reshape(WORDS, 1, 64) >> np.arange(PLANES, dtype=np.uint32)[:, None] & 1
    return np.packbits(low.astype(np.uint8), axis=2, bitorder="little").view("<i8").ravel()


def differing(a: Column, b: Column) -> Column:
    """How many of the least hashes of two sketches differ in the bits that these keep."""
    at = lambda c, k: F.get(c, F.lit(k))
    words = [reduce(Column.bitwiseOR, [at(a, w * PLANES + p).bitwiseXOR(at(b, w * PLANES + p)) for p in range(PLANES)]) for w in range(WORDS)]
    return reduce(Column.__add__, map(F.bit_count, words))


def most_differing(similarity: float) -> int:
    """Three deviations above what a pair of that similarity is expected to differ in."""
    each = (1 - similarity) * (1 - 0.5**PLANES)
    return int(64 * WORDS * each + 3 * (64 * WORDS * each * (1 - each)) ** 0.5)


def sketch(text: str | None) -> tuple[int, int, int, int, list[int], list[int]]:
    """(two words that tell the set of shingles, its size, fingerprint, keys of the bands, bits of the least hashes)."""
    from xxhash import xxh3_64_intdigest as short
    from xxhash import xxh3_128_intdigest as digest

    every = hashes_of(text)
    distinct = np.unique(every)
    if not len(distinct):
        return 0, 0, 0, 0, [], []
    whole, least = digest(distinct.tobytes()), least_hashes(distinct)
    fingerprint = int(majority(every.reshape(-1, 1))[0])
    return signed(whole >> 64), signed(whole & (1 << 64) - 1), len(distinct), signed(fingerprint), [signed(short(row.tobytes(), seed=k)) for k, row in enumerate(least.reshape(BANDS, ROWS))], planes_of(least).tolist()


def _sketched(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = list(zip(*[sketch(t.as_py()) for t in batch.column("text")])) or [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("__row"), batch.column("doc_id"), *[pa.array(m, k) for m, k in zip(made, kinds)]], names)

    names = ["__row", "doc_id", "one", "two", "n", "fp", "bands", "planes"]
    return docs.select("__row", F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "__row long, doc_id long, one long, two long, n long, fp long, bands array<long>, planes array<long>")


def _alike(similarity: float):
    """Column function of two texts: whether their shingles have the similarity. The second text is often the one before."""

    @F.pandas_udf("boolean")
    def of(a: pd.Series, b: pd.Series) -> pd.Series:
        known, kept = None, None
        out = []
        for x, y in zip(a, b):
            if kept is None or y != known:
                known, kept = y, np.unique(hashes_of(y))
            own = np.unique(hashes_of(x))
            both = len(np.intersect1d(own, kept, assume_unique=True))
            out.append(both >= similarity * (len(own) + len(kept) - both))
        return pd.Series(out, dtype="bool")

    return of


def may_be_among(ids: DataFrame, name: str) -> Column:
    """Whether column `name` may be one of those of ids, by a Bloom filter: true of each of these, and of few others."""
    sent = ids.sparkSession.sparkContext.broadcast(bloom_of(ids.select(F.xxhash64(name).alias("k")), MOST_BITS))

    @F.pandas_udf("boolean")
    def held(keys: pd.Series) -> pd.Series:
        return pd.Series(may_hold(sent.value, keys.to_numpy()))

    return held(F.xxhash64(name))


def texts_of(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The texts (id, text) of the documents of pairs (a, b), and few others: the rest is dropped before texts are shuffled."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    return texts.filter(may_be_among(ids, "id"))


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts (id, text) are alike. b may be the same in very many pairs."""
    texts = texts_of(pairs, texts)
    second = salted_join(pairs, texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b", "a")
    both = second.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    return both.sortWithinPartitions("b").filter(_alike(similarity)("text_a", "text_b")).select("a", "b")


def buckets_of(reps: DataFrame) -> DataFrame:
    """(bucket, id, n) of every bucket of the distinct documents (id, n, fp, bands): bands, and trees of linked fingerprints."""
    banded = reps.select(F.explode("bands").alias("bucket"), "id", "n")
    trees = connected(near_links(reps.select("fp").distinct(), BUDGET))
    tree = reps.select("id", "n", "fp").join(trees, F.col("fp") == F.col("v"), "left").select(F.xxhash64(F.lit("tree"), F.coalesce("root", "fp")).alias("bucket"), "id", "n")
    return banded.unionByName(tree)


def groups(reps: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(v, root) of every distinct document (id, n, fp, bands, planes) that is linked to another one and isn't its group's root."""
    every = cut(buckets_of(reps), "near-buckets")
    shared = every.groupBy("bucket").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    shared = cut(shared, "near-shared")
    some = salted_join(every, shared.select("bucket"), "bucket", "id", counts=shared).withColumn("root", F.col("id"))
    members = cut(some.join(reps.select("id", "planes"), "id"), "near-members")
    forget(every)
    forget(shared)
    links: list[DataFrame] = []
    tested: list[DataFrame] = []
    roots = None
    for k in range(1 << 30):
        open_ = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("__n"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi")
        open_ = cut(open_.select("bucket", "__n"), "near-open")
        rest = cut(salted_join(members, open_.select("bucket"), "bucket", "id", counts=open_), "near-rest")
        forget(members)
        order = Window.partitionBy("bucket").orderBy("id" if not k else F.xxhash64("id", F.lit(k)), "id")
        centres = rest.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= CENTRES[min(k, len(CENTRES) - 1)])
        centres = cut(centres.groupBy("bucket").agg(F.collect_list(F.struct("id", "n", "root", "planes")).alias("centres")), "near-centres")
        if not centres.limit(1).count():
            break
        # no pair is more alike than its sizes; of two centres each is the other's, once
        near = lambda c: differing(F.col("planes"), c.planes) <= most_differing(similarity)
        fits = lambda c: (c.root != F.col("root")) & (F.least("n", c.n) >= similarity * F.greatest("n", c.n)) & (~F.col("centre") | (F.col("id") > c.id)) & near(c)
        met = salted_join(rest, centres, "bucket", "id", counts=open_).withColumn("centre", F.array_contains(F.transform("centres", lambda c: c.id), F.col("id")))
        one = met.select("id", F.explode(F.transform(F.filter("centres", fits), lambda c: c.id)).alias("c"))
        pairs = one.select(F.greatest("id", "c").alias("a"), F.least("id", "c").alias("b")).distinct()
        if tested:
            pairs = pairs.join(reduce(DataFrame.unionByName, tested), ["a", "b"], "left_anti")
        pairs = cut(pairs, "near-pairs")
        tested.append(pairs)
        links.append(cut(verified(pairs, texts, similarity), "near-links"))
        if roots is None or links[-1].limit(1).count():
            if roots is not None:
                forget(roots)
            roots = connected(reduce(DataFrame.unionByName, links))
        gone = centres.select("bucket", F.explode("centres.id").alias("id"))
        left = rest.join(gone, ["bucket", "id"], "left_anti").drop("root").join(roots, F.col("id") == F.col("v"), "left")
        members = cut(left.withColumn("root", F.coalesce("root", "id")).drop("v"), "near-members")
        for table in (rest, centres, open_):
            forget(table)
    for table in (rest, centres, open_, *links, *tested):
        forget(table)
    return roots if roots is not None else reps.sparkSession.createDataFrame([], "v long, root long")


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """docs without all but one document of each group of near-duplicates: the one of the smallest doc_id, and of the smallest row among equals."""
    keyed = cut(with_row_key(docs, "__row"), "dedup-docs")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row")).alias("first")
    reps = _sketched(keyed).groupBy("one", "two", "n").agg(first, F.first("fp").alias("fp"), F.first("bands").alias("bands"), F.first("planes").alias("planes"))
    reps = cut(reps.select(F.col("first.__row").alias("id"), "first", "n", "fp", "bands", "planes"), "dedup-first")
    roots = groups(reps, keyed.select(F.col("__row").alias("id"), "text"), similarity)
    kept = reps.join(roots, reps.id == roots.v, "left").groupBy(F.coalesce("root", "id")).agg(F.min("first").alias("first")).select(F.col("first.__row").alias("__row"))
    kept = cut(kept, "dedup-kept")
    forget(reps)
    gone = cut(keyed.select("__row").join(kept, "__row", "left_anti"), "dedup-gone")
    forget(kept)
    # only texts that may go are shuffled
    maybe = may_be_among(gone, "__row")
    return keyed.filter(~maybe).unionByName(keyed.filter(maybe).join(gone, "__row", "left_anti")).select(*docs.columns)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near-duplicates by five-word shingles stays."""
    return drop_near_duplicates(docs.select(*DOCUMENT_COLUMNS))
