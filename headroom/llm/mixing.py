"""Mix sources to target weights by hash-threshold histograms. DataFrame and SQL functions only.

Every source gets a token target; the whole-number part of target / size is taken of every row, and
of the rest the rows whose hash lies below the threshold at which the running sum of sizes reaches
the rest of the budget. The threshold is found without sorting: sum the sizes by source and leading
hash bits, find the bucket in which the budget falls, refine only that bucket by the next bits, and
in the last step by the hash itself. Both choices, whole copies and threshold, then are a row-local
filter. The result depends on the rows alone, not on their order or partitions.

Defined cases: null text has size 0; null sources form one source, the last; null doc_ids are hashed
like values; repeated rows are told apart by a number within their hash, so that a source made of
copies still meets its target; sources without any words have target 0; an empty table gives an
empty result; very long texts are one row of their size; other columns of the input are ignored. The
per-source table holds one row a source; it is broadcast only up to BROADCAST_SOURCES rows, and its
running sums go over ranges of it, never over one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BLANKS, DOCUMENT_COLUMNS, cut, number_within, read, with_row_key

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: Hash bits that each histogram adds.
BITS = 12
BROADCAST_SOURCES = 100_000
#: Ranges that running sums over the sources are dealt to.
RANGES = 16


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")).cast("long")


def source_key(source: Column) -> Column:
    """A key that null sources have too."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def with_running_sums(rows: DataFrame, order: list[Column], sums: list[str]) -> tuple[DataFrame, dict[str, float]]:
    """rows in an order, with `place` from 1 and for each column c of sums before_c, the sum over all rows before; and the sums of all rows.

    Each range of the order is one task; what lies before a range follows from one row of sums a range.
    """
    placed = cut(rows.repartitionByRange(RANGES, *order).withColumn("__part", F.spark_partition_id()), "mix-ordered")
    per = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("place"), *[F.sum(c).alias(c) for c in sums]).orderBy("__part").collect()  # one row a range
    names, running = ["place", *sums], {"place": 0, **dict.fromkeys(sums, 0)}
    starts: dict[str, list] = {c: [] for c in names}
    for r in per:
        for c in names:
            starts[c] += [F.lit(r["__part"]), F.lit(running[c])]
            running[c] += r[c]
    if not per:
        return placed.drop("__part").withColumns({"place": F.lit(0), **{f"before_{c}": F.lit(0) for c in sums}}), running
    start = lambda c: F.element_at(F.create_map(*starts[c]), F.col("__part"))
    inner = Window.partitionBy("__part").orderBy(*order)
    before = inner.rowsBetween(Window.unboundedPreceding, -1)
    own = {f"before_{c}": F.coalesce(F.sum(c).over(before), F.lit(0)) + start(c) for c in sums}
    return placed.withColumns({"place": F.row_number().over(inner) + start("place"), **own}).drop("__part"), running


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(key, source_size, target) from rows (key, source, size): shares by weight, none above `most` times its size.

    Sharing the excess again until none is above ends at the level for which the sum of
    min(most * size, level * weight) is the total; sources reach their ceiling in the order of
    size / weight, so the level follows from running sums over the per-source table.
    """
    per = sizes.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    named, _ = with_running_sums(per, [F.col("source").asc_nulls_last()], [])
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    listed = named.withColumn("weight", weight.cast("double")).drop("place").withColumn("ratio", F.col("source_size") / F.col("weight"))
    leveled, every = with_running_sums(listed, [F.col("ratio").asc(), F.col("key").asc()], ["source_size", "weight"])
    left = F.lit(every["source_size"]) - most * F.col("before_source_size")
    final = leveled.withColumn("level", left / (F.lit(float(every["weight"])) - F.col("before_weight")))
    # the first source whose ceiling isn't below its level fixes the level of all from there on
    free = F.when(most * F.col("source_size") >= F.col("level") * F.col("weight"), F.struct("place", "level"))
    level = final.agg(F.min(free).alias("free")).first()["free"]
    ceiling = most * F.col("source_size").cast("double")
    return final.select("key", "source_size", F.least(ceiling, F.lit(level["level"] if level else 0.0) * F.col("weight")).alias("target"))


def distinct_hash(rows: DataFrame) -> DataFrame:
    """rows with column h; rows that share a hash (copies) get another one from their number among them."""
    doubled = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    copies = cut(rows.join(doubled, "h", "left_semi").select(*rows.columns), "mix-copies")
    numbered = number_within(copies, ["h"], "__row", "__n").withColumn("h", F.when(F.col("__n") == 0, F.col("h")).otherwise(F.xxhash64("h", "__n")))
    return rows.join(doubled, "h", "left_anti").select(*rows.columns).unionByName(numbered.select(*rows.columns))


def _ordered(h: Column) -> Column:
    """Unsigned order as signed order."""
    return h.bitwiseXOR(F.lit(-(1 << 63)).cast("long"))


def _small(per_source: DataFrame) -> DataFrame:
    """One row a source: broadcast behind a check of its size, else joined like any table."""
    return F.broadcast(per_source) if per_source.count() <= BROADCAST_SOURCES else per_source


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(key, prefix, last): of each source (key, rest), the hashes k that hold `rest` words as nearly as whole rows can.

    No prefix: all rows. Else rows up to `last`, or none of the boundary bucket `prefix` if that is null.
    """
    cells = rows.select("key", "size", _ordered(F.col("h")).alias("k"))
    found = budgets.select("key", "rest", F.lit(None).cast("long").alias("prefix"))
    for level in (1, 2):
        inside = cells
        if level > 1:
            inside = cells.withColumn("prefix", F.shiftright("k", 64 - BITS * (level - 1))).join(_small(found.select("key", "prefix")), ["key", "prefix"], "left_semi")
        sums = inside.groupBy("key", F.shiftright("k", 64 - BITS * level).alias("b")).agg(F.sum("size").alias("s"))
        running = sums.withColumn("upto", F.sum("s").over(Window.partitionBy("key").orderBy("b")))
        # the budget falls in the first bucket whose running sum passes it
        passed = running.join(found.select("key", "rest"), "key").filter("upto > rest").groupBy("key").agg(F.min(F.struct("b", (F.col("upto") - F.col("s")).alias("before"))).alias("p"))
        found = cut(found.drop("prefix").join(passed, "key", "left").select("key", (F.col("rest") - F.coalesce("p.before", F.lit(0))).alias("rest"), F.col("p.b").alias("prefix")), "mix-level")
    inside = cells.withColumn("prefix", F.shiftright("k", 64 - 2 * BITS)).join(_small(found.select("key", "prefix")), ["key", "prefix"], "left_semi")
    running = inside.groupBy("key", "k").agg(F.sum("size").alias("s")).withColumn("upto", F.sum("s").over(Window.partitionBy("key").orderBy("k")))
    # the row at the boundary is taken only if that comes nearer
    nearer = F.col("upto") - F.col("rest") <= F.col("rest") - (F.col("upto") - F.col("s"))
    last = running.join(found.select("key", "rest"), "key").filter((F.col("upto") <= F.col("rest")) | nearer).groupBy("key").agg(F.max("k").alias("last"))
    return found.join(last, "key", "left").select("key", "prefix", "last")


def mix(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """rows (__row, key, source, size, h) with source_size, target and copies. rows should be cut."""
    targets = source_targets(rows, weights, most)
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most).cast("long"))).otherwise(0).cast("long")
    budgets = cut(targets.withColumn("whole", whole).withColumn("rest", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")), "mix-budgets")
    told = cut(distinct_hash(rows), "mix-rows")
    per = cut(budgets.join(thresholds(told, budgets), "key", "left"), "mix-bounds")
    k = _ordered(F.col("h"))
    below = F.when(F.col("prefix").isNull(), True).when(F.col("last").isNotNull(), k <= F.col("last")).otherwise(k < F.shiftleft("prefix", 64 - 2 * BITS))
    more = ((F.col("rest") > 0) & below).cast("long")
    return told.join(_small(per), "key").withColumn("copies", F.least(F.col("whole") + more, F.lit(most).cast("long")))


def _rows(docs: DataFrame) -> DataFrame:
    """The narrow rows that are mixed."""
    h = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.xxhash64("text"), "source")
    return docs.select("__row", "doc_id", "source", source_key(F.col("source")).alias("key"), word_count(F.col("text")).alias("size"), h.alias("h"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row of docs (doc_id, text, source)."""
    rows = cut(_rows(with_row_key(docs.select("doc_id", "text", "source"), "__row")), "mix")
    return mix(rows, weights).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def repeat_to_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """docs as the mix takes them: rows it leaves out go, rows that it takes several times are repeated."""
    keyed = cut(with_row_key(docs, "__row"), "mix-docs")
    rows = cut(_rows(keyed), "mix")
    taken = mix(rows, weights).filter("copies > 0").select("__row", "copies")
    return keyed.join(taken, "__row").withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*docs.columns)


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(read(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: sources are mixed to their targets."""
    return repeat_to_mix(docs.select(*DOCUMENT_COLUMNS))
