"""Shards of near-equal bytes by a k-d tree over document metadata.

A node that is to give k shards is split along its widest dimension at the weighted quantile that
leaves floor(k/2) of its k shares on the left, until every leaf is one shard. Medians are found
without sorting: all nodes of a level sum their bytes by ranges of the coordinate, the range in which
the quantile falls is divided again, and so on until what is left in it doesn't matter. Only one row
a node goes to the driver. The tree then is a row-local expression.

The dimensions depend on the text alone: its length (logarithm of the bytes), its bytes a character,
and a content hash that also breaks ties, so equal texts have equal coordinates and go to one shard.
Only a group of equal texts that alone would weigh more than GROUP_SHARE of a shard is spread, by a
hash of its rows; near-equal sizes are the law that holds.

Defined cases: null text has no bytes (size 16); null doc_ids and repeated rows are placed like
others; more shards than rows leave shards empty; an empty table gives an empty result; other
columns of the input are ignored. The tree is an expression on the driver: it is meant for up to
some thousand shards at once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import cut, number_within, read, with_row_key

SHARDS = 40
ROW_BYTES = 16
#: A group of equal texts up to this share of a shard stays together.
GROUP_SHARE = 0.02
#: Ranges that one pass divides a coordinate into.
RANGES = 1024
#: The part of a shard that the last range may hold undivided.
TOLERANCE = 0.0005
DIMENSIONS = ("c_bytes", "c_width", "c_hash")


@dataclass
class Node:
    shards: int
    first: int
    dimension: str = ""
    split: int = 0
    children: list["Node"] = field(default_factory=list)

    def expression(self, of) -> Column:
        """of(leaf) at the leaves; a row goes left where its coordinate is under the split."""
        if not self.children:
            return of(self)
        return F.when(F.col(self.dimension) < F.lit(self.split).cast("long"), self.children[0].expression(of)).otherwise(self.children[1].expression(of))


def coordinates(docs: DataFrame, shards: int) -> DataFrame:
    """Narrow rows: __row, doc_id, size, text_crc32 and the coordinates, 30 bits of a dimension before 32 of the tie-break."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.octet_length(text).cast("long") + ROW_BYTES
    narrow = cut(with_row_key(docs.select("doc_id", "text"), "__row").select("__row", "doc_id", size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.length(text).alias("chars"), F.xxhash64(text).alias("content")), "shard-rows")
    total = narrow.agg(F.sum("size")).first()[0] or 0
    # at most 1 / GROUP_SHARE groups a shard can be as heavy as this: a proven bound for the broadcast
    heavy = narrow.groupBy("content").agg(F.sum("size").alias("g"), F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) & (F.col("g") > GROUP_SHARE * total / shards)).select("content", F.lit(True).alias("heavy"))
    low = F.when(F.col("heavy"), F.xxhash64("content", "doc_id", "__row")).otherwise(F.col("content"))
    rows = narrow.join(F.broadcast(heavy), "content", "left").withColumn("__low", low)
    scaled = lambda share: F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)) * ((1 << 30) - 1)).cast("long")
    dims = {
        "c_bytes": scaled(F.log2("size") / 48),
        "c_width": scaled(((F.col("size") - ROW_BYTES) / F.greatest("chars", F.lit(1)) - 1) / 3),
        "c_hash": F.shiftrightunsigned("__low", 34),
    }
    tie = F.col("__low").bitwiseAND(F.lit((1 << 32) - 1))
    return cut(rows.withColumns({n: c * (1 << 32) + tie for n, c in dims.items()}).select("__row", "doc_id", "size", "text_crc32", *DIMENSIONS), "shard-coordinates")


def grow(rows: DataFrame, shards: int) -> Node:
    """The k-d tree for rows (size and coordinates), all nodes of a level at a time."""
    root = Node(shards, 0)
    level, whole, spans = [root], None, {}
    while level := [n for n in level if n.shards > 1]:
        placed = rows.withColumn("node", root.expression(lambda n: F.lit(n.first)))
        stats = {r["node"]: r for r in placed.groupBy("node").agg(F.sum("size").alias("total"), *[f(c).alias(f"{f.__name__}_{c}") for c in DIMENSIONS for f in (F.min, F.max)]).collect()}
        if whole is None:
            whole = sum(r["total"] for r in stats.values())
            spans = {c: max(1, (max(r[f"max_{c}"] for r in stats.values()) - min(r[f"min_{c}"] for r in stats.values()))) for c in DIMENSIONS} if stats else {}
        search = []
        for n in level:
            n.children = []
            if r := stats.get(n.first):
                n.dimension = max(DIMENSIONS, key=lambda c: (r[f"max_{c}"] - r[f"min_{c}"]) / spans[c])
                search.append([n, r[f"min_{n.dimension}"], r[f"max_{n.dimension}"] + 1, r["total"] * (n.shards // 2) / n.shards])
            else:
                n.dimension = DIMENSIONS[0]
        _quantiles(placed, search, TOLERANCE * whole / shards)
        below = []
        for n in level:
            half = n.shards // 2
            n.children = [Node(half, n.first), Node(n.shards - half, n.first + half)]
            below += n.children
        level = below
    return root


def _quantiles(placed: DataFrame, search: list[list], tolerance: float) -> None:
    """Set the split of each [node, low, high, wanted bytes under the split]: divide the range around it again and again."""
    open_ = search
    while open_:
        step = {n.first: max(1, -(-(high - low) // RANGES)) for n, low, high, _ in open_}
        cell = F.lit(None).cast("long")
        for n, low, high, _ in open_:
            c = F.col(n.dimension)
            inside = (F.col("node") == n.first) & (c >= F.lit(low).cast("long")) & (c < F.lit(high).cast("long"))
            cell = F.when(inside, F.floor((c - F.lit(low).cast("long")) / F.lit(step[n.first]).cast("long")).cast("long") if step[n.first] < 1 << 20 else F.expr(f"({n.dimension} - {low}L) div {step[n.first]}L")).otherwise(cell)
        sums = placed.withColumn("cell", cell).filter("cell is not null").groupBy("node", "cell").agg(F.sum("size").alias("s"))
        running = sums.withColumn("upto", F.sum("s").over(Window.partitionBy("node").orderBy("cell")))
        want = F.lit(None).cast("double")
        for n, _, _, w in open_:
            want = F.when(F.col("node") == n.first, F.lit(float(w))).otherwise(want)
        last = F.min(F.when(F.col("upto") >= want, F.struct("cell", "s", "upto")))
        found = {r["node"]: r["p"] for r in running.groupBy("node").agg(last.alias("p")).collect()}
        again = []
        for n, low, high, wanted in open_:
            p, width = found.get(n.first), step[n.first]
            if p is None:
                n.split = high
                continue
            start, end = low + p["cell"] * width, min(high, low + (p["cell"] + 1) * width)
            before = p["upto"] - p["s"]
            if p["s"] <= tolerance or end - start <= 1:
                n.split = end if p["upto"] - wanted <= wanted - before else start
            else:
                again.append([n, start, end, wanted - before])
        open_ = again


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of all rows of docs (doc_id, text)."""
    rows = coordinates(docs, shards)
    tree = grow(rows, shards)
    placed = rows.select("__row", "doc_id", "size", "text_crc32", tree.expression(lambda n: F.lit(n.first)).cast("int").alias("shard"))
    numbered = number_within(placed, ["shard"], "__row", "slot")
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_kd_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(read(spark, sf_dir, "documents"))
