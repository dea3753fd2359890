"""The prefix trie of conversations, by collapsing whole sequences.

Conversations that are rebuilt to the same turns are one weighted sequence, with the list of the
conversations that end there; only one of each sequence is taken apart into prefixes. A sequence that
is a proper prefix of another one goes by an anti-join, and what stays are the leaves. Nodes are the
distinct prefixes, and their figures are sums of the weighted prefixes.

A prefix is known by its depth and two sums of hashes of (place, turn) over its turns, so that the
prefixes of one long conversation are running sums in blocks of places, of which no task needs all.
A node's smallest member and depth are unique, so each node is counted once on the sequence of that
member; sums over subtrees are sums of suffixes, and no pair of ancestor and descendant is made.

Defined cases: null roles and texts are empty; rows without a conv_id take no part; equal turns (and
null ones, which come first) are ordered by a hash of role and text, so repeated rows stay, one after
the other, and runs agree; very long texts count by their hash and their length; a conversation of
very many turns is dealt out in blocks; one sequence of very many conversations is dealt out by blocks
of 4,096 ids, and only its joined ids meet, in order, to be digested; an empty table has no node; other
columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, read, salted_join, text_crc32, with_row_key

#: Conversations of one hundred share the first turns of their first, as many as a hash modulo six says.
FAMILY, HEADS = 100, 6
#: Places, or ids, of one block.
BLOCK = 4096
ROOT = "root"


def _block(c: Column) -> Column:
    return F.floor(c / F.lit(BLOCK)).cast("long")


def _node(depth: Column, one: Column, two: Column) -> Column:
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in (depth, one, two)]).cast("binary"))


def in_order(rows: DataFrame, key: str, order: list[Column], out: str) -> DataFrame:
    """rows with gapless places from 0 in each key. A key may be spread over several ranges of the order; at most one key
    of each range began in an earlier one, so that what is broadcast has a row a range at most."""
    placed = cut(rows.repartitionByRange(F.col(key), *order).withColumn("__part", F.spark_partition_id()), "turns")
    before = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(key, "__part").agg(F.count(F.lit(1)).alias("__n")).withColumn("__start", F.sum("__n").over(before)).filter("__start > 0").drop("__n")
    ranked = placed.withColumn("__rank", F.row_number().over(Window.partitionBy(key, "__part").orderBy(*order)) - 1)
    return ranked.join(F.broadcast(starts), [key, "__part"], "left").withColumn(out, F.col("__rank") + F.coalesce("__start", F.lit(0))).drop("__part", "__rank", "__start")


def running_sums(rows: DataFrame, key: str, place: str, sums: dict[str, Column]) -> DataFrame:
    """rows with the sums over all rows of a key up to a row's place, in blocks of places."""
    blocked = rows.withColumns({"__block": _block(F.col(place)), **sums})
    inner = Window.partitionBy(key, "__block").orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    per = blocked.groupBy(key, "__block").agg(*[F.sum(c).alias(f"__{c}") for c in sums])
    starts = per.select(key, "__block", *[F.sum(f"__{c}").over(before).alias(f"__{c}") for c in sums]).filter("__block > 0")
    own = blocked.withColumns({c: F.sum(c).over(inner) for c in sums})
    joined = own.join(starts, [key, "__block"], "left")
    return joined.withColumns({c: F.col(c) + F.coalesce(F.col(f"__{c}"), F.lit(0)) for c in sums}).drop("__block", *[f"__{c}" for c in sums])


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, n: turns) of every rebuilt conversation, and its turns (conv_id, n, depth from 1, one, two: hashes, size: code points)."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit("|"), role, text).cast("binary"), 256)
    half = lambda start: F.conv(F.substring(digest, start, 15), 16, 10).cast("long")
    turns = with_row_key(conversations.filter("conv_id is not null"), "__row").select("conv_id", "turn", "__row", half(1).alias("one"), half(16).alias("two"), F.length(text).cast("long").alias("size"))
    placed = cut(in_order(turns, "conv_id", [F.col("turn").asc_nulls_first(), F.col("one"), F.col("two"), F.col("__row")], "place").drop("turn", "__row"), "turns-placed")
    counts = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    taken = F.pmod(text_crc32(F.col("conv_id")), F.lit(HEADS))
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    # the first turns of a family's first conversation are few, and its members are at most a hundred
    first = placed.filter((F.col("conv_id") % FAMILY == 0) & (F.col("place") < HEADS - 1))
    heads = first.groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(F.struct("place", "one", "two", "size"))).alias("head"))
    convs = counts.withColumns({"taken": taken, "base": base}).join(heads, "base", "left").withColumn("head", F.slice(F.coalesce("head", F.array()), 1, F.col("taken").cast("int")))
    convs = cut(convs.select("conv_id", "taken", "head", (F.size("head") + F.greatest(F.lit(0), F.col("own") - F.col("taken"))).cast("long").alias("n")), "convs")
    ahead = convs.select("conv_id", "n", F.explode("head").alias("t")).select("conv_id", "n", (F.col("t.place") + 1).alias("depth"), "t.one", "t.two", "t.size")
    kept = placed.join(convs.select("conv_id", "n", "taken", F.size("head").alias("k")), "conv_id").filter("place >= taken")
    own = kept.select("conv_id", "n", (F.col("place") - F.col("taken") + F.col("k") + 1).alias("depth"), "one", "two", "size")
    return convs.select("conv_id", "n"), ahead.unionByName(own)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, n, depth, node, parent, size, upto: code points up to here) for each turn."""
    entry = lambda *c: F.xxhash64(*c).cast("decimal(20,0)")
    rows = turns.select("conv_id", "n", "depth", "size", entry("depth", "one", "two").alias("one"), entry(F.lit(1), "two", "depth", "one").alias("two"))
    summed = running_sums(rows, "conv_id", "depth", {"s1": F.col("one"), "s2": F.col("two"), "upto": F.col("size")})
    # a sum less the row's own entry is the sum of the row before
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    parent = F.when(F.col("depth") == 1, F.lit(ROOT)).otherwise(_node(F.col("depth") - 1, (wide("s1") - F.col("one")).cast("decimal(38,0)"), (wide("s2") - F.col("two")).cast("decimal(38,0)")))
    return summed.select("conv_id", "n", "depth", _node(F.col("depth"), wide("s1"), wide("s2")).alias("node"), parent.alias("parent"), "size", "upto")


def digests_of_ends(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) for rows (node, conv_id): ids in numeric order, joined in blocks of ids and digested one block after the other."""
    blocks = ends.groupBy("node", _block(F.col("conv_id")).alias("block")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done: list[tuple[str, str]] = []
            for at, ids in zip(batch.column("node").to_pylist(), batch.column("ids")):
                if at != node:
                    done += [(node, state.hexdigest())] if state else []
                    node, state = at, hashlib.sha256()
                    state.update(ids.as_py().encode())
                else:
                    state.update(b"," + ids.as_py().encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], pa.string()) for k in (0, 1)], ["node", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (node, state.hexdigest())], ["node", "ends_sha256"])

    return blocks.repartition("node").sortWithinPartitions("node", "block").select("node", "ids").mapInArrow(digest, "node string, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """One row a node: node and parent (their keys), conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs, turns = rebuilt(conversations)
    every = cut(prefixes(turns), "prefixes")
    whole = every.filter("depth = n").select("node", "conv_id", "upto").unionByName(convs.filter("n = 0").select(F.lit(ROOT).alias("node"), "conv_id", F.lit(0).cast("long").alias("upto")))
    ends = cut(whole, "ends")
    sequences = cut(ends.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"), F.first("upto").alias("all")), "sequences")
    # one conversation of each sequence is taken apart
    steps = cut(every.join(sequences.select("conv_id", "weight", "all"), "conv_id"), "steps")
    proper = steps.select(F.col("parent").alias("node")).distinct()
    leaves = sequences.join(proper, "node", "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    top = sequences.select("conv_id", "weight", "all", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("size"), F.lit(0).cast("long").alias("upto"))
    weighted = steps.select(*top.columns).unionByName(top).join(leaves, "conv_id", "left")
    below = F.col("all") - F.col("upto") + F.col("size")
    nodes = cut(
        weighted.groupBy("node").agg(
            F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.first("size").alias("size"), F.min("conv_id").alias("conv_id"),
            F.sum("weight").alias("n_convs"), F.count("leaf").alias("n_leaves"), F.sum(F.col("weight") * below).alias("texts"),
        ),
        "nodes",
    )
    # each node's text once: on the sequence of its smallest member
    once = steps.select("conv_id", "depth", "node", "size").join(nodes.select("conv_id", "depth", F.lit(True).alias("own")), ["conv_id", "depth"], "left")
    counted = cut(running_sums(once.withColumn("size", F.when(F.col("own"), F.col("size")).otherwise(0)), "conv_id", "depth", {"upto": F.col("size")}), "once")
    last = counted.groupBy("conv_id").agg(F.max("upto").alias("all"))
    suffix = counted.join(last, "conv_id").groupBy("node").agg(F.sum(F.col("all") - F.col("upto") + F.col("size")).alias("kept"))
    root = last.agg(F.sum("all").alias("kept")).select(F.lit(ROOT).alias("node"), "kept")
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    # a parent may have very many children
    of_parent = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    parents = salted_join(nodes.select("node", "parent"), of_parent, "parent", "node").select("node", "parent_conv_id")
    out = nodes.join(suffix.unionByName(root), "node", "left").join(children, "node", "left").join(parents, "node", "left").join(digests_of_ends(ends.select("node", "conv_id")), "node", "left")
    return out.select(
        "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
        (F.col("texts") - F.coalesce("kept", F.lit(0))).cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(read(spark, sf_dir, "conversations")).drop("node", "parent")


def oracle_sql() -> str:
    """DuckDB SQL of the same nodes, every prefix of every conversation as a list."""
    return """
WITH own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS ts FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), headed AS (
  SELECT conv_id, ts, xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
    lambda a, b: list_reduce([xor(a, b)] || [0::BIGINT for x in range(8)], lambda y, z: xor(y >> 1, 3988292384 * (y & 1))))) % 6 AS h FROM own
), built AS (
  SELECT c.conv_id, CASE WHEN b.ts IS NULL THEN c.ts[c.h + 1:] ELSE b.ts[1:c.h] || c.ts[c.h + 1:] END AS ts FROM headed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
), member AS (
  SELECT conv_id, len(ts) AS n, unnest(range(0, len(ts) + 1)) AS depth, ts FROM built
), steps AS (SELECT conv_id, n, depth, ts[1:depth] AS p, CASE WHEN depth > 0 THEN ts[1:depth - 1] END AS up FROM member
), nodes AS (
  SELECT p, depth, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, CASE WHEN depth = 0 THEN 0 ELSE length(any_value(p[depth].t)) END AS size,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = n), '')) AS ends_sha256 FROM steps GROUP BY p, depth
), kids AS (SELECT up AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY up
), under AS (
  SELECT a.p, count(*) FILTER (WHERE k.p IS NULL) AS n_leaves, sum((d.n_convs - 1) * d.size) AS saved_tokens
  FROM nodes d LEFT JOIN kids k ON k.p = d.p, unnest(range(0, d.depth + 1)) AS u(k) JOIN nodes a ON a.p = d.p[1:u.k] GROUP BY a.p
)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, u.n_leaves, u.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN under u ON u.p = n.p LEFT JOIN kids k ON k.p = n.p LEFT JOIN nodes q ON n.depth > 0 AND q.p = n.up"""
