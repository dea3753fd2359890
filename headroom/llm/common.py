"""What the training-data operators share: reading, cutting lineage, row keys and gapless numbering."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words of the contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

_own_folder: list[str] = []
#: Folders that cut() has written and forget() hasn't deleted.
_written: list[str] = []


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see. Only a local session without one gets a temporary folder."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/headroom-cuts"
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="headroom-"))
    return _own_folder[0]


def _file_system(spark: SparkSession, path: str):
    """(file system, path) of the JVM."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def cut(df: DataFrame, name: str, block_mb: int = 128) -> DataFrame:
    """Write df to the shared folder and read it back: later jobs neither compute it again nor depend on an executor.

    The table goes when the application ends, or with forget(). block_mb: of a row group, less where rows are large.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    fs, p = _file_system(spark, path)
    fs.deleteOnExit(p)
    _written.append(path)
    df.write.option("compression", "zstd").option("parquet.block.size", block_mb << 20).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete a table of cut() that nothing reads any more."""
    if files := df.inputFiles():
        fs, p = _file_system(df.sparkSession, files[0].rsplit("/", 1)[0])
        fs.delete(p, True)
        _written[:] = [w for w in _written if w.rpartition("/")[2] != p.getName()]


def tables_so_far() -> list[str]:
    return list(_written)


def forget_tables(spark: SparkSession, paths: list[str], read_by: DataFrame) -> None:
    """Delete tables of cut() by their paths, but for those that read_by reads."""
    used = {f.rsplit("/", 2)[-2] for f in read_by.inputFiles()}
    for path in paths:
        if path in _written and path.rpartition("/")[2] not in used:
            fs, p = _file_system(spark, path)
            fs.delete(p, True)
            _written.remove(path)


def words_of(text: Column) -> Column:
    """Array of the words of a text; null text: no words."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def with_row_key(df: DataFrame, name: str) -> DataFrame:
    """Number the rows. The numbers are fixed once the result is written by cut()."""
    return df.withColumn(name, F.monotonically_increasing_id())


def number_within(df: DataFrame, keys: list[str], row: str, out: str, rows_per_task: int = 100_000) -> DataFrame:
    """Gapless numbers from 0 in each key, without gathering a key in one task.

    Rows of a key are dealt to sub-groups by their row number; each sub-group is numbered on its own
    and starts where the sub-groups before it end. df should be cheap to read twice (see cut()).
    """
    parts = max(1, df.count() // rows_per_task)
    dealt = df.withColumn("__part", F.pmod(F.xxhash64(F.col(row)), F.lit(parts)))
    inner = Window.partitionBy(*keys, "__part").orderBy(row)
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("__n")).withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in [*keys, "__part"]]
    ranked = dealt.withColumn("__rank", F.row_number().over(inner) - 1)
    joined = ranked.alias("l").join(starts.alias("r"), reduce(lambda a, b: a & b, same))
    return joined.select(*[F.col(f"l.{c}") for c in df.columns], (F.col("l.__rank") + F.col("r.__start")).cast("long").alias(out))


def salted_join(left: DataFrame, right: DataFrame, key: str, spread: str, salts: int = 16, least: int = 2000, counts: DataFrame | None = None) -> DataFrame:
    """Inner join on key where left may hold very many rows of one key: these are dealt to `salts` tasks by the column
    spread, and their partners in right (few rows a key) are repeated. left is read twice (see cut()), but for `counts`,
    the rows of left by key (key, __n), where they are known.

    A key is heavy from a 5,000th of all rows on, so at most 5,000 keys are broadcast.
    """
    counts = left.groupBy(key).agg(F.count(F.lit(1)).alias("__n")) if counts is None else counts
    heavy = counts.filter(F.col("__n") > max(least, left.count() // 5000)).select(key, F.lit(True).alias("__heavy"))
    salt = F.when(F.col("__heavy"), F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).otherwise(0)
    every = F.when(F.col("__heavy"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    dealt = left.join(F.broadcast(heavy), key, "left").withColumn("__salt", salt).drop("__heavy")
    repeated = right.join(F.broadcast(heavy), key, "left").withColumn("__salt", F.explode(every)).drop("__heavy")
    return dealt.join(repeated, [key, "__salt"]).drop("__salt")


def bloom_of(keys: DataFrame, most_bits: int) -> np.ndarray:
    """Bloom filter, as 64-bit words, of the hashes k (long): 32 bits a hash, at most most_bits in all."""
    bits = 1 << 10
    n = keys.count()
    while bits < 32 * n and bits < most_bits:
        bits *= 2
    places = keys.select(F.explode(F.array(F.col("k").bitwiseAND(bits - 1), F.shiftrightunsigned("k", 34).bitwiseAND(bits - 1))).alias("p"))
    words = places.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63L as int))")).alias("b")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[words["w"].to_numpy()] = words["b"].to_numpy()
    return out.view(np.uint64)


def may_hold(bloom: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether a Bloom filter may hold each hash."""
    keys, mask = keys.view(np.uint64), np.uint64(len(bloom) * 64 - 1)
    found = np.ones(len(keys), bool)
    for p in (keys & mask, (keys >> np.uint64(34)) & mask):
        found &= (bloom[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)
    return found


def signed(x: int) -> int:
    """An unsigned 64-bit value as Spark's long."""
    return x - (1 << 64) if x >= 1 << 63 else x


def text_crc32(value: Column) -> Column:
    return F.crc32(F.coalesce(value.cast("string"), F.lit("")).cast("binary"))


def remainder(doc_id: Column, folds: int) -> Column:
    """crc32(doc_id as text) mod folds; a null id counts as the empty text, whose remainder is 0."""
    return F.pmod(text_crc32(doc_id), F.lit(folds))
