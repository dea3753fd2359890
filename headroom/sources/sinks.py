"""Writers: one partitioned write a table, never one job a scope."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.utilization import checked_broadcast

#: Bytes of a scope, before compression, that one writer is meant to take.
WRITER_BYTES = 256 << 20


def write(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet", order: tuple[str, ...] = (), counted: Observation | None = None) -> None:
    """A whole table; mode append adds a chunk. order: the files, one after the other, are sorted by these columns.

    counted learns the rows as they are written (see rows_of), without a job of its own.
    """
    df = df.orderBy(*order) if order else df
    df = df.observe(counted, F.count(F.lit(1)).alias("n")) if counted else df
    writer = df.write.mode(mode).option("maxRecordsPerFile", 5_000_000)
    (writer.option("header", True).csv if fmt == "csv" else writer.parquet)(path)


def rows_of(counted: Observation) -> int:
    """Rows that write() has counted; Spark drops the count of a table that it finds to be empty."""
    return (counted.get or {}).get("n", 0)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row before compression: texts and binaries by their length, all else as 8."""
    long = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    return sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c in long), F.lit(8 * (len(df.columns) - len(long)))).cast("long")


def write_by_scope(df: DataFrame, path: str, writer_bytes: int = WRITER_BYTES, mode: str = "overwrite") -> None:
    """A table by scope folders (as_slug, env_group), each written by as many tasks as its bytes ask for.

    df is read twice, the first time to measure the scopes: give a written table. The rows of a large
    scope are dealt to its writers by a hash of all their values, so no host or series stays in one piece.
    """
    scope = ["as_slug", "env_group"]
    sizes = df.groupBy(*scope).agg(F.sum(row_bytes(df)).alias("bytes")).withColumn("writers", F.ceil(F.col("bytes") / writer_bytes)).persist()
    try:
        total = sizes.agg(F.sum("bytes").alias("n")).first()["n"] or 0
        # at most one row for each writer_bytes of the table
        many = checked_broadcast(sizes.filter("writers > 1").select(*[F.col(c).alias(f"_{c}") for c in scope], F.col("writers").alias("_writers")))
        told = df.join(many, reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in scope]), "left")
        values = [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, T.MapType)]
        key = [*scope, F.pmod(F.xxhash64(*values), F.coalesce("_writers", F.lit(1)))]
        tasks = -(-total // writer_bytes)
        spread = told.repartition(tasks, *key) if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else told.repartition(*key)
        spread.select(*df.columns).write.mode(mode).option("maxRecordsPerFile", 5_000_000).partitionBy(*scope).parquet(path)
    finally:
        sizes.unpersist()


def write_bundle(tables: dict[str, DataFrame], path: str) -> dict[str, int]:
    """A report: one folder a named table. Gives the rows of each, counted as they are written."""
    counted = {name: Observation() for name in tables}
    for name, df in tables.items():
        write(df, f"{path}/{name}", counted=counted[name])
    return {name: rows_of(o) for name, o in counted.items()}


def write_records(checked: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """(points, errors) of tables.checked_points(), written in one pass by whether they are rejected and by month."""
    records = checked.withColumns({"rejected": F.col("problem").isNotNull(), "month": F.date_format("clock", "yyyy-MM")})
    records.write.mode("overwrite").option("maxRecordsPerFile", 5_000_000).partitionBy("rejected", "month").parquet(path)
    # of the records that were just written nothing has to be inferred
    back = checked.sparkSession.read.schema(records.schema).parquet(path)
    return back.filter("not rejected").drop("rejected", "problem", "record"), back.filter("rejected").select("itemid", "problem", "record")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, n): rows of each table."""
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()])


def read_bundle(spark: SparkSession, path: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{path}/{n}") for n in names}


def union_of_columns(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def run_context(spark: SparkSession, parameters: dict, counts: dict[str, int], path: str | None = None) -> DataFrame:
    """One row with the parameters and row counts of a run."""
    row = spark.createDataFrame([(json.dumps(parameters, default=str, sort_keys=True), counts)], "parameters string, row_counts map<string, long>")
    if path:
        row.coalesce(1).write.mode("overwrite").json(path)
    return row
