"""Incremental ingest of trend files.

A file stream is normalised, freed of the points that the sink already holds, joined with the static
selection and appended to the utilization and feature tables batch by batch. No point is too late:
old ones may come in any batch. Of several records of one point (itemid, clock) the greatest wins, whatever
batches they come in: a batch appends a record only if it is greater than what the sink has, and table() reads
the greatest. So the values do not depend on how files are dealt to batches. The exact daily percentile
can't be kept as cheap streaming state: each batch recomputes the days that it touched and appends them
as a newer version; daily() reads the last version of each day.

A batch reads the sink's folders of its own months alone. Its new points meet the selection once and are
written by month to a folder of their own, from which all tables are written; it goes with the batch. Every
batch adds a file a month to each table: compact() rewrites months of many parts as one. It runs while the
stream is stopped. A part holds a point once, so only months of several parts are searched for the greatest.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..operators import risk, utilization
from ..sources.tables import exists, trend_points

#: What tells records of one point apart, compared in this order; a missing value is the least.
RECORD = ("num", "value_min", "value_avg", "value_max")
SCHEMAS = {"util_trend": S.UTIL_TREND, "util_history": S.UTIL_HISTORY, "feature_trend": S.FEATURE_TREND, "feature_history": S.FEATURE_HISTORY}
#: Columns of a table that a point's record decides.
VALUES = {"num", "value_min", "value_avg", "value_max", "util_min", "util_avg", "util_max", "utilization_pct", "value"}
RAW = dict(itemid="string", clock="long", num="string", value_min="string", value_avg="string", value_max="string")


@dataclass(frozen=True)
class Tables:
    """Folders of the sink."""

    root: str

    def __getattr__(self, name: str) -> str:
        return f"{self.root}/{name}"


def raw_stream(spark: SparkSession, path: str, files_a_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(S.table(**RAW)).option("maxFilesPerTrigger", files_a_batch).parquet(path)


def months_of(rows: DataFrame) -> list[str]:
    """The months of a batch: a few rows, since they are months of a calendar."""
    found = rows.select((F.year("clock") * 12 + F.month("clock") - 1).alias("n")).distinct().collect()
    return sorted(f"{r['n'] // 12:04d}-{r['n'] % 12 + 1:02d}" for r in found)


def stored(spark: SparkSession, path: str, months: list[str]) -> DataFrame | None:
    """What the sink has of these months; none if it has nothing. No folder of another month is listed."""
    paths = [p for p in (f"{path}/month={m}" for m in months) if exists(spark, p)]
    return spark.read.option("basePath", path).parquet(*paths) if paths else None


def new_points(batch: DataFrame, number: int, tables: Tables, months: list[str] | None = None) -> DataFrame:
    """Points of a batch, one for each (itemid, clock) and of several the greatest record, unless another batch has written it or a greater one."""
    record, none = F.struct(*RECORD), F.lit(None).cast(S.table(num="int", value_min="double", value_avg="double", value_max="double"))
    rows = batch.select("itemid", "clock", record.alias("r"), none.alias("have"))
    for path in (tables.util_trend, tables.feature_trend):
        seen = stored(batch.sparkSession, path, months_of(batch) if months is None else months)
        if seen is not None:
            rows = rows.union(seen.filter(F.col("part") != part_of(number)).select("itemid", "clock", none.alias("r"), F.col("record").alias("have")))
    # by item, as the selection is joined: one shuffle for both
    points = rows.repartition("itemid").groupBy("itemid", "clock").agg(F.max("r").alias("r"), F.max("have").alias("have"))
    return points.filter(F.col("r").isNotNull() & (F.col("have").isNull() | (F.col("r") > F.col("have")))).select("itemid", "clock", "r.*")


def part_of(number: int) -> str:
    """The folder of a batch within a month; those of compact() begin with another letter."""
    return f"b{number}"


def _write_parts(rows: DataFrame, path: str, by_month: bool = False) -> None:
    """Append rows (with month and part), replacing parts of the same name; one writer a month, so that a part is one file.

    by_month: the rows are dealt so already (a large month of a file that is read in pieces has a file for each).
    """
    own = rows if by_month else rows.repartition("month")
    own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month", "part").parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _together(spark: SparkSession, *writes: Callable[[], object]) -> None:
    """Writes of different tables, side by side: their files are many and small, so one write seldom keeps all cores busy."""
    with ThreadPoolExecutor(len(writes)) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(w)) for w in writes]:
            done.result()


def append_batch(selected: DataFrame, tables: Tables):
    """Function of a batch: append all tables, then refresh the daily targets of its days."""

    def run(batch: DataFrame, number: int) -> None:
        spark, months = batch.sparkSession, months_of(batch)
        chosen = utilization.checked_broadcast(selected.drop("key_", "value_type").distinct())
        met = new_points(batch, number, tables, months).join(chosen, "itemid")
        rows = met.withColumns({"record": F.struct(*RECORD), "value": F.col("value_avg"), "month": F.date_format("clock", "yyyy-MM")})
        # a table and no cache: a cache that has read a table of the sink is lost when that is written
        place = f"{tables.staging}/{part_of(number)}"
        rows.repartition("month").write.mode("overwrite").partitionBy("source").parquet(place)
        try:
            staged = spark.read.schema(rows.schema).parquet(place).withColumn("part", F.lit(part_of(number)))
            if staged.isEmpty():
                return
            keep = ("record", "month", "part")
            targets, features = (staged.filter(F.col("source") == x) for x in ("target", "feature"))

            def write_history() -> None:
                _write_parts(utilization.target_history(targets, keep), tables.util_history, True)
                refresh_daily(spark, targets.select(F.to_date("clock").alias("date")).distinct(), months, number, tables)

            # a batch that is run again replaces what it wrote before: its folder is its number
            _together(
                spark,
                lambda: _write_parts(utilization.target_trend(targets, keep), tables.util_trend, True),
                write_history,
                lambda: _write_parts(utilization.own_feature_trend(features, keep), tables.feature_trend, True),
                lambda: _write_parts(utilization.own_feature_history(features, keep), tables.feature_history, True),
            )
        finally:
            _delete(spark, place)

    return run


def greatest(rows: DataFrame, name: str) -> DataFrame:
    """One row a point of a stored table: that of the greatest record, with it and its month."""
    values = [c for c in SCHEMAS[name] if c in VALUES]
    keys = ["itemid", "clock", *(c for c in SCHEMAS[name] if c not in VALUES | {"itemid", "clock"})]  # what differs most is sorted first
    return rows.groupBy(*keys, "month").agg(F.max(F.struct("record", *values)).alias("x")).select(*keys, "month", "x.*")


def points(spark: SparkSession, root: str, name: str, months: list[str] | None = None, only: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Rows of a utilization or feature table of the sink (of these months, that `only` keeps), each point once."""
    return _once(spark, getattr(Tables(root), name), months, lambda rows: greatest(rows, name), SCHEMAS[name], only)


def _once(spark: SparkSession, path: str, months: list[str] | None, last: Callable[[DataFrame], DataFrame], columns: dict[str, str], only: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Rows of a stored table without those that `last` drops; months of one part have none of these."""
    held = parts(spark, path, months)
    one, many = ([m for m, p in sorted(held.items()) if (len(p) > 1) == several] for several in (False, True))
    found = [spark.createDataFrame([], S.table(**columns))] if not held else []
    if one:
        found.append(only(stored(spark, path, one)).select(*columns))
    if many:
        found.append(last(only(stored(spark, path, many))).select(*columns))
    return reduce(DataFrame.union, found)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A utilization or feature table of the sink, each point once."""
    return points(spark, root, name)


def refresh_daily(spark: SparkSession, days: DataFrame, months: list[str], number: int, tables: Tables) -> None:
    """Append the daily p95 of these days (date) of these months, recomputed from the utilization table, as version `number`."""
    touched = lambda rows: rows.withColumn("date", F.to_date("clock")).join(F.broadcast(days), "date", "left_semi").drop("date")  # noqa: E731  one row a day
    history = points(spark, tables.root, "util_history", months, touched)
    rows = risk.daily_p95(history).withColumns({"month": F.date_format("date", "yyyy-MM"), "version": F.lit(number).cast("long"), "part": F.lit(part_of(number))})
    _write_parts(rows, tables.daily_p95)


def _last(rows: DataFrame, *more: str) -> DataFrame:
    keys = [c for c in S.DAILY if c != "target_p95"]
    return rows.groupBy(*keys, *more).agg(F.max(F.struct("version", "target_p95")).alias("x")).select(*keys, *more, "x.*")


def daily(spark: SparkSession, root: str) -> DataFrame:
    """The last version of each series and day, schema DAILY."""
    return _once(spark, Tables(root).daily_p95, None, _last, S.DAILY)


def parts(spark: SparkSession, path: str, months: list[str] | None = None) -> dict[str, list[str]]:
    """The part folders of each month (of these) of a stored table: names, not files."""
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s for m in (["*"] if months is None else months) for s in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/month={m}/part=*")) or []]
    out: dict[str, list[str]] = {}
    for s in found:
        out.setdefault(s.getPath().getParent().getName().split("=", 1)[1], []).append(s.getPath().getName().split("=", 1)[1])
    return out


def compact(spark: SparkSession, root: str, most: int = 1) -> dict[str, int]:
    """Rewrite every month that has more than `most` parts as one part; gives the months rewritten of each table.

    The new part is written before the old ones go. Until then, or if the job is lost in between, the same rows are
    there twice, which changes nothing: readers take one row a point and the last version of a day.
    """
    done = {}

    def rewrite(name: str) -> None:
        path = getattr(Tables(root), name)
        many = {m: p for m, p in parts(spark, path).items() if len(p) > most}
        done[name] = len(many)
        if not many:
            return
        rows = stored(spark, path, sorted(many)).repartition("month")  # by month once, for the groups and for the writers
        new = f"c{max(int(p[1:]) for ps in many.values() for p in ps) + 1}"  # never a part that it reads
        kept = greatest(rows, name) if name in SCHEMAS else _last(rows, "month")
        _write_parts(kept.withColumn("part", F.lit(new)), path, True)
        for month, old in many.items():
            for p in old:
                _delete(spark, f"{path}/month={month}/part={p}")

    _together(spark, *[partial(rewrite, name) for name in (*SCHEMAS, "daily_p95")])
    return done


def ingest(spark: SparkSession, path: str, selected: DataFrame, root: str, checkpoint: str, files_a_batch: int = 100) -> StreamingQuery:
    """Start the stream over what is there now; await its end, or run it again later."""
    points = trend_points(raw_stream(spark, path, files_a_batch))
    return points.writeStream.foreachBatch(append_batch(selected, Tables(root))).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
