"""Readers: typed tables from CSV, Parquet, JSON and text. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.scalars import null_if_nan


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path has any bytes, in whatever file system it is."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p)) and fs.getContentSummary(p).getLength() > 0


def pick_path(spark: SparkSession, *paths: str) -> str | None:
    """The first of the paths that has any bytes."""
    return next((p for p in paths if exists(spark, p)), None)


def _typed(name: str, kind: T.DataType) -> Column:
    text = F.col(name)
    if isinstance(kind, T.TimestampType):
        return F.try_to_timestamp(text)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return null_if_nan(text.try_cast("double")).cast(kind)
    if isinstance(kind, (T.IntegerType, T.LongType)):
        return text.try_cast("double").try_cast(kind)
    return text.cast(kind)


def timeseries(spark: SparkSession, path: str, columns: dict[str, str], fmt: str = "csv") -> DataFrame:
    """A table of the given schema; bad numbers become missing, rows with a bad clock are dropped, a missing path is empty."""
    schema = S.table(**columns)
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    if fmt == "parquet":
        raw = spark.read.parquet(path)
    else:
        raw = spark.read.option("header", True).csv(path)
    have = {c: _typed(c, f.dataType) if c in raw.columns else F.lit(None).cast(f.dataType) for c, f in ((f.name, f) for f in schema)}
    rows = raw.select(*[v.alias(c) for c, v in have.items()])
    return rows.filter("clock is not null") if "clock" in columns else rows


def selection_report(spark: SparkSession, path: str) -> DataFrame:
    """The selection report; columns it lacks are ''."""
    rows = timeseries(spark, path, S.SELECTED)
    return rows.fillna("", subset=[c for c, k in S.SELECTED.items() if k == "string"])


def _trend_columns() -> list[Column]:
    number = lambda c: null_if_nan(F.col(c).try_cast("double"))
    return [F.col("itemid").cast("string"), F.timestamp_seconds(F.col("clock").try_cast("long")).alias("clock"), F.coalesce(F.col("num").try_cast("int"), F.lit(0)).alias("num"), *[number(c).alias(c) for c in ("value_min", "value_avg", "value_max")]]


def trend_points(raw: DataFrame) -> DataFrame:
    """Raw trend records (text or numbers, epoch seconds) as TREND_RAW; records without an average are dropped."""
    return raw.select(*_trend_columns()).filter("value_avg is not null and clock is not null and itemid is not null")


def checked_points(raw: DataFrame) -> DataFrame:
    """Every raw trend record as TREND_RAW with `problem` (item, clock, value: the first that is missing or bad; else
    null) and, of those that have one, the `record` as JSON. Where problem is null the rows are trend_points()."""
    fields = ("itemid", "clock", "num", "value_min", "value_avg", "value_max")
    rows = raw.select(*_trend_columns(), F.struct(*fields).alias("r"))
    problem = F.when(F.col("itemid").isNull(), "item").when(F.col("clock").isNull(), "clock").when(F.col("value_avg").isNull(), "value")
    return rows.withColumn("problem", problem).withColumn("record", F.when(F.col("problem").isNotNull(), F.to_json("r"))).drop("r")


def history_points(raw: DataFrame) -> DataFrame:
    """Raw history records as HISTORY_RAW; records without a value are dropped."""
    rows = raw.select(F.col("itemid").cast("string"), F.timestamp_seconds(F.col("clock").try_cast("long")).alias("clock"), null_if_nan(F.col("value").try_cast("double")).alias("value"), F.coalesce(F.col("ns").try_cast("long"), F.lit(0)).alias("ns"))
    return rows.filter("value is not null and clock is not null and itemid is not null")


def json_records(spark: SparkSession, path: str, columns: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(records, errors) of JSON lines: lines that don't parse are rows of the error table."""
    schema = S.table(**columns, _bad="string")
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("source"), F.from_json("value", schema, {"columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return lines.filter("r._bad is null").select("r.*").drop("_bad"), lines.filter("r._bad is not null").select("source", F.col("r._bad").alias("message"))


def host_tree(spark: SparkSession, path: str) -> DataFrame:
    """One row with the column tree: system to role to hosts."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.from_json("value", "map<string, map<string, array<string>>>").alias("tree"))


def dump_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) of text files."""
    text = spark.read.option("pathGlobFilter", "*.txt").text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    return text.select("file", F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))


def captures(spark: SparkSession, path: str) -> DataFrame:
    """(host, file, exit_code, text) of all text files of a folder; bytes that aren't UTF-8 are replaced, never fatal. Spark's readers skip files without a byte."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    return files.select(F.lit(None).cast("string").alias("host"), F.element_at(F.split("path", "/"), -1).alias("file"), F.lit(0).alias("exit_code"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def existing_triggers(triggers: DataFrame, hosts: DataFrame) -> DataFrame:
    """Triggers made for forecasts, of the given hosts."""
    own = triggers.filter(F.col("description").contains("[NativeForecast]"))
    ids = own.select("triggerid", F.explode("hosts.hostid").alias("hostid")).join(hosts.select("hostid"), "hostid", "left_semi").select("triggerid").distinct()
    return own.join(ids, "triggerid", "left_semi")


def existing_items(items: DataFrame, hosts: DataFrame) -> DataFrame:
    return items.join(hosts.select("hostid").distinct(), "hostid", "left_semi")
