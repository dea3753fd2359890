import datetime as dt

from pyspark.sql import functions as F

from headroom import schemas as S
from headroom.operators import risk, utilization
from headroom.sources.tables import trend_points
from headroom.streaming import ingest


def test_files_one_by_one_equal_batch(spark, tmp_path):
    d = str(tmp_path)
    base = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp())
    chosen = spark.createDataFrame([("7", "h", "a", "dev", "non-prod", "cpu", "target", "", "", "1", "k", 0, "identity"), ("7", "h", "a", "dev", "non-prod", "ram", "feature", "used_bytes", "", "1", "k", 0, "identity")], S.table(**S.SELECTED))
    rows = [("1", base + 3600 * i, "1", "1", str(i % 90), "99") for i in range(60)] + [("2", base, "1", "1", "5", "9"), ("1", base, None, None, None, None)]
    raw = spark.createDataFrame(rows, S.table(**ingest.RAW))
    for part in (raw.filter(f"clock < {base + 90000}"), raw.filter(f"clock >= {base + 90000}"), raw.filter(f"clock >= {base + 180000}")):  # the last comes again
        part.coalesce(1).write.mode("append").parquet(f"{d}/in")
        ingest.ingest(spark, f"{d}/in", chosen, f"{d}/out", f"{d}/state", 1).awaitTermination()
    batch = trend_points(raw)
    want = utilization.util_trend(batch, chosen)
    got = spark.read.parquet(f"{d}/out/util_trend").select(*S.UTIL_TREND)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert spark.read.parquet(f"{d}/out/feature_trend").count() == 60
    daily = risk.daily_p95(utilization.util_history(utilization.derive_history(batch, 0, None), chosen))
    assert sorted(map(str, ingest.daily(spark, f"{d}/out").collect())) == sorted(map(str, daily.collect()))


def test_old_points_of_a_later_batch_are_kept(spark, tmp_path):
    d = str(tmp_path)
    base = int(dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc).timestamp())
    chosen = spark.createDataFrame([("7", "h", "a", "dev", "non-prod", "cpu", "target", "", "", "1", "k", 0, "identity"), ("7", "h", "a", "dev", "non-prod", "ram", "feature", "used_bytes", "", "2", "k", 0, "identity")], S.table(**S.SELECTED))
    point = lambda item, day: (item, base + 86400 * day, "1", "1", "5", "9")
    files = ([point("1", 40), point("2", 40)], [point("1", 0), point("1", 40)], [point("1", -300), point("1", 0), point("2", 40), point("2", -300), point("2", -300)])
    for rows in files:  # the newest file comes first
        spark.createDataFrame(rows, S.table(**ingest.RAW)).coalesce(1).write.mode("append").parquet(f"{d}/in")
    ingest.ingest(spark, f"{d}/in", chosen, f"{d}/out", f"{d}/state", 1).awaitTermination()
    clocks = lambda name: sorted((r.clock.timestamp() - base) // 86400 for r in spark.read.parquet(f"{d}/out/{name}").select(F.to_timestamp("clock").alias("clock")).collect())
    assert clocks("util_trend") == clocks("util_history") == [-300, 0, 40]
    assert clocks("feature_trend") == clocks("feature_history") == [-300, 40]
    assert ingest.daily(spark, f"{d}/out").count() == 3


def test_greatest_record_wins_in_any_order_and_compaction_keeps_it(spark, tmp_path):
    base = int(dt.datetime(2024, 3, 30, tzinfo=dt.timezone.utc).timestamp())
    row = lambda item, metric, source, feature, transform: ("7", "h", "a", "dev", "non-prod", metric, source, feature, "", item, "k", 0, transform)
    chosen = spark.createDataFrame([row("1", "cpu", "target", "", "invert_100"), row("2", "ram", "feature", "used_bytes", "identity"), row("2", "ram", "target", "", "identity")], S.table(**S.SELECTED))
    # of item 1 the greater record has the lower utilization, as it is inverted; of item 2 records differ in one value, one lacks it
    files = [[("1", base, "1", "1", "30", "40"), ("2", base, "1", None, "5", "9")], [("1", base, "1", "1", "20", "50"), ("2", base, "1", "1", "5", "9")], [("1", base, "2", "0", "10", "10"), ("1", base + 86400 * 5, "1", "1", "3", "4")]]
    seen = []
    for k, order in enumerate(([0, 1, 2], [2, 1, 0], [1, 2, 0])):
        d = f"{tmp_path}/{k}"
        for f in order:
            spark.createDataFrame(files[f], S.table(**ingest.RAW)).coalesce(1).write.mode("append").parquet(f"{d}/in")
            ingest.ingest(spark, f"{d}/in", chosen, f"{d}/out", f"{d}/state", 1).awaitTermination()
        rows = lambda: [sorted(map(str, ingest.table(spark, f"{d}/out", n).collect())) for n in ingest.SCHEMAS] + [sorted(map(str, ingest.daily(spark, f"{d}/out").collect()))]  # noqa: B023, E731
        before = rows()
        assert ingest.compact(spark, f"{d}/out")["util_trend"] <= 2 and rows() == before
        assert all(len(p) == 1 for n in (*ingest.SCHEMAS, "daily_p95") for p in ingest.parts(spark, f"{d}/out/{n}").values())
        assert sum(ingest.compact(spark, f"{d}/out").values()) == 0
        # what comes again after compaction changes nothing, a greater record does
        spark.createDataFrame(files[0], S.table(**ingest.RAW)).coalesce(1).write.mode("append").parquet(f"{d}/in")
        ingest.ingest(spark, f"{d}/in", chosen, f"{d}/out", f"{d}/state", 1).awaitTermination()
        assert rows() == before
        seen.append(before)
    assert seen[0] == seen[1] == seen[2]
    got = {r.itemid: (r.num, r.util_min, r.util_avg) for r in ingest.table(spark, f"{tmp_path}/0/out", "util_trend").filter(F.col("clock") < "2024-04-01").collect()}
    assert got == {"1": (2, 90.0, 90.0), "2": (1, 1.0, 5.0)}


def test_a_batch_lists_the_folders_of_its_months_alone(spark, tmp_path):
    d = str(tmp_path)
    row = spark.createDataFrame([(m, "b0", 1) for m in ("2024-01", "2024-02", "2024-03")], "month string, part string, v int")
    row.write.partitionBy("month", "part").parquet(f"{d}/t")
    files = ingest.stored(spark, f"{d}/t", ["2024-02", "2024-09"]).inputFiles()
    assert files and all("month=2024-02" in f for f in files) and ingest.stored(spark, f"{d}/t", ["2024-09"]) is None


def test_a_batch_reads_its_points_twice_and_one_part_is_not_searched(spark, tmp_path):
    """Once for its months, once for all tables: writing one table doesn't make the others compute the points again."""
    tables = ingest.Tables(str(tmp_path))
    row = lambda item, metric, source, feature: ("7", "h", "a", "dev", "non-prod", metric, source, feature, "", item, "k", 0, "identity")
    chosen = spark.createDataFrame([row("1", "cpu", "target", ""), row("1", "ram", "feature", "used_bytes")], S.table(**S.SELECTED))
    read = spark.sparkContext.accumulator(0)

    def seen(clock):
        read.add(1)
        return clock

    batch = lambda first: spark.range(20).select(F.lit("1").alias("itemid"), F.timestamp_seconds(F.udf(seen, "long")(1711756800 + 3600 * (first + F.col("id")))).alias("clock"), F.lit(1).alias("num"), *[F.col("id").cast("double").alias(c) for c in ingest.RECORD[1:]])
    ingest.append_batch(chosen, tables)(batch(0), 0)
    searched = lambda: "Aggregate" in ingest.table(spark, tables.root, "util_trend")._jdf.queryExecution().optimizedPlan().toString()
    assert not searched() and ingest.table(spark, tables.root, "util_trend").count() == 20
    read.value = 0
    ingest.append_batch(chosen, tables)(batch(10), 1)  # half of it again
    assert read.value <= 40
    assert searched() and sorted(ingest.table(spark, tables.root, "feature_history").groupBy("value").count().collect())[-1].value == 19.0
    assert [ingest.table(spark, tables.root, n).count() for n in ingest.SCHEMAS] == [30] * 4
    ingest.compact(spark, tables.root)
    assert not searched() and [ingest.table(spark, tables.root, n).count() for n in ingest.SCHEMAS] == [30] * 4
    assert ingest.daily(spark, tables.root).count() == 2 and ingest.table(spark, f"{tmp_path}/none", "util_trend").count() == 0
