import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from headroom.llm import media as M
from headroom.llm.common import salted_join


def test_chunks_follow_content():
    rnd = np.random.default_rng(1)
    a, b = rnd.bytes(60_000), rnd.bytes(9000)
    assert b"".join(M.chunks_of(a)) == a and M.chunks_of(b"") == [] and b"".join(M.chunks_of(b"\0" * 70_000)) == b"\0" * 70_000
    assert all(len(c) <= M.MOST for c in M.chunks_of(a))
    shifted = set(M.chunks_of(b + a))
    assert len([c for c in M.chunks_of(a) if c in shifted]) > 10
    with pytest.raises(ValueError):
        M.samples_of(b"RIFFxxxx")


def test_media_columns_round_trip(spark):
    rnd = random.Random(2)
    words = [f"w{i}é" for i in range(3000)]
    passage = " ".join(rnd.choices(words, k=3000))
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randrange(900))) + (passage if i % 3 == 0 else ""), "x") for i in range(40)]
    rows += [(None, None, "x"), (7, "", "x"), (8, passage, "x"), (8, passage, "x"), (9, passage, "x"), (10, passage * 30, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, chunks string")
    assert M.repeated_filter(df).any()
    want = []
    for d, t, _ in rows:
        raw = (t or "").encode()
        p = raw + b"\xff" * (-len(raw) % 576 or (576 if not raw else 0))
        assert len(p) % 576 == 0 and p
        want.append((d, len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), 44 + len(p), hashlib.sha256(M.wav(p)).hexdigest(), M.features_of(p)))
    assert sorted(map(tuple, M.media_columns(df).collect()), key=str) == sorted(want, key=str)
    docs = M.with_row_key(df.select("doc_id", "text"), "__row")
    # a filter that finds too much changes nothing
    records, tables = M.stored(docs, np.full(16, 2**64 - 1, np.uint64))
    assert sorted(map(tuple, M.read_back(M.cut(records, "t"), M.cut(tables, "t")).collect()), key=str) == sorted(want, key=str)
    assert M.media_columns(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def stored_bytes(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    records, tables = M.stored(M.with_row_key(docs, "__row"), M.repeated_filter(docs))
    data = records.select("chunks").unionByName(tables.select("chunks")).select(F.explode("chunks").alias("c"))
    return data.agg(F.coalesce(F.sum(F.length("c.data")), F.lit(0))).first()[0]


def test_copies_and_repeats_are_stored_once(spark):
    rnd = random.Random(4)
    text = " ".join(f"w{rnd.randrange(10**6)}" for _ in range(3000))
    one = stored_bytes(spark, [text])
    assert one == len(M.wav(M.payload_of(text)[1]))
    assert stored_bytes(spark, [text] * 1000) == one
    # the same passage again inside one medium: only what lies around the seams is new
    assert stored_bytes(spark, [text * 10]) < 1.6 * one
    assert stored_bytes(spark, [text, "head " + text, text + " tail"]) < 1.8 * one


def test_salted_join_keeps_every_row(spark):
    left = spark.range(5000).select((F.col("id") % 7).alias("k"), "id").withColumn("k", F.when(F.col("id") < 3000, 0).otherwise(F.col("k")))
    right = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    out = salted_join(left, right, "k", "id", 4, 500)
    assert out.count() == 5000 and out.filter("v <> k * 10").count() == 0 and out.select("id").distinct().count() == 5000
