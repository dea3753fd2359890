"""Media columns: content-defined chunks of stored media, kept once, and media rebuilt from them.

A text becomes a payload of 8-bit samples in a WAV file; the file's bytes are cut where a rolling
gear hash of the last 32 bytes has zeros, so cuts follow content and equal passages give equal
chunks. The store holds every medium once, as an ordered chunk list under its SHA-256: the rows of
equal texts refer to it. A chunk that occurs in more than one place (of one medium or several) is
kept once in a chunk table; the others stay in their medium's record. The chunk list of a medium,
joined with the chunk table, rebuilds it; its SHA-256 must be that of the medium as written, else the
job fails. Joins deal heavy keys (a passage or text with very many places) to several tasks.

Which media and chunks occur more than once follows from the digests alone, a narrow table; a Bloom
filter of at most MOST_BITS bits takes the answer to the tasks. Its false positives only send a few
more chunks to the tables: the result is exact whatever its size, and at any size of the input.

Defined cases: null text is the empty text; empty texts have a payload of one block of padding;
null doc_ids and repeated rows are kept, one result row each; very long texts are cut like others,
and one text with its chunks fits in a task's memory; an empty table gives an empty result; other
columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bloom_of, cut, may_hold, read, salted_join, with_row_key

BLOCK = 576
PAD = b"\xff"
RATE = 8000
HEADER = 44
#: A cut has so many zero bits: 2048 bytes between cuts on average, within these bounds.
CUT_BITS = 11
LEAST, MOST = 256, 16_384
MOST_BITS = 1 << 29
#: Gear values of the 256 bytes, from a rule.
GEAR = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=4).digest(), "little") for b in range(256)], np.uint32)


def payload_of(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode()
    return len(raw), raw + PAD * (max(1, -(-len(raw) // BLOCK)) * BLOCK - len(raw))


def wav(payload: bytes) -> bytes:
    """One channel of unsigned 8-bit samples."""
    return b"RIFF" + struct.pack("<I", 36 + len(payload)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8) + b"data" + struct.pack("<I", len(payload)) + payload


def samples_of(media: bytes) -> bytes:
    if media[:4] != b"RIFF" or media[8:16] != b"WAVEfmt " or struct.unpack("<I", media[40:44])[0] != len(media) - HEADER:
        raise ValueError("not a medium of this store")
    return media[HEADER:]


def chunks_of(media: bytes) -> list[bytes]:
    """Content-defined chunks. The hash of a place depends on the 32 bytes up to it only."""
    h = GEAR[np.frombuffer(media, np.uint8)]
    for k in (1, 2, 4, 8, 16):
        h[k:] += h[:-k] << np.uint32(k)
    out, start = [], 0
    for at in (np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist():
        while at - start > MOST:
            out.append(media[start : start + MOST])
            start += MOST
        if at - start >= LEAST:
            out.append(media[start:at])
            start = at
    while start < len(media):
        out.append(media[start : start + MOST])
        start += MOST
    return out


#: Bytes of a chunk's digest; a medium's SHA-256 is longer.
DIGEST = 16


def digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=DIGEST).digest()


def _prefix(digests: list[bytes]) -> np.ndarray:
    return np.array([int.from_bytes(d[:8], "little", signed=True) for d in digests], np.int64)


def digests(text: Column) -> Column:
    """The medium's own key and the keys of its chunks, as longs, the medium's first."""

    @F.pandas_udf("array<long>")
    def of(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            media = wav(payload_of(t)[1])
            out.append(_prefix([hashlib.sha256(media).digest(), *map(digest, chunks_of(media))]))
        return pd.Series(out, dtype=object)

    return of(text)


def repeated_filter(docs: DataFrame) -> np.ndarray:
    """Bloom filter, as 64-bit words, of the media of two or more rows and of the chunks with two or more places in all distinct media."""
    media = docs.select(digests(F.col("text")).alias("d")).groupBy(F.get("d", F.lit(0)).alias("medium")).agg(F.first("d").alias("d"), F.count(F.lit(1)).alias("n"))
    media = cut(media, "media-digests")
    chunks = media.select(F.explode(F.slice("d", 2, F.greatest(F.size("d"), F.lit(1)))).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    keys = cut(chunks.filter("n > 1").select("k").unionByName(media.filter("n > 1").select(F.col("medium").alias("k"))), "media-repeated")
    return bloom_of(keys, MOST_BITS)


CHUNKS = "array<struct<digest: binary, data: binary>>"


def stored(docs: DataFrame, bloom: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """The store of docs (__row, doc_id, text): records (__row, doc_id, n_bytes, sha, chunks) and tables (key, chunks).

    A record has the chunks of its medium, without the data of shared ones; none if the medium may be
    that of other rows too. Such a medium is in the tables under its SHA-256, and a shared chunk under
    its digest, each once: a task hands on each at most once, and of several tasks' one stays.
    """
    sent = docs.sparkSession.sparkContext.broadcast(bloom)
    kind = docs.schema["doc_id"].dataType.simpleString()
    chunk = pa.list_(pa.struct([("digest", pa.binary()), ("data", pa.binary())]))

    def listed(media: bytes) -> tuple[list[dict], list[tuple[bytes, bytes]]]:
        """The chunk list of a medium, and its shared chunks."""
        parts = chunks_of(media)
        names = [digest(p) for p in parts]
        far = may_hold(sent.value, _prefix(names))
        return [{"digest": d, "data": None if f else p} for d, p, f in zip(names, parts, far)], [(d, p) for d, p, f in zip(names, parts, far) if f]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, shas, lists = [], [], []
            for text in batch.column("text"):
                n, payload = payload_of(text.as_py())
                media = wav(payload)
                sha = hashlib.sha256(media).digest()
                lengths.append(n)
                shas.append(sha)
                lists.append(None if may_hold(sent.value, _prefix([sha]))[0] else listed(media)[0])
            yield pa.RecordBatch.from_arrays([batch.column("__row"), batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(shas, pa.binary()), pa.array(lists, chunk)], ["__row", "doc_id", "n_bytes", "sha", "chunks"])

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()

        def new(key: bytes) -> bool:
            if key in seen:
                return False
            if len(seen) < 1_000_000:  # beyond that a task may hand a key on again, and it is still kept once
                seen.add(key)
            return True

        for batch in batches:
            keys, lists = [], []
            for text in batch.column("text"):
                media = wav(payload_of(text.as_py())[1])
                sha = hashlib.sha256(media).digest()
                copied = bool(may_hold(sent.value, _prefix([sha]))[0])
                if copied and not new(sha):
                    continue
                parts, shared = listed(media)
                if copied:
                    keys.append(sha)
                    lists.append(parts)
                for d, p in shared:
                    if new(d):
                        keys.append(d)
                        lists.append([{"digest": d, "data": p}])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(lists, chunk)], ["key", "chunks"])

    records = docs.select("__row", "doc_id", "text").mapInArrow(write, f"__row long, doc_id {kind}, n_bytes long, sha binary, chunks {CHUNKS}")
    tables = docs.select("text").mapInArrow(share, f"key binary, chunks {CHUNKS}").groupBy("key").agg(F.first("chunks").alias("chunks"))
    return records, tables


def rebuilt(media: DataFrame, tables: DataFrame) -> DataFrame:
    """media (__row, doc_id, n_bytes, sha, chunks), no two with the same sha, with the ordered data of their chunks for chunks."""
    own = ["__row", "doc_id", "n_bytes", "sha"]
    away = F.exists("chunks", lambda c: c["data"].isNull())
    chunk = F.get("chunks", F.lit(0))
    table = tables.filter(F.length("key") == DIGEST).select(F.col("key").alias("digest"), chunk["data"].alias("data"))
    loud = media.filter(away)
    parts = loud.select("sha", F.posexplode("chunks").alias("at", "c")).select("sha", "at", "c.digest", "c.data")
    fetched = salted_join(parts.filter("data is null").drop("data"), table, "digest", "sha").select("sha", "at", "data")
    whole = parts.filter("data is not null").select("sha", "at", "data").unionByName(fetched).groupBy("sha").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "data"))), lambda x: x["data"]).alias("data"))
    back = loud.select(*own).join(whole, "sha").select(*own, "data")
    return media.filter(~away).select(*own, F.transform("chunks", lambda c: c["data"]).alias("data")).unionByName(back)


def features_of(samples: bytes) -> str:
    """Mean, deviation, peak, crossings of the middle, and entropy of the samples."""
    x = np.frombuffer(samples, np.uint8).astype(float)
    p = np.bincount(np.frombuffer(samples, np.uint8), minlength=256) / len(x)
    p = p[p > 0]
    crossings = int(((x[1:] >= 128) != (x[:-1] >= 128)).sum())
    return f"mean={x.mean():.4f};std={x.std():.4f};peak={int(np.abs(x - 128).max())};crossings={crossings};entropy={-(p * np.log2(p)).sum():.4f}"


OUT = ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def verified(media: DataFrame) -> DataFrame:
    """Join the chunks, verify the medium, read its samples and compute its columns."""
    kind = media.schema["doc_id"].dataType.simpleString()
    own = ["__row", "doc_id", "n_bytes", "sha"]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for sha, data in zip(batch.column("sha"), batch.column("data")):
                file = b"".join(data.as_py())
                if hashlib.sha256(file).digest() != sha.as_py():
                    raise ValueError("a medium differs from what was written")
                samples = samples_of(file)
                out.append((len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-32:]), len(file), sha.as_py().hex(), features_of(samples)))
            cols = list(zip(*out)) if out else [()] * 6
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in own], *[pa.array(c, t) for c, t in zip(cols, kinds)]], [*own, *OUT])

    return media.select(*own, "data").mapInArrow(check, f"__row long, doc_id {kind}, n_bytes long, sha binary, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def read_back(records: DataFrame, tables: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the media columns of every record: each medium is rebuilt once, rows of equal texts refer to it."""
    none = lambda c: F.lit(None).cast(records.schema[c].dataType).alias(c)
    copied = tables.filter(F.length("key") > DIGEST).select(none("__row"), none("doc_id"), none("n_bytes"), F.col("key").alias("sha"), "chunks")
    media = cut(verified(rebuilt(records.filter("chunks is not null").unionByName(copied), tables)), "media-columns")
    copies = salted_join(records.filter("chunks is null").drop("chunks"), media.filter("__row is null").select("sha", *OUT), "sha", "__row")
    return media.filter("__row is not null").select("doc_id", "n_bytes", *OUT).unionByName(copies.select("doc_id", "n_bytes", *OUT))


def media_columns(docs: DataFrame) -> DataFrame:
    """One row of media columns for every row of docs (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    records, tables = stored(with_row_key(docs, "__row"), repeated_filter(docs))
    return read_back(cut(records, "media-records"), cut(tables, "media-tables"))


def op8_media_chunking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_columns(read(spark, sf_dir, "documents"))
