"""Pack documents into token sequences by vector best-fit.

Documents longer than a sequence are cut; all pieces then are items with a demand vector (tokens,
documents, attention cost), and sequences are bins with a capacity vector. Items of equal length have
equal demand, so only the histogram of lengths is needed to plan: lengths are placed from long to
short, each into the class of equal bins that best fits it (smallest weighted norm of the residual
after placing, or largest weighted dot product of residual and demand) under every constraint. The
histogram has at most `tokens` entries at any input size; the plan is a list of runs, "items r0.. of
this length go to sequences s0.. at this offset". Spark numbers the items of each length without
gaps and every task looks its items up in the runs. Documents never pass through the driver.

Defined cases: null text is the empty text, a document of the one id 0; null doc_ids and repeated
rows are packed like others; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, number_within, read, with_row_key

TOKENS = 2048
END = 0
TOKENIZER = "word_bpe_49k.json"
#: Words and word parts whose ids a task remembers.
REMEMBERED = 250_000


@dataclass(frozen=True)
class Capacity:
    """What a sequence can hold. Attention cost is the sum of squared piece lengths."""

    tokens: int = TOKENS
    documents: int = TOKENS
    attention: int = TOKENS**2


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Ids of whole texts, as little-endian 16-bit bytes, word by word with a memory.

    The tokenizer's rules never reach over white space, so the ids of a text are those of its words.
    Words of letters below U+0250 and ASCII signs go straight to its BPE model in parts that its
    pattern gives; all others go through the tokenizer itself.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # fixed value: the split pattern of this tokenizer file
        self.parts = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        shown = {b: level.pre_tokenize_str(c)[0][0] for c in map(chr, range(0x80, 0x250)) for b in [c.encode()] if len(b) == 2}
        self.bytes = {o: s for o, s in ((ord(k.decode()), v) for k, v in shown.items())}
        self.plain = re.compile(r"[!-~¡-¬®-įı-ɏ]+").fullmatch
        self.remembered = remembered
        self.word_ids: dict[bytes, bytes] = {}
        self.part_ids: dict[str, bytes] = {}

    def of_part(self, part: str) -> bytes:
        ids = self.part_ids.get(part)
        if ids is None:
            ids = b"".join([t.id.to_bytes(2, "little") for t in self.model.tokenize(part if part.isascii() else part.translate(self.bytes))])
            if len(self.part_ids) < self.remembered:
                self.part_ids[part] = ids
        return ids

    def of_word(self, word: bytes) -> bytes:
        if word.isalpha():  # of bytes: ASCII letters only
            return self.of_part(word.decode().lower())
        if word[:-1].isalpha() and 33 <= word[-1] <= 126:
            return self.of_part(word[:-1].decode().lower()) + self.of_part(chr(word[-1]))
        text = word.decode()
        low = text.lower()
        # some letters up to U+024F have their lower case beyond it
        if len(text) <= 64 and "<|" not in text and self.plain(text) and self.plain(low) and (text.isascii() or unicodedata.is_normalized("NFC", text)):
            if low.isalpha():
                return self.of_part(low)
            if low[:-1].isalpha() and low[-1].isascii():
                return self.of_part(low[:-1]) + self.of_part(low[-1])
            return b"".join(map(self.of_part, self.parts(low)))
        return b"".join([i.to_bytes(2, "little") for i in self.tokenizer.encode(text, add_special_tokens=False).ids])

    def of_text(self, text: bytes) -> bytes:
        """The words met first are remembered, which are mostly the frequent ones."""
        words, known = text.split(), self.word_ids
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            pass
        out, room = [], len(known) < self.remembered
        for w in words:
            ids = known.get(w)
            if ids is None:
                ids = self.of_word(w)
                if room:
                    known[w] = ids
            out.append(ids)
        return b"".join(out)


def pieces(docs: DataFrame, path: str | None = None, tokens: int = TOKENS) -> DataFrame:
    """(__row, doc_id, piece, start, length, ids_crc32) of rows (__row, doc_id, text)."""
    path = path or tokenizer_path()

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokenizer(path)
        for batch in batches:
            place, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column("text")):
                ids = np.frombuffer(words.of_text((text.as_py() or "").encode()), "<u2").astype("<u4")
                ids = np.append(ids, np.array([END], "<u4"))
                for k, at in enumerate(range(0, len(ids), tokens)):
                    own = ids[at : at + tokens]
                    place.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(len(own))
                    crc.append(zlib.crc32(own.tobytes()))
            of = pa.array(place, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("__row").take(of), batch.column("doc_id").take(of), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["__row", "doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("__row", "doc_id", F.col("text").cast("string").alias("text")).mapInArrow(cut_up, f"__row long, doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], capacity: Capacity = Capacity(), weights: tuple[float, float, float] = (1.0, 0.05, 0.2), rule: str = "norm") -> pd.DataFrame:
    """Runs (length, first, n, sequence, offset): n items of a length from number `first` on go to n sequences from `sequence` on.

    rule: "norm" takes the bins with the smallest weighted residual norm after placing, "dot" those
    with the largest weighted dot product of residual and demand.
    """
    most = np.array([capacity.tokens, capacity.documents, capacity.attention], float)
    w = np.array(weights)
    residual = np.empty((0, 3))
    bins = np.empty((0, 2), np.int64)  # first sequence and number of equal bins
    runs: list[tuple[int, int, int, int, int]] = []
    sequences = 0
    lengths = sorted((k for k, n in counts.items() if n > 0), reverse=True)
    for at, length in enumerate(lengths):
        left, first = counts[length], 0
        demand = np.array([length, 1, length * length], float)
        if (demand > most).any():
            raise ValueError(f"a piece of {length} tokens exceeds the capacity of a sequence")
        open_ = (residual[:, 0] >= lengths[-1]) & (residual[:, 1] >= 1)  # bins nothing fits into any more are closed
        residual, bins = residual[open_], bins[open_]
        while left:
            fits = np.flatnonzero((residual >= demand).all(axis=1))
            if not len(fits):
                break
            score = (w * ((residual[fits] - demand) / most) ** 2).sum(axis=1) if rule == "norm" else -(w * residual[fits] / most * demand / most).sum(axis=1)
            g = fits[np.argmin(score)]
            k = int(min(left, bins[g, 1]))
            runs.append((length, first, k, int(bins[g, 0]), int(most[0] - residual[g, 0])))
            if k < bins[g, 1]:  # the other bins of this class stay as they are
                residual = np.vstack([residual, residual[g]])
                bins = np.vstack([bins, [bins[g, 0] + k, bins[g, 1] - k]])
                bins[g, 1] = k
            residual[g] = residual[g] - demand
            left, first = left - k, first + k
        if left:  # new bins; an item best fits the bin that one of its kind has just opened
            each = int(min(most // demand))
            for n, fill in ((left // each, each), (1 if left % each else 0, left % each)):
                if n:
                    for j in range(fill):
                        runs.append((length, first, n, sequences, j * length))
                        first += n
                    residual = np.vstack([residual, most - fill * demand])
                    bins = np.vstack([bins, [sequences, n]])
                    sequences += n
    return pd.DataFrame(runs, columns=["length", "first", "n", "sequence", "offset"]).sort_values(["length", "first"]).reset_index(drop=True)


def place(items: DataFrame, runs: pd.DataFrame) -> DataFrame:
    """items (length, number) with sequence_id and offset."""
    keys = runs["length"].to_numpy(np.int64) * (1 << 48) + runs["first"].to_numpy(np.int64)
    first, sequence, offset = (runs[c].to_numpy(np.int64) for c in ("first", "sequence", "offset"))

    @F.pandas_udf("sequence_id long, offset long")
    def look_up(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        number = number.to_numpy(np.int64)
        run = np.searchsorted(keys, length.to_numpy(np.int64) * (1 << 48) + number, side="right") - 1
        return pd.DataFrame({"sequence_id": sequence[run] + number - first[run], "offset": offset[run]})

    return items.withColumn("__at", look_up("length", "number")).withColumns({"sequence_id": F.col("__at.sequence_id"), "offset": F.col("__at.offset")}).drop("__at")


def packed(docs: DataFrame, path: str | None = None, capacity: Capacity = Capacity(), rule: str = "norm") -> DataFrame:
    """Pieces of all rows of docs (doc_id, text) with their sequences."""
    rows = cut(pieces(with_row_key(docs.select("doc_id", "text"), "__row"), path, capacity.tokens), "pieces")
    # bounded: one count for each length up to the capacity
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    keyed = rows.withColumn("__item", F.xxhash64("__row", "piece"))
    numbered = number_within(keyed, ["length"], "__item", "number")
    return place(numbered, plan(counts, capacity, rule=rule)).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: all documents packed."""
    return packed(docs)
