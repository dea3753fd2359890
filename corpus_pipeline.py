"""The corpus pipeline: quality rules, near-dedup, secret masking, mixing and packing, one after the other.

Every stage works on all that the one before kept, and is written as Parquet and read again in
between, so a lost executor costs at most the stage that runs. A stage's result has to be written before
the next stage is called: that one deletes the tables that the stages before it have left.

Defined cases: documents with null or empty texts fail the rules; null sources, languages and ids are
kept; repeated rows and copies leave one document; of equal doc_ids the first row stays; documents that
the mix takes several times are packed as often; very long texts pass every stage whole; an empty
documents or labels table is no error, and an empty one gives an empty result; extra columns of
documents are dropped by the first stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from headroom.llm import credentials, mixing, neardup, packing, rules
from headroom.llm.common import cut, forget_tables, read, tables_so_far

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Tables that the stages so far have left for their results.
_left: list[str] = []


def _stage(function: Stage) -> Stage:
    """A stage that begins by deleting what the stages before it needed: their results are written by then."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        forget_tables(spark, _left, docs)
        before = set(tables_so_far())
        out = function(spark, docs, sf_dir)
        _left[:] = [t for t in tables_so_far() if t in _left or t not in before]
        return out

    return run


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", _stage(rules.stage)),
    ("near-dedup", _stage(neardup.stage)),
    ("secret scan", _stage(credentials.stage)),
    ("source mixing", _stage(mixing.stage)),
    ("packing", _stage(packing.stage)),
]

#: Fingerprints, learned rules and packing can't be written as SQL; tests/llm hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, "pipeline")
    return docs
