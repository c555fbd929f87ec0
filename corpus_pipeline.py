"""From documents to packed training sequences, stage by stage.

Every stage works on all rows that the one before kept; its result is written as
Parquet and read again, so that a lost executor costs tasks of one stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tonetape.llm.common import discard, watched, written
from tonetape.llm.copies import drop_copies
from tonetape.llm.jaccard import drop_near_copies
from tonetape.llm.mixing import mix
from tonetape.llm.packing import pack
from tonetape.llm.toxicity import drop_toxic

TOKENIZER = "word_bpe_49k.json"


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without the rows that the toxicity scorer rejects."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts, the one with the largest id."""
    return drop_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows joined by a similarity of 0.8 of their word shingles, the one with the smallest id."""
    return drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix of the sources to their weights takes it."""
    return mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the rows in sequences of at most 2048 tokens."""
    return pack(docs, public_tokenizers.path(TOKENIZER), keep_tokenizer=False)


_left: list[DataFrame] = []


def stage(step: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """step, which first deletes the tables that the stage before left for its result.

    That result is written by then, and docs reads it from where it was written; a
    table that docs itself reads stays."""

    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = {f.rpartition("/")[0] for f in docs.inputFiles()}
        gone = [t for t in _left if not any((t._llm_path or "-") in folder for folder in read)]
        discard(*gone)
        with watched() as tables:
            out = step(spark, docs, sf_dir)
        _left[:] = [t for t in [*_left, *tables] if t._llm_path]
        return out

    return run_step


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", stage(keep_civil)),
    ("exact_dedup", stage(drop_exact_copies)),
    ("jaccard_join", stage(drop_near)),
    ("mixing", stage(mix_sources)),
    ("packing", stage(pack_sequences)),
]

#: Boosted trees, rounding and packing are no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the documents in sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        before, docs = docs, written(step(spark, docs, sf_dir), name)
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
