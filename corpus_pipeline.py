"""Training-data pipeline over ``documents``: toxicity, near duplicates, repeated strings, benchmarks, pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all
that the stage before it kept. All but the last return the columns of their
input. ``run`` writes every stage's rows to the shared folder and reads them again,
so a lost executor costs at most the stage that was running.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfsense.llm.common import materialise, read
from shelfsense.llm.decontaminate import remove_contaminated
from shelfsense.llm.minhash import keep_first
from shelfsense.llm.pieces import encode_pieces
from shelfsense.llm.suffix_dedup import cut_repeats
from shelfsense.llm.toxicity import reject_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return reject_toxic(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of near duplicates the document with the smallest id stays."""
    return keep_first(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur elsewhere too are cut from the texts."""
    return cut_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go, single benchmark windows are cut from the others."""
    return remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the best segmentation, N-best scores, round trip.

    The executors' heaps are as large as the stages before have made them: the workers get along with less than alone."""
    return encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"),
                         remember=100_000, slice_bytes=512 << 10)


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup),
          ("decontamination", decontamination), ("sentencepiece", sentencepiece)]

#: A trained classifier and a segmentation search are not SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
