"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from shelfsense.llm import oracle
from shelfsense.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = oracle.ORACLE


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op2_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back."""
    import public_tokenizers
    from shelfsense.llm.token_output import token_output
    return token_output(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


@query
def op10_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as dictionary-compressed WARC records, read back from the archives."""
    from shelfsense.llm.warc import warc_archive
    return warc_archive(read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and adaptive fences per language and source for all documents."""
    from shelfsense.llm.quality_rules import quality_rules
    return quality_rules(read(spark, sf_dir, "documents"))


@query
def op4_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by votes of the nearest labelled ones."""
    from shelfsense.llm.quality_knn import quality_scores
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents by subword embeddings and a softmax."""
    from shelfsense.llm.toxicity import toxicity_scores
    return toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in all documents."""
    from shelfsense.llm.decontaminate import contamination
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 20-word windows that start earlier elsewhere."""
    from shelfsense.llm.substring_dedup import substring_dedup
    return substring_dedup(read(spark, sf_dir, "documents"))


@query
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    from shelfsense.llm.minhash import near_duplicates
    return near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 200-byte strings that occur elsewhere too."""
    from shelfsense.llm.suffix_dedup import suffix_dedup
    return suffix_dedup(read(spark, sf_dir, "documents"))


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best and N-best segmentations of all documents, decoded again."""
    import public_tokenizers
    from shelfsense.llm.pieces import encode_pieces
    return encode_pieces(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), remember=900_000)


@query
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that an earlier document has."""
    from shelfsense.llm.line_dedup import line_dedup
    return line_dedup(read(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the prefix trie over the rebuilt conversations."""
    from shelfsense.llm.prefix_trie import prefix_trie
    return prefix_trie(read(spark, sf_dir, "conversations"))


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all documents for every benchmark item."""
    from shelfsense.llm.lexical_search import lexical_search
    return lexical_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES["pipeline"] = corpus_pipeline.run
