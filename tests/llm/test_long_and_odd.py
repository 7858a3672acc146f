"""Very long texts, null and repeated ids, clashing columns and ties, for the operators over documents."""

import random

import public_tokenizers
import pytest

from shelfsense.llm import (decontaminate, minhash, pieces, quality_knn, quality_rules, substring_dedup, suffix_dedup,
                            token_output, toxicity)
from tests.llm import brute
from tests.llm.conftest import CLASH
from tests.llm.test_tokens import expected_tokens

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LABELS = "doc_id bigint, quality int, toxic int"


def long_rows():
    r = random.Random(9)
    vocab = ["".join(r.choice("abcdeéß") for _ in range(r.randint(2, 9))) for _ in range(5000)]
    text = " ".join(r.choice(vocab) for _ in range(6_000))
    return [(1, text), (2, "x" * 40_000), (3, "lo " * 8_000), (4, text + " and a tail"), (5, "short"), (6, None),
            (7, "\n".join(text[i:i + 60] for i in range(0, 18_000, 60))), (8, "short")]


@pytest.fixture(scope="module")
def long(spark):
    """Long texts in a table with columns of clashing names."""
    rows = [(d, t, "en", "s", None if t is None else len(t), 7, 1, 2, 0.5, "r", 9, "b", False) for d, t in long_rows()]
    return spark.createDataFrame(rows, CLASH)


def table(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select("doc_id", *columns).collect()}


def test_long_texts_in_the_dedup_operators(long):
    rows = long_rows()
    assert table(substring_dedup.substring_dedup(long), "n_words", "n_removed", "kept_sha256") == brute.substring(rows)
    assert table(minhash.near_duplicates(long), "n_shingles", "component_id", "kept") == brute.near(rows)
    assert table(suffix_dedup.suffix_dedup(long), "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.repeats(rows)


def test_long_texts_in_rules_and_decontamination(spark, long):
    rows = long_rows()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert table(quality_rules.quality_rules(long), *names) == brute.rules(rows)
    words = rows[0][1].split(" ")
    items = [(1, " ".join(words[3_000:3_040])), (2, "lo lo lo lo lo lo lo lo lo lo lo lo lo"), (3, "short")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    names = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert table(decontaminate.contamination(long, bench), *names) == brute.contaminated(rows, items)


def test_long_texts_in_token_and_piece_output(long):
    rows = long_rows()
    got = token_output.token_output(long, BPE).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()
    assert [tuple(r) for r in got] == expected_tokens(rows)
    got = {r.doc_id: r for r in pieces.encode_pieces(long, PIECES).collect()}
    assert len(got) == len(rows) and all(r.round_trip and all(r.nbest_round_trip) for r in got.values())
    assert got[5].ids == got[8].ids and got[6].n_pieces == 0


def test_long_texts_and_repeated_rows_in_the_classifiers(spark, long):
    labels = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(1, 9)] + [(None, 1, 1), (3, None, None)], LABELS)
    for scores in (quality_knn.quality_scores(long, labels), toxicity.toxicity_scores(long, labels)):
        got = {r.doc_id: r for r in scores.collect()}
        assert len(got) == 8 and all(0 <= r.score <= 1 for r in got.values())
        assert got[5].score == got[8].score   # equal texts score alike


def test_null_and_repeated_ids_count_as_rows_of_their_own(spark, odd_ids):
    """Results of rows that share an id are those of their texts."""
    got = sorted((r.n_words, r.base_failed) for r in quality_rules.quality_rules(odd_ids).collect())
    assert got == [(0, True), (2, True), (60, False), (60, False), (60, False), (61, False)]
    bench = spark.createDataFrame([(None, " ".join("w%d" % i for i in range(13))), (3, "other text")], "item_id bigint, text string")
    got = sorted((r.n_words, r.n_hit, r.n_items) for r in decontaminate.contamination(odd_ids, bench).collect())
    assert got == [(0, 0, 0), (2, 2, 1), (60, 13, 0), (60, 13, 0), (60, 13, 0), (61, 13, 0)]
    got = sorted((r.n_pieces > 0, r.round_trip) for r in pieces.encode_pieces(odd_ids, PIECES).collect())
    assert got == [(False, True)] + [(True, True)] * 5
    labels = spark.createDataFrame([(4, 1, 1), (4, 0, 0), (5, 0, 0), (None, 1, 1)], LABELS)
    for scores in (quality_knn.quality_scores(odd_ids, labels), toxicity.toxicity_scores(odd_ids, labels)):
        rows = scores.collect()
        assert sorted((r.doc_id is None, r.doc_id) for r in rows if r.doc_id) == [(False, 4)] * 3 + [(False, 5)]
        assert len(rows) == 6 and all(r.held_out is False for r in rows if r.doc_id is None)
