"""Operators 5, 6, 7 against brute force, and their edge cases."""

import numpy as np
import pytest

from shelfsense.llm import bwt, minhash, suffix_dedup, substring_dedup
from tests.llm import brute


def table(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select("doc_id", *columns).collect()}


def texts(rows):
    return [(r[0], r[1]) for r in rows]


SUBSTRING = ("n_words", "n_removed", "kept_sha256")
NEAR = ("n_shingles", "component_id", "kept")
SUFFIX = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_substring_dedup_is_exact(docs, rows):
    want = brute.substring(texts(rows))
    assert sum(w[1] for w in want.values()) > 300
    assert table(substring_dedup.substring_dedup(docs), *SUBSTRING) == want


def test_near_duplicates_are_exact(docs, rows):
    want = brute.near(texts(rows))
    assert len({w[1] for w in want.values()}) < len(want)
    assert table(minhash.near_duplicates(docs), *NEAR) == want


def test_suffix_dedup_is_exact(docs, rows):
    want = brute.repeats(texts(rows))
    assert sum(w[1] for w in want.values()) > 2000
    assert table(suffix_dedup.suffix_dedup(docs), *SUFFIX) == want


def test_suffix_dedup_splits_hot_minimizers(docs, rows):
    """With a bound of one context every contested group is cut again and counted window by window."""
    assert table(suffix_dedup.suffix_dedup(docs, hot=1), *SUFFIX) == brute.repeats(texts(rows))


def test_clashing_columns_change_nothing(clashing, rows):
    assert table(substring_dedup.substring_dedup(clashing), *SUBSTRING) == brute.substring(texts(rows))
    assert table(minhash.near_duplicates(clashing), *NEAR) == brute.near(texts(rows))
    kept = minhash.keep_first(clashing)
    assert kept.columns == clashing.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, w in brute.near(texts(rows)).items() if w[2]}
    cut = suffix_dedup.cut_repeats(clashing)
    assert cut.columns == clashing.columns and cut.dtypes == clashing.dtypes and cut.count() == len(rows)


def test_empty_tables(empty):
    assert substring_dedup.substring_dedup(empty).collect() == []
    assert minhash.near_duplicates(empty).collect() == []
    assert suffix_dedup.suffix_dedup(empty).collect() == []
    assert minhash.keep_first(empty).collect() == [] and suffix_dedup.cut_repeats(empty).collect() == []


def test_null_and_repeated_ids(odd_ids):
    got = substring_dedup.substring_dedup(odd_ids).collect()
    # Three rows of one text, one that continues it: only the first place stays.
    assert sorted((r.n_words, r.n_removed) for r in got) == [(0, 0), (2, 0), (60, 0), (60, 60), (60, 60), (61, 60)]
    near = minhash.near_duplicates(odd_ids).collect()
    assert sum(r.kept for r in near) == 3 and len(near) == 6
    assert {r.component_id for r in near if r.n_shingles >= 56} == {4}
    cut = suffix_dedup.suffix_dedup(odd_ids).collect()
    assert len(cut) == 6 and sum(r.n_removed > 0 for r in cut) == 4


def test_big_bucket_is_worked_off_in_rounds(spark):
    """Many texts that share most coordinates: some linked, some not, none lost."""
    base = ["w%d" % i for i in range(80)]
    rows = []
    for i in range(40):
        w = list(base)
        for j in range(i % 4):
            w[(7 * i + 19 * j) % 80] = "e%d_%d" % (i, j)
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert table(minhash.near_duplicates(df), *NEAR) == brute.near(rows)


def test_sketch_fills_every_coordinate_and_estimates_similarity():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 1000, dtype=np.uint64))
    b = np.concatenate([a[:750], np.unique(rng.integers(0, 2**63, 250, dtype=np.uint64))])
    one = a[:1]
    s = minhash.sketch(np.concatenate([a, b, one]), np.cumsum([0, len(a), len(b), 1]), 400)
    assert (s > 0).all()
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.1


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merged_indexes_count_like_brute_force(seed):
    rng = np.random.default_rng(seed)
    alphabet = rng.integers(97, 100, 700).astype(np.uint8)
    strings = []
    for _ in range(12):
        a = rng.integers(0, 300)
        s = alphabet[a:a + rng.integers(200, 330)].copy()
        if rng.random() < 0.6:
            s[rng.integers(0, len(s))] = 65
        strings.append(s)
    strings.append(np.full(260, 97, np.uint8))
    parts = [strings[:5], strings[5:9], strings[9:]]
    shards = [bwt.Shard(np.concatenate(p), np.concatenate([[0], np.cumsum([len(x) for x in p])])) for p in parts]
    count = {}
    for s in strings:
        for i in range(len(s) - 199):
            k = s[i:i + 200].tobytes()
            count[k] = count.get(k, 0) + 1
    for p, flags in zip(parts, bwt.repeated(shards)):
        want = np.concatenate([[i + 200 <= len(s) and count[s[i:i + 200].tobytes()] > 1 for i in range(len(s))] for s in p])
        assert (flags == want).all()
