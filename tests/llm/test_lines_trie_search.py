"""Operators 11, 12, 13 against brute force, and their edge cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfsense.llm import lexical_search as ls
from shelfsense.llm import line_dedup as ld
from shelfsense.llm import prefix_trie as pt
from shelfsense.llm.common import keyed
from shelfsense.session import scratch_path
from tests.llm import brute
from tests.llm.conftest import DOCS

LINES = ("n_lines", "n_dropped", "kept_sha256")


def table(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select("doc_id", *columns).collect()}


def line_rows(seed=5):
    """Texts of lines from a small stock: in other cases, with blanks around them, repeated, short, blank."""
    r = random.Random(seed)
    stock = ["".join(r.choice("abcdeÉß x") for _ in range(r.randint(6, 16))) for _ in range(60)]
    edge = lambda: r.choice(["", " ", "\t", "\r", " \x0b\x0c"])
    out = [(None if i % 17 == 3 else "\n".join(edge() + r.choice([str, str.upper, str])(r.choice(stock)) + edge()
            for _ in range(r.randint(0, 12)))) for i in range(80)]
    out += ["", "\n", "\n\n", "ten chars!", "TEN CHARS!\nten chars!\n", "nine char", "nine char", "x" * 200_000,
            "x" * 200_000 + "\nshort", "\n".join("line number %d" % (i % 700) for i in range(5000)), "line number 5\nline number 699"]
    return [(7 * i, t, "en", "s", None) for i, t in enumerate(out)]


# ------------------------------------------------------------------ 11: lines
@pytest.mark.parametrize(("batches", "fanout"), [(1, 3), (7, 2)])
def test_lines_are_exact(spark, batches, fanout):
    rows = line_rows()
    want = brute.lines([(r[0], r[1]) for r in rows])
    assert sum(w[1] for w in want.values()) > 150
    got = ld.line_dedup(spark.createDataFrame(rows, DOCS).repartition(3), batches, fanout)
    assert table(got, *LINES) == want


def test_line_store_keeps_levels_and_goes_on(spark):
    """Runs of a level are compacted, no hash is in two runs, another store object takes over."""
    rows = line_rows()
    d = ld.line_entries(keyed(spark.createDataFrame(rows, DOCS)))
    folder, gone = scratch_path(spark, "store"), []
    for b in range(5):
        store = ld.LineRuns(spark, folder, fanout=2)
        gone += store.add(d.filter(F.floor(F.col("key") / 130) == b)).collect()
    assert {level: len(r) for level, r in store.levels.items() if r} == {0: 1, 2: 1}
    all_runs = store.table(store.runs[0]).unionAll(store.table(store.runs[1]))
    assert all_runs.count() == all_runs.select("h1", "h2").distinct().count() == d.select("h1", "h2").distinct().count()
    want = brute.lines([(r[0], r[1]) for r in rows])
    assert len(gone) == sum(w[1] for d, w in want.items() if d < 650)
    plan = d.join(store.table(store.runs[1]).select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")._jdf.queryExecution().toString()
    assert "Bucketed: true" in plan
    store.clear()


def test_line_batches_are_written_once_and_joined_once(spark, monkeypatch):
    """Seven batches make seven runs, compactions included, and one table of dropped lines."""
    runs, tables = [], []
    write, keep = ld.LineRuns._write, ld.materialise
    monkeypatch.setattr(ld.LineRuns, "_write", lambda self, rows: runs.append(write(self, rows)) or runs[-1])
    monkeypatch.setattr(ld, "materialise", lambda df, name: tables.append(name) or keep(df, name))
    rows = line_rows()
    got = ld.line_dedup(spark.createDataFrame(rows, DOCS), 7, 2)
    assert table(got, *LINES) == brute.lines([(r[0], r[1]) for r in rows])
    assert len(runs) == 7 and tables == ["dropped"]


def test_lines_of_odd_tables(spark, empty, odd_ids, clashing, rows):
    assert ld.line_dedup(empty).collect() == []
    got = sorted((r.n_lines, r.n_dropped) for r in ld.line_dedup(odd_ids).collect())
    assert got == [(1, 0)] * 4 + [(1, 1)] * 2  # one text three times, the others once
    assert table(ld.line_dedup(clashing), *LINES) == brute.lines([(r[0], r[1]) for r in rows])


# ------------------------------------------------------------------ 12: trie
CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"


def conversation_rows(seed=2):
    """Conversations from a small stock of turns: copies over many id ranges, prefixes, gaps, null turns, one long one."""
    r = random.Random(seed)
    stock = [(r.choice(["user", "assistant", None]), r.choice([None, "", "é" * 5, "hello there", "why? %d" % i])) for i in range(9)]
    ids = sorted(r.sample(range(-300, 3000), 150)) + [0, 100, 200, 700, 1100]
    out = []
    for c in sorted(set(ids)):
        n = r.choice([1, 1, 2, 3, 5, 8])
        out += [(c, None if (t == 0 and c % 7 == 0) else 2 * t, *r.choice(stock[:3] if t < 3 else stock)) for t in range(n)]
    out += [(5000 + 600 * i, t, "user", "same %d" % t) for i in range(9) for t in range(9)]
    out += [(9001, t, "user", "turn %d" % (t % 50)) for t in range(700)] + [(9002, t, "user", "turn %d" % (t % 50)) for t in range(650)]
    return out


def nodes(df):
    rows = df.collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("limit", [1024, 12, 1])
def test_trie_is_exact_whatever_bursts(spark, limit):
    rows = conversation_rows()
    got = nodes(pt.prefix_trie(spark.createDataFrame(rows, CONVERSATIONS).repartition(5), limit))
    assert got == brute.trie(rows)


def test_bursting_makes_heads_and_small_containers(spark):
    rows = conversation_rows()
    entries = pt.entries(pt.sequences(spark.createDataFrame(rows, CONVERSATIONS)))
    done, heads = pt.burst(entries, 12)
    assert heads.count() >= 3
    assert done.groupBy("ca", "cb").count().agg(F.max("count")).first()[0] <= 12
    ended = heads.filter(F.col("ends") != pt.NOTHING).count()
    assert done.count() + ended == entries.count()


def test_trie_of_odd_tables(spark):
    assert pt.prefix_trie(spark.createDataFrame([], CONVERSATIONS)).collect() == []
    rows = [(None, 1, "user", "lost"), (3, 0, "u", "a"), (3, 0, "u", "a"), (4, None, None, None), (4, 5, "u", "x" * 100_000)]
    wide = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], CONVERSATIONS + ", conv int, n int, seq int")
    assert nodes(pt.prefix_trie(wide, 1)) == brute.trie(rows)


# ------------------------------------------------------------------ 13: search
def hits(df):
    return sorted((r.item_id is None, r.item_id or 0, r["rank"], r.doc_id, r.score) for r in df.collect())


def want(docs, items, k=10):
    return sorted((i is None, i or 0, r, d, s) for i, r, d, s in brute.search(docs, items, k))


def items_of(rows):
    t = [r[1] for r in rows]
    return [(1, t[5][:300]), (2, t[8]), (3, None), (4, "!!"), (5, "lo LA one, Two? words"), (6, t[14] + " edit3 edit3"),
            (7, "unknown only"), (None, "tab and line"), (8, "lo LA one, Two? words"), (9, t[6])]


def test_search_is_exact(spark, docs, rows):
    items = items_of(rows)
    got = hits(ls.lexical_search(docs, spark.createDataFrame(items, "item_id bigint, text string")))
    assert got == want([(r[0], r[1]) for r in rows], items) and len(got) > 40


def test_search_in_blocks_and_other_k(spark, clashing, rows):
    items = items_of(rows)
    wide = spark.createDataFrame([(*i, 1, 2, 3) for i in items], "item_id bigint, text string, rank int, score int, doc_id int")
    assert hits(ls.lexical_search(clashing, wide, k=3, block_terms=40)) == want([(r[0], r[1]) for r in rows], items, 3)


def test_search_of_odd_tables(spark, empty, odd_ids, docs):
    items = spark.createDataFrame([(1, "w1 w2 tail"), (1, "other")], "item_id bigint, text string")
    rows = [(r.doc_id, r.text) for r in odd_ids.collect()]
    assert hits(ls.lexical_search(odd_ids, items)) == want(rows, [(1, "w1 w2 tail"), (1, "other")])
    assert ls.lexical_search(empty, items).collect() == []
    assert ls.lexical_search(docs, items.limit(0)).collect() == []


def test_accumulators_are_limited_and_nothing_is_lost():
    """Rare terms fill the first places; the many documents that hold only frequent ones get no accumulator."""
    rng = np.random.default_rng(4)
    texts = ["".join("common%d " % c for c in rng.integers(0, 4, 6)) + "pad " * int(rng.integers(1, 30)) for _ in range(3000)]
    for i in range(0, 3000, 100):
        texts[i] += "rare scarce "
    raw = [t.encode() for t in texts]
    known = ls.term_hashes("rare scarce common0 common1 common2 common3")
    sieve = np.ones(1 << ls.SIEVE_BITS, bool)
    n, end, terms, tfs = ls.index_slice(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), known, sieve)
    df = np.bincount(terms, minlength=len(known))
    block = ls.Block(0, [1], known, [np.arange(len(known))])
    block.weigh(df, np.floor(1000 * np.log((2 * 3000 + 2) / (2 * df + 1))).astype(np.int64), 3000, int(n.sum()))
    best = ls.Best(1, 10)
    created = ls.search_slice(block, n, end, terms, tfs, np.arange(3000), np.zeros(3000, bool), best)
    assert created == 30
    item = [(1, "rare scarce common0 common1 common2 common3")]
    assert [(int(d), int(s)) for s, d, _ in zip(*best.rows[0])] == [(d, s) for _, _, d, s in brute.search(list(enumerate(texts)), item)]
