"""Operators 3, 4, 8, 9 and the pipeline."""

import random

import numpy as np
import pytest

import corpus_pipeline
from shelfsense.llm import decontaminate, quality_knn, quality_rules, toxicity
from shelfsense.llm.common import read
from tests.llm import brute
from tests.llm.conftest import DOCS

SF = "/root/testdata/sf0.01"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def table(df, *columns):
    return {r[0]: tuple(r[1:]) for r in df.select("doc_id", *columns).collect()}


def test_rule_measures(docs, clashing, rows):
    want = brute.rules([(r[0], r[1]) for r in rows])
    assert table(quality_rules.quality_rules(docs), *MEASURES) == want
    assert table(quality_rules.quality_rules(clashing), *MEASURES) == want


def test_rules_run_without_python(docs):
    plan = quality_rules.measures(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rules_on_empty_and_odd_tables(empty, odd_ids):
    assert quality_rules.quality_rules(empty).collect() == []
    assert quality_rules.quality_rules(odd_ids).count() == 6


def test_fences_follow_their_source(spark):
    """A source full of symbols is judged by its own habits; the odd one out is rejected."""
    r = random.Random(2)
    plain = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(60))
    rows = [(i, plain(), "en", "web", 0) for i in range(250)]
    rows += [(1000 + i, plain().replace(" ", "|| "), "en", "tables", 0) for i in range(250)]
    rows += [(5000, plain().replace(" ", "|| "), "en", "web", 0)]
    got = {x.doc_id: x for x in quality_rules.quality_rules(spark.createDataFrame(rows, DOCS)).collect()}
    assert not got[5000].kept and "high_symbols" in got[5000].broken
    assert all(got[d].kept for d in got if d != 5000)


def test_a_small_source_leans_on_its_language_and_a_large_one_does_not(spark):
    """No size switches the level: the more rows a source has, the more it is judged by its own habits."""
    def one(n, s):
        return "".join("ab%d%s " % (i, "||" if i < s else "") for i in range(100)) + str(n)
    rows = [(i, one(i, 2), "en", "web", 0) for i in range(300)]
    rows += [(1000 + i, one(i, 30), "en", "few", 0) for i in range(3)]
    rows += [(2000 + i, one(i, 30), "en", "many", 0) for i in range(60)]
    got = {x.doc_id: x for x in quality_rules.quality_rules(spark.createDataFrame(rows, DOCS)).collect()}
    assert all("high_symbols" in got[1000 + i].broken for i in range(3))
    assert all(got[2000 + i].kept for i in range(60)) and all(got[i].kept for i in range(300))


def test_rules_that_reject(spark):
    """Each rule that can bind below the base rule does so for one document of an even corpus."""
    r = random.Random(6)
    word = lambda k: "".join(r.choice("abcdefgh") for _ in range(k))
    plain = lambda: " ".join(word(5) for _ in range(120))
    rows = [(i, plain(), "en", "web", 0) for i in range(80)]
    odd = {900: ("high_symbols", plain().replace(" ", "|| ")), 901: ("high_capitals", plain().upper()),
           902: ("high_word_length", " ".join(word(30) for _ in range(80))), 903: ("low_word_length", " ".join(word(1) for _ in range(80))),
           904: ("high_dup_lines", "\n".join([plain()] + ["one two three"] * 30))}
    rows += [(d, t, "en", "web", 0) for d, (_, t) in odd.items()]
    got = {x.doc_id: x for x in quality_rules.quality_rules(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(got[i].kept for i in range(80))
    for d, (rule, _) in odd.items():
        assert rule in got[d].broken.split(",") and not got[d].kept


def test_ties_at_the_last_neighbour_go_to_earlier_rows():
    known = np.zeros((300, 4), np.float32)
    known[:, 0] = 1
    y = np.r_[np.ones(25), np.zeros(275)].astype(np.float32)
    assert quality_knn.vote(known[:2], known, y, 0.5).tolist() == [1.0, 1.0]
    assert quality_knn.vote(known[:1], known, y[::-1].copy(), 0.5).tolist() == [0.0]
    known[10:, 0], known[10:, 1] = 0.6, 0.8   # ten nearer rows, then 290 that tie
    w = 10 + 15 * 0.6 ** 4
    y = np.r_[np.zeros(10), np.ones(15), np.zeros(275)].astype(np.float32)
    assert quality_knn.vote(np.array([[1, 0, 0, 0]], np.float32), known, y, 0.5)[0] == pytest.approx(15 * 0.6 ** 4 / w, rel=1e-4)


def test_votes_equal_a_plain_loop():
    rng = np.random.default_rng(5)
    known = quality_knn.unit(rng.normal(size=(400, 8)).astype(np.float32))
    known[200:220] = known[:20]
    y = (rng.random(400) < 0.3).astype(np.float32)
    asked = quality_knn.unit(rng.normal(size=(60, 8)).astype(np.float32))
    got = quality_knn.vote(asked, known, y, 0.5)
    for v, s in zip(asked, got):
        sim = np.rint((known @ v) / quality_knn.STEP) * quality_knn.STEP
        near = sorted(range(400), key=lambda i: (-sim[i], i))[:quality_knn.K]
        w = [max(float(sim[i]), 0) ** 4 for i in near]
        assert s == pytest.approx(sum(a * y[i] for a, i in zip(w, near)) / sum(w), rel=1e-4)


def test_slices_are_bounded_in_rows(spark):
    import pyarrow as pa
    texts = ["t%d" % i for i in range(2000)] + ["x" * 3_000_000, None, ""]
    parts = list(quality_knn.text_slices(pa.array(texts)))
    assert max(hi - lo for lo, hi, _, _ in parts) <= quality_knn.SLICE_ROWS
    assert [b for lo, hi, buf, off in parts for b in (buf[off[i]:off[i + 1]].tobytes() for i in range(hi - lo))] == [
        (t or "").encode() for t in texts]


@pytest.fixture(scope="module")
def labelled(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    return docs, labels


def accuracy(scores, labels, column):
    held = scores.join(labels, "doc_id").filter("held_out").select("predicted", column).collect()
    return np.mean([r.predicted == r[column] for r in held])


def test_quality_votes_on_held_out_rows(labelled):
    docs, labels = labelled
    got = quality_knn.quality_scores(docs, labels)
    assert got.count() == docs.count() and got.filter("score < 0 OR score > 1 OR score IS NULL").isEmpty()
    assert accuracy(got, labels, "quality") > 0.95


def test_votes_equal_brute_force():
    r = np.random.default_rng(0)
    x, known = quality_knn.unit(r.normal(size=(700, 8))), quality_knn.unit(r.normal(size=(300, 8)))
    y = (r.random(300) > 0.5).astype(float)
    got = quality_knn.vote(x, known, y, 0.5)
    for i in (0, 511, 512, 699):
        near = sorted(((float(x[i] @ k), v) for k, v in zip(known, y)), reverse=True)[:quality_knn.K]
        w = [max(s, 0) ** 4 for s, _ in near]
        assert got[i] == pytest.approx(sum(a * v for a, (_, v) in zip(w, near)) / sum(w))


def test_toxicity_learns_words_and_unseen_misspellings():
    r = random.Random(1)
    vocab = ["".join(r.choice("abcdeimnorstu") for _ in range(r.randint(3, 8))) for _ in range(600)]
    bad = ["vilethug", "scumwad", "trashlord"]
    make = lambda toxic: " ".join(r.sample(bad, 2) * toxic + [r.choice(vocab) for _ in range(r.randint(20, 80))])
    y = [i % 2 for i in range(3000)]
    model = toxicity.train([make(v) for v in y], y)
    words = toxicity.WordScores(model.weight)
    clean = toxicity.score_texts([make(0) for _ in range(100)], words, model.offset)
    seen = toxicity.score_texts([make(1) for _ in range(100)], words, model.offset)
    spelt = [make(0) + " vilethugg scumwadd" for _ in range(100)]
    unseen = toxicity.score_texts(spelt, words, model.offset)
    assert (clean < 0.5).mean() > 0.9 and (seen > 0.5).mean() > 0.9 and np.median(unseen) > np.median(clean)


def test_toxicity_of_a_table(spark, labelled, empty, docs, clashing):
    _, labels = labelled
    no = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert toxicity.toxicity_scores(empty, labels).collect() == []
    assert {r.score for r in toxicity.toxicity_scores(docs, no).collect()} == {0.0}
    mixed = spark.createDataFrame([(3 * i, None if i == 4 else 1, None if i == 4 else i % 2) for i in range(20)],
                                  "doc_id bigint, quality int, toxic int")
    got = toxicity.toxicity_scores(clashing, mixed).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.reject_toxic(clashing, mixed).columns == clashing.columns
    assert toxicity.reject_toxic(empty, mixed).collect() == []


def test_quality_without_labels_or_rows(spark, docs, empty, odd_ids, labelled):
    no = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in quality_knn.quality_scores(docs, no).collect()} == {0.5}
    assert quality_knn.quality_scores(empty, labelled[1]).collect() == []
    some = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (5, 0, 0), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert quality_knn.quality_scores(odd_ids, some).count() == 6


COLUMNS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def items_of(rows):
    text = {r[0]: r[1] for r in rows}
    w = text[15].split(" ")
    return [(1, " ".join(w[20:50])), (2, " ".join(w[30:43])), (10, "two WORDS"), (3, None), (4, " . "), (5, text[18]),
            (7, "ok"), (8, " ".join(w[40:45])), (1, " ".join(w[100:120]))]


def test_decontamination_is_exact(spark, docs, clashing, rows):
    items = items_of(rows)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute.contaminated([(r[0], r[1]) for r in rows], items)
    assert sum(w[1] > 0 for w in want.values()) >= 5
    assert table(decontaminate.contamination(docs, bench), *COLUMNS) == want
    # Blocks of a few words each: one pass per item, the same result.
    assert table(decontaminate.contamination(clashing, bench, block_words=10), *COLUMNS) == want


def test_automaton_on_random_sequences():
    r = random.Random(6)
    for _ in range(60):
        items = [(i, " ".join(r.choice("abc") for _ in range(r.randint(0, 9)))) for i in range(4)]
        rows = [(i, " ".join(r.choice("abcd") for _ in range(r.randint(0, 30)))) for i in range(5)]
        scanner = decontaminate.Scanner(decontaminate.build_automaton(items, 4))
        want = brute.contaminated(rows, items, 4)
        for d, t in rows:
            raw = np.frombuffer(t.encode(), np.uint8)
            n, hits, found = scanner.scan(raw, np.array([0, len(raw)]))
            covered = {k for _, a, z in hits for k in range(a, z)}
            assert (int(n[0]), len(covered), len(found[0])) == want[d][:3]


def test_an_automaton_stays_within_its_bytes_per_word():
    import tracemalloc
    r = random.Random(1)
    for word in (lambda: "w%d" % r.randint(0, 10**9), lambda: r.choice(["aa", "bb", "cc", "dd"])):
        items = [(i, " ".join(word() for _ in range(100))) for i in range(60)]
        tracemalloc.start()
        decontaminate.build_automaton(items)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak / 6000 <= decontaminate.WORD_BYTES
    assert decontaminate.BLOCK_WORDS * decontaminate.WORD_BYTES <= decontaminate.BLOCK_BYTES


def test_decontamination_edges(spark, docs, empty, odd_ids, clashing, rows):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert all(r.n_hit == 0 and not r.contaminated for r in decontaminate.contamination(docs, none).collect())
    bench = spark.createDataFrame(items_of(rows), "item_id bigint, text string")
    assert decontaminate.contamination(empty, bench).collect() == []
    assert decontaminate.contamination(odd_ids, bench).count() == 6
    left = decontaminate.remove_contaminated(clashing, bench)
    want = brute.contaminated([(r[0], r[1]) for r in rows], items_of(rows))
    assert left.columns == clashing.columns
    by = {r.doc_id: r for r in left.collect()}
    assert set(by) == {d for d, w in want.items() if not w[4]}
    for d, t, *_ in rows:
        if d in by and not want[d][1]:
            assert by[d].text == t


def test_pipeline_stages(spark, docs, rows):
    """Each stage's decisions take effect on what the stage before it kept."""
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "suffix_dedup", "decontamination", "sentencepiece"]
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        before, now = now, stage(spark, now, "/root/testdata/sf0.001")
        if name != "sentencepiece":
            assert now.columns == docs.columns
        if name == "near_dedup":
            own = [(r.doc_id, r.text) for r in before.collect()]
            assert {r.doc_id for r in now.collect()} == {d for d, w in brute.near(own).items() if w[2]}
        if name == "suffix_dedup":
            want = brute.repeats([(r.doc_id, r.text) for r in before.collect()])
            got = {r.doc_id: r.text for r in now.collect()}
            assert got.keys() == want.keys()
            # The kept bytes of a text, without the rest of a character that a cut went through.
            kept = brute.kept_bytes([(r.doc_id, r.text) for r in before.collect()])
            assert {d: (t or "") for d, t in got.items()} == {d: b.decode("utf-8", "ignore") for d, b in kept.items()}
        if name == "decontamination":
            items = [(r.item_id, r.text) for r in read(spark, "/root/testdata/sf0.001", "benchmark").collect()]
            want = brute.contaminated([(r.doc_id, r.text) for r in before.collect()], items)
            assert {r.doc_id for r in now.collect()} == {d for d, w in want.items() if not w[4]}
    assert all(r.round_trip for r in now.collect())


def test_the_pipeline_runs_its_stages_in_order(spark):
    """``run`` gives what its stages give one after the other, on the whole table."""
    sf = "/root/testdata/sf0.001"
    now = read(spark, sf, "documents")
    n = now.count()
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf)
    want = sorted((r.doc_id, r.n_pieces, r.ids_crc32) for r in now.collect())
    got = sorted((r.doc_id, r.n_pieces, r.ids_crc32) for r in corpus_pipeline.run(spark, sf).collect())
    assert got == want and 0.5 * n < len(got) < n


def test_toxicity_scores_equal_a_plain_loop():
    r = np.random.default_rng(3)
    weight, offset = r.normal(size=toxicity.BUCKETS).astype(np.float32), -0.3
    texts = ["Some words, some W0RDS", None, "", "a", "vilethug vilethug " * 40, "x" * 5000, "é ß 中文 😀", "one\ntwo"]
    got = toxicity.score_texts(texts, toxicity.WordScores(weight), offset)
    for t, s in zip(texts, got):
        z, tokens = offset, toxicity.tokens_of(t)
        for w in tokens:   # each word by itself: the mean of its own subwords' weights
            feats, begin = toxicity.subwords([toxicity.word_of(w)])
            assert begin.tolist() == [0, len(feats)] and len(feats) > 0
            z += float(np.mean(weight[feats].astype(np.float64))) / (len(tokens) + toxicity.SMOOTH) ** 0.5
        assert s == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-6)


def test_toxicity_training_separates_and_lowers_the_loss():
    r = random.Random(4)
    texts = ["good calm words here today" if i % 2 else "vile thug words here today" for i in range(60)]
    texts = [t + " " + r.choice(["red", "blue", "green"]) for t in texts]
    model = toxicity.train(texts, [(i + 1) % 2 for i in range(60)])
    scores = toxicity.score_texts(texts, toxicity.WordScores(model.weight), model.offset)
    assert all((s > 0.5) == (i % 2 == 0) for i, s in enumerate(scores))
    flat = toxicity.score_texts(texts, toxicity.WordScores(model.weight * 0), model.offset)
    loss = lambda p: -np.mean([np.log(x if i % 2 == 0 else 1 - x) for i, x in enumerate(p)])
    assert loss(scores) < 0.5 * loss(flat)


def test_training_codes_few_words_at_a_time(monkeypatch):
    sizes, own = [], toxicity.subwords
    monkeypatch.setattr(toxicity, "TRAIN_CHUNK", 16)
    monkeypatch.setattr(toxicity, "subwords", lambda words: sizes.append(len(words)) or own(words))
    texts = [f"{'foul' if i % 2 else 'fine'} word{i % 40} other{i % 30}" for i in range(120)]
    model = toxicity.train(texts, [i % 2 for i in range(120)])
    assert len(sizes) > 4 and max(sizes) <= 16
    words = toxicity.WordScores(model.weight)
    bad, good = toxicity.score_texts(["foul", "fine"], words, model.offset)
    assert bad > 0.5 > good
