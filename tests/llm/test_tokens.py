"""Operators 1, 2, 10: round trips and brute force."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from shelfsense.llm import common, pieces, token_output, warc
from shelfsense.session import scratch_path
from tests.llm import brute

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "\n", "x.\ny", "it's 12%", "tab\there", "é中😀", "<|endoftext|> end", "a \n b", "_▁_"]


def expected_tokens(rows):
    from tokenizers import Tokenizer
    tok, start, out = Tokenizer.from_file(BPE), 0, []
    for d, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_files_hold_what_the_tokenizer_gives(docs, rows):
    got = token_output.token_output(docs, BPE).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()
    assert [tuple(r) for r in got] == expected_tokens([(r[0], r[1]) for r in rows])


def test_token_files_of_odd_ids_and_empty_tables(odd_ids, empty):
    got = token_output.token_output(odd_ids, BPE).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 4, 4, 4, 5]
    assert got[0].n_tokens == 1  # the null text comes first
    assert token_output.token_output(empty, BPE).collect() == []


def test_piece_cache_equals_whole_texts():
    enc, r = token_output.PieceEncoder(BPE, 2), random.Random(5)
    signs = ["a", "é", " ", "  ", "\n", ".", ",", "'s", "ll", "12", "\t", " ", "ß", "<|endoftext|>", "!", " \n"]
    texts = ODD + ["".join(r.choice(signs) for _ in range(r.randint(0, 25))) for _ in range(500)]
    for t, got in zip(texts, enc.encode(texts)):
        assert np.frombuffer(got, enc.dtype).tolist() == enc.tok.encode(t, add_special_tokens=False).ids + [2]


def test_wide_ids_take_32_bits():
    assert token_output.id_type(65535) == "<u2" and token_output.id_type(65536) == "<u4"


def all_scores(model, text):
    word, out = "".join(pieces.words_of(text)), []
    edges = model.edges(word)

    def walk(j, score):
        if j == 0:
            out.append(score)
        for i, s, _ in edges[j] if j else ():
            walk(i, score + s)

    walk(len(word), 0.0)
    return sorted(out, reverse=True)


def test_n_best_is_exact_and_decodes():
    enc, r = pieces.Encoder(PIECES, 5), random.Random(9)
    signs = ["a", "th", "e", " ", "  ", "é", "中", "\n", "un", "x", "😀"]
    for t in ODD[:11] + ["".join(r.choice(signs) for _ in range(r.randint(0, 8))) for _ in range(150)]:
        ids, score, scores, counts = enc.encode(t)
        want = all_scores(enc.model, t)[:5] if t else [0.0]
        assert scores == pytest.approx(want) and score == scores[0] and counts[0] == len(ids)
        assert enc.model.decode(ids.tolist()) == t.encode()


def test_backward_search_orders_paths():
    """Every path of a small graph comes once, best first."""
    r = random.Random(4)
    edges = [[]] + [[(i, float(r.randint(-9, 0)), (i, j)) for i in range(j)] for j in range(1, 6)]
    paths = []
    for k in range(5):
        for mid in itertools.combinations(range(1, 5), k):
            nodes = [0, *mid, 5]
            paths.append(sum(edges[b][a][1] for a, b in zip(nodes, nodes[1:])))
    found = pieces.search_back(edges, pieces.PieceModel.forward(edges), 100)
    assert [s for s, _ in found] == sorted(paths, reverse=True)


def test_pieces_of_a_table(docs, clashing, empty, odd_ids, rows):
    got = pieces.encode_pieces(docs, PIECES).collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    by = {r.doc_id: r for r in got}
    assert by[0].n_pieces == 0 and by[3].ids == []
    assert all(r.nbest_scores == sorted(r.nbest_scores, reverse=True) for r in got)
    assert pieces.encode_pieces(clashing, PIECES, with_ids=False).count() == len(rows)
    assert pieces.encode_pieces(odd_ids, PIECES).count() == 6 and pieces.encode_pieces(empty, PIECES).collect() == []


PAGES = [(3, "http://a/", "<p>x</p>"), (1, "http://b/", "<p>x</p>"), (2, None, None), (7, "http://c/\r\nX: y", ""),
         (5, "http://d/", "<p>é 中</p>" * 4000), (6, "http://d/", "\r\n\r\nWARC/1.1"), (9, "http://e/", "<p>x</p>")]


def test_warc_round_trip(spark):
    df = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id bigint, url string, html string, payload int")
    got = {r.page_id: r for r in warc.warc_archive(df).collect()}
    want = brute.warc(PAGES)
    assert {i: tuple(r[c] for c in ("payload_bytes", "payload_digest", "record_type", "refers_to")) for i, r in got.items()} == want
    for i, _, h in PAGES:
        assert (bytes(got[i].payload) if got[i].payload is not None else None) == (
            (h or "").encode() if want[i][2] == "response" else None)


def test_warc_smaller_payloads_are_all_responses(spark):
    df = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    got = {r.page_id: r.record_type for r in warc.warc_archive(df, min_revisit_bytes=5).collect()}
    assert got[2] == got[7] == "response" and got[3] == "revisit" and got[1] == "response"


def test_warc_repeated_rows_null_ids_and_no_rows(spark):
    schema = "page_id bigint, url string, html string"
    same = spark.createDataFrame([(4, "u", "h"), (4, "u", "h"), (None, "u", "h"), (None, "u", "h")], schema)
    got = sorted(warc.warc_archive(same).select("record_type", "refers_to").collect())
    assert [tuple(r) for r in got] == [("response", None), ("revisit", 4), ("revisit", 4), ("revisit", 4)]
    assert warc.warc_archive(spark.createDataFrame([], schema)).collect() == []


def test_archive_starts_with_its_dictionary(spark):
    import struct

    import zstandard
    folder = scratch_path(spark, "warc")
    many = spark.createDataFrame([(i, "http://x/%d" % i, "<html><body>page %d</body></html>" % i) for i in range(300)],
                                 "page_id bigint, url string, html string").coalesce(1)
    manifest = warc.write_warc(many, folder).collect()
    assert sum(r.n_records for r in manifest) == 300
    fs, root = warc.filesystem(folder)
    with fs.open_input_stream(f"{root}/{manifest[0].file}") as src:
        magic, size = struct.unpack("<II", src.read(8))
        words = zstandard.ZstdCompressionDict(src.read(size))
        rest = src.read()
    assert magic == 0x184D2A5D
    # Every record is a frame of its own.
    record = zstandard.ZstdDecompressor(dict_data=words).decompressobj().decompress(rest)
    assert record.startswith(b"WARC/1.1\r\n") and record.count(b"WARC-Record-ID") == 1


def test_batches_look_up_a_piece_once():
    """Ids of many texts at once, sliced columns and nulls too; a piece that occurs often is looked up once."""
    enc, r = token_output.PieceEncoder(BPE, 2), random.Random(6)
    texts = [*ODD, None, *(" ".join(r.choice(["one", "two,", "é.", "", "x\ny"]) for _ in range(r.randint(0, 40))) for _ in range(80))]
    ids, n = enc.batch(pa.array(["left out", *texts], pa.string()).slice(1))
    want = [enc.tok.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    assert ids.tolist() == [x for w in want for x in w] and n.tolist() == [len(w) for w in want]
    asked = []

    class Told(dict):
        def __getitem__(self, key):
            asked.append(key)
            return super().__getitem__(key)

        def ready(self, need):
            enc.later.ready(need)
            self.update((k, dict.__getitem__(enc.later, k)) for k in need)

    one = token_output.PieceEncoder(BPE, 2)
    one.later, told = Told(), " ".join(["again"] * 50)
    assert [len(x) for x in one.encode([told] * 3)] == [2 * 51] * 3 and asked == ["again"]
    assert [len(x) for x in enc.batch(pa.array([], pa.string()))] == [0, 0]


def test_smaller_slices_give_the_same_rows(docs):
    """The pipeline's workers keep less and encode less at once; a slice never has more text than allowed, but for one long text."""
    order = ["doc_id", "n_pieces", "score"]
    assert pieces.encode_pieces(docs, PIECES, remember=50, slice_bytes=64).orderBy(order).collect() == \
        pieces.encode_pieces(docs, PIECES).orderBy(order).collect()
    col = pa.array(["a" * 40, "b" * 30, None, "c" * 300, "d"])
    assert list(common.text_slices(col, 1024, 64)) == [(0, 1), (1, 3), (3, 4), (4, 5)]
    assert list(common.text_slices(col, 2, 1000)) == [(0, 2), (2, 4), (4, 5)]


def test_a_task_gives_its_memory_back():
    """What a worker held for a task is free for the system after it, though something allocated later stays."""
    import psutil
    kept, seen = [], []

    def run(batches):
        held = [bytes(1000) for _ in range(100_000)]
        kept.append(bytes(1000))
        seen.append(psutil.Process().memory_info().rss)
        yield from batches
        del held

    assert list(common.returning(run)(iter([1, 2]))) == [1, 2]
    assert seen[0] - psutil.Process().memory_info().rss > 50 << 20
