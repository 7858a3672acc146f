"""Operator 1: the N best segmentations themselves."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from shelfsense.llm import catalog, pieces
from tests.llm.test_tokens import ODD

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def all_segmentations(model, text):
    """ids -> score of every path through the whole text's lattice."""
    word, out = "".join(pieces.words_of(text)), {}
    edges = model.edges(word)

    def walk(j, score, ids):
        if j == 0:
            out[ids] = score
        for i, s, own in edges[j] if j else ():
            walk(i, score + s, own + ids)

    walk(len(word), 0.0, ())
    return out


def test_every_segmentation_is_given_and_decodes():
    enc, r = pieces.Encoder(PIECES, 5), random.Random(11)
    signs = ["a", "th", "e", " ", "  ", "é", "中", "\n", "un", "x", "😀"]
    for t in ODD[:11] + ["".join(r.choice(signs) for _ in range(r.randint(0, 8))) for _ in range(150)]:
        found, every = enc.segmentations(t), all_segmentations(enc.model, t)
        assert len(found) == min(5, len(every)) == len({tuple(ids.tolist()) for _, ids in found})
        assert [s for s, _ in found] == pytest.approx(sorted(every.values(), reverse=True)[:5])
        for s, ids in found:
            assert every[tuple(ids.tolist())] == pytest.approx(s) and enc.model.decode(ids.tolist()) == t.encode()


def test_table_has_the_ids_of_all_segmentations(docs, empty):
    for r in pieces.encode_pieces(docs, PIECES).collect():
        assert r.ids == r.nbest_ids[0] and r.round_trip and all(r.nbest_round_trip)
        assert [len(x) for x in r.nbest_ids] == r.nbest_pieces and len(r.nbest_ids) == len(r.nbest_scores)
        assert [zlib.crc32(np.array(x, "<u4")) for x in r.nbest_ids] == r.nbest_crc32 and r.nbest_crc32[0] == r.ids_crc32
    checked = pieces.encode_pieces(docs, PIECES, with_ids=False)
    assert "nbest_crc32" in checked.columns and "nbest_ids" not in checked.columns
    assert pieces.encode_pieces(empty, PIECES).collect() == []


def test_query_returns_segmentations(spark):
    r = catalog.QUERIES["op1_sentencepiece"](spark, "/root/testdata/sf0.001").filter("n_pieces > 9").first()
    assert len(r.ids) == r.n_pieces and [len(x) for x in r.nbest_ids] == r.nbest_pieces and len(r.nbest_ids) == 4
