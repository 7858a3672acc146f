"""SentencePiece encoding and decoding with exact N-best segmentations.

The piece lattice of a text has an edge for every vocabulary piece that fits,
weighted with the score in the model file; a character without a piece of its
own is spelt in byte pieces, each weighted below the lowest score. A forward
Viterbi pass gives the best score from the start to every position. Backward
A-star search starts at the end and extends segmentations to the left; the
forward score of a position is the exact rest cost, so complete ones come off
the queue best first and nothing that can't be among the N best is extended
beyond its last common position.

A piece has white space only at its front, so lattices of white-space separated
words are independent and a text's lattice is their chain. A word's best and
second-best score are computed once and remembered; the N best segmentations of
a text differ from the best one only in N - 1 words of the smallest loss, so
the word lattices of these and the chain of them are searched, nothing else;
the ids found are put between those of the other words.

Tokenizers are not trained here. Tasks are independent of each other: one pass
over the texts, no shuffle, bounded caches.
"""

from __future__ import annotations

import heapq
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.llm import common
from shelfsense.llm.common import enter, returning, text_slices
from shelfsense.llm.token_output import Memo

SPACE = "▁"
#: Segmentations per text; words a worker remembers; how far below the lowest score a byte piece weighs.
NBEST, CACHE_WORDS, BYTE_PENALTY = 4, 250_000, 10.0
NO_START = ()
ROWS = ("doc_id bigint, n_pieces bigint, score double, ids_crc32 bigint, nbest_scores array<double>, "
        "nbest_pieces array<bigint>, nbest_crc32 array<bigint>, nbest_round_trip array<boolean>, round_trip boolean, "
        "ids array<int>, nbest_ids array<array<int>>")


def search_back(edges: list[list[tuple[int, float, object]]], ahead: list[float], n: int) -> list[tuple[float, list]]:
    """The n best paths from the first to the last node, best first.

    ``edges[j]`` lists (from node, score, label) of the edges into node j,
    ``ahead[j]`` is the best score from the first node to j. Of paths of equal
    score the one whose last edge comes first in its list is found first.
    """
    pushed = 0
    queue: list[tuple[float, int, int, float, tuple | None]] = [(-ahead[-1], 0, len(edges) - 1, 0.0, None)]
    out = []
    while queue and len(out) < n:
        _, _, j, behind, path = heapq.heappop(queue)
        if j == 0:
            labels = []
            while path:
                label, path = path
                labels.append(label)
            out.append((behind, labels))
            continue
        for k, score, label in reversed(edges[j]):
            pushed -= 1
            heapq.heappush(queue, (-(ahead[k] + behind + score), pushed, k, behind + score, (label, path)))
    return out


class PieceModel:
    """Vocabulary of a SentencePiece model file and the lattice of a word."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, tuple[int, float]] = {}
        self.bytes: dict[int, int] = {}
        self.raw: list[bytes] = []
        low = 0.0
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            self.raw.append(b"")
            if sp.is_byte(i):
                self.bytes[int(piece[3:-1], 16)] = i
                self.raw[i] = bytes([int(piece[3:-1], 16)])
            elif not (sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i)):
                self.pieces[piece] = (i, sp.get_score(i))
                self.raw[i] = piece.replace(SPACE, " ").encode()
                if sp.get_score(i) > -1e8:
                    low = min(low, sp.get_score(i))
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("the model has pieces with white space inside")
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte pieces")
        #: Every beginning of a piece, so that longer strings need not be tried; the piece itself where it is one.
        self.starts: dict[str, tuple[int, float] | None] = {p[:k]: None for p in self.pieces for k in range(1, len(p))}
        self.starts.update(self.pieces)
        #: Neighbours inside pieces: no piece crosses between any other two characters.
        self.inside = {p[k:k + 2] for p in self.pieces for k in range(len(p) - 1)}
        self.byte_score = low - BYTE_PENALTY
        self.longest = max(map(len, self.pieces))

    def edges(self, word: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """Edges into every position of a word (white space as its sign)."""
        into: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(len(word) + 1)]
        get, n = self.pieces.get, len(word)
        for i in range(n):
            for j in range(i + 1, min(n, i + self.longest) + 1):
                hit = get(word[i:j])
                if hit:
                    into[j].append((i, hit[1], (hit[0],)))
                elif j == i + 1:
                    own = tuple(self.bytes[b] for b in word[i].replace(SPACE, " ").encode())
                    into[j].append((i, self.byte_score * len(own), own))
        return into

    def parts(self, word: str) -> list[str]:
        """The word cut where no piece crosses; the lattices of the parts are independent."""
        if word[1:].isalpha():  # seldom has a cut
            return [word]
        inside, out, a = self.inside, [], 0
        for i in range(1, len(word)):
            if word[i - 1:i + 1] not in inside:
                out.append(word[a:i])
                a = i
        out.append(word[a:])
        return out

    @staticmethod
    def forward(edges: list[list[tuple[int, float, tuple[int, ...]]]]) -> list[float]:
        ahead = [0.0] * len(edges)
        for j in range(1, len(edges)):
            ahead[j] = max(ahead[i] + s for i, s, _ in edges[j])
        return ahead

    def best_two(self, word: str) -> tuple[bytes, float, float]:
        """(ids of the best segmentation as 16-bit integers, its score, loss of the second best)."""
        get, n = self.starts.get, len(word)
        best, second = [-1e300] * (n + 1), [-1e300] * (n + 1)
        back: list[tuple[int, tuple[int, ...] | int]] = [(0, 0)] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            b, s = best[i], second[i]
            for j in range(i + 1, n + 1):
                hit = get(word[i:j], NO_START)
                if hit:
                    own, score = hit
                elif j == i + 1:  # no piece of its own: bytes
                    own = tuple(self.bytes[x] for x in word[i].replace(SPACE, " ").encode())
                    score = self.byte_score * len(own)
                elif hit is None:
                    continue
                else:
                    break
                x, y = b + score, best[j]
                # Of equal scores the edge from furthest left wins, as in search_back.
                if x > y:
                    z = s + score
                    second[j] = y if y > z else z
                    best[j], back[j] = x, (i, own)
                elif x > second[j]:
                    second[j] = x
        ids: list[int] = []
        j = n
        while j:
            i, own = back[j]
            ids += own[::-1] if isinstance(own, tuple) else (own,)
            j = i
        loss = best[n] - second[n] if second[n] > -1e200 else float("inf")
        return array("H", ids[::-1]).tobytes(), best[n], loss

    def n_best(self, word: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a word: (score, ids), best first."""
        edges = self.edges(word)
        return [(s, [x for own in labels for x in own]) for s, labels in search_back(edges, self.forward(edges), n)]

    def decode(self, ids: list[int] | np.ndarray) -> bytes:
        """The text of ids: the pieces' bytes without the blank that encoding puts in front."""
        raw = b"".join(map(self.raw.__getitem__, ids))
        return raw[1:] if raw[:1] == b" " else raw


_RUNS = re.compile(r" *[^ ]+| +$")


def words_of(text: str) -> list[str]:
    """Words with the white space before them, after a blank was put in front."""
    if not text:
        return []
    if text[0] == " " or "  " in text or text[-1] == " ":
        return [w.replace(" ", SPACE) for w in _RUNS.findall(" " + text)]
    return [SPACE + w for w in text.split(" ")]


class Lattices:
    """Forward Viterbi over many words at once.

    Words of similar length form a matrix of characters; a substring is looked up by its hash in the
    sorted hashes of all pieces, for all words of the matrix in one step.
    """

    SIEVE = 20
    WORDS = 4096
    #: Longer words are cut into parts and searched one by one.
    LONGEST = 48

    def __init__(self, model: PieceModel):
        self.model = model
        names = list(model.pieces)
        value = np.array([model.pieces[p] for p in names], np.float64)
        chars = np.frombuffer("".join(names).encode("utf-32-le"), np.uint32)
        size = np.array([len(p) for p in names])
        up = common.powers(common.BASE_W, max(self.LONGEST, model.longest))[0]
        self.down = common.powers(common.BASE_W, self.LONGEST)[1]
        first = np.repeat(np.cumsum(size) - size, size)
        h = np.add.reduceat(self._sign(chars) * up[np.arange(len(chars)) - first], np.cumsum(size) - size, dtype=np.uint64)
        order = np.argsort(h)
        self.known, self.ids, self.scores = h[order], value[order, 0].astype(np.int32), value[order, 1]
        if (self.known[1:] == self.known[:-1]).any():
            raise ValueError("two pieces have one hash")
        self.sieve = np.zeros(1 << self.SIEVE, bool)
        self.sieve[self.known >> np.uint64(64 - self.SIEVE)] = True
        self.up = up

    @staticmethod
    def _sign(chars: np.ndarray) -> np.ndarray:
        return common.mix(chars.astype(np.uint64) + np.uint64(0x51ED))

    def best(self, words: list[str]) -> list[tuple[bytes, float, float]]:
        """Per word: ids of the best segmentation as 16-bit integers, its score, loss of the second best."""
        out: list = [None] * len(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(size, kind="stable")
        for i in order[np.searchsorted(size[order], self.LONGEST, "right"):].tolist():
            out[i] = self._in_parts(words[i])
        order = order[:np.searchsorted(size[order], self.LONGEST, "right")]
        for lo in range(0, len(order), self.WORDS):
            rows = order[lo:lo + self.WORDS]
            for i, found in zip(rows.tolist(), self._matrix([words[i] for i in rows.tolist()], size[rows])):
                out[i] = found
        return out

    def _in_parts(self, word: str) -> tuple[bytes, float, float]:
        ids, scores, losses = zip(*map(self.model.best_two, self.model.parts(word)))
        return b"".join(ids), sum(scores), min(losses)

    def _matrix(self, words: list[str], size: np.ndarray) -> list[tuple[bytes, float, float]]:
        """Words in order of length, each of at least one character."""
        n, longest = len(words), int(size[-1])
        chars = np.zeros((n, longest), np.uint32)
        chars[np.arange(longest) < size[:, None]] = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        run = np.zeros((longest + 1, n), np.uint64)
        np.cumsum(self._sign(chars.T) * self.up[:longest, None], axis=0, dtype=np.uint64, out=run[1:])
        best, second = np.full((longest + 1, n), -1e300), np.full((longest + 1, n), -1e300)
        best[0] = 0.0
        back, code = np.zeros((longest + 1, n), np.int16), np.zeros((longest + 1, n), np.int32)
        begin = np.searchsorted(size, np.arange(longest + 1))  # the words that have so many characters
        for j in range(1, longest + 1):
            for i in range(max(0, j - self.model.longest), j):
                a = begin[j]
                h = (run[j, a:] - run[i, a:]) * self.down[i]
                rows = np.flatnonzero(self.sieve[h >> np.uint64(64 - self.SIEVE)])
                h = h[rows]
                at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
                hit = self.known[at] == h
                rows, at = rows[hit] + a, at[hit]
                score, own = self.scores[at], self.ids[at]
                if j == i + 1 and len(rows) < n - a:  # characters without a piece are spelt in bytes
                    rest = np.ones(n - a, bool)
                    rest[rows - a] = False
                    bare = np.flatnonzero(rest) + a
                    c = chars[bare, i]
                    width = 1 + (c > 0x7F).astype(np.int64) + (c > 0x7FF) + (c > 0xFFFF)
                    width[c == ord(SPACE)] = 1
                    rows = np.concatenate([rows, bare])
                    score = np.concatenate([score, self.model.byte_score * width])
                    own = np.concatenate([own, -1 - c.astype(np.int32)])
                if not len(rows):
                    continue
                x, y = best[i, rows] + score, best[j, rows]
                # Of equal scores the edge from furthest left wins, as in search_back.
                won = x > y
                second[j, rows] = np.where(won, np.maximum(y, second[i, rows] + score), np.maximum(second[j, rows], x))
                rows, x, own = rows[won], x[won], own[won]
                best[j, rows], back[j, rows], code[j, rows] = x, i, own
        pos, count, rows = size.copy(), np.zeros(n, np.int64), np.arange(n)
        ids = np.zeros((n, longest), np.int32)
        while len(rows):
            at = pos[rows]
            ids[rows, longest - 1 - count[rows]] = code[at, rows]
            count[rows] += 1
            pos[rows] = back[at, rows]
            rows = rows[pos[rows] > 0]
        last = best[size, np.arange(n)]
        behind = second[size, np.arange(n)]
        loss = np.where(behind > -1e200, last - behind, np.inf)
        spelt = (ids < 0).any(axis=1).tolist()
        narrow = ids.astype(np.uint16)
        return [(self._spell(ids[r, longest - c:]) if odd else narrow[r, longest - c:].tobytes(), s, x)
                for r, (c, odd, s, x) in enumerate(zip(count.tolist(), spelt, last.tolist(), loss.tolist()))]

    def _spell(self, codes: np.ndarray) -> bytes:
        out: list[int] = []
        for c in codes.tolist():
            out += [c] if c >= 0 else [self.model.bytes[b] for b in chr(-1 - c).replace(SPACE, " ").encode()]
        return array("H", out).tobytes()


class Slice:
    """The N best segmentations of a batch of texts, in flat arrays.

    ``ids`` are those of all segmentations of all texts, text by text, best first;
    segmentation k of all has ``ids[at[k]:at[k + 1]]``, score ``scores[k]`` and decodes to its text if ``same[k]``; text t
    has the segmentations from ``first[t]`` to ``first[t + 1]``.
    """

    def __init__(self, ids: np.ndarray, at: np.ndarray, scores: list[float], same: list[bool], first: np.ndarray):
        self.ids, self.at, self.scores, self.same, self.first = ids, at, scores, same, first


class Encoder:
    """Whole texts to their N best segmentations, with what is known of words kept."""

    def __init__(self, path: str, n: int, remember: int = CACHE_WORDS):
        if sys.byteorder != "little" or array("H").itemsize != 2:
            raise RuntimeError("ids are kept as 16-bit little-endian integers")
        self.model, self.n = PieceModel(path), n
        self.lattices = Lattices(self.model)
        self.known = Memo(self.lattices.best, remember)
        self.lists = Memo(self._alternatives, CACHE_WORDS // 20)
        size = np.fromiter(map(len, self.model.raw), np.int64, len(self.model.raw))
        self.raw_size, self.raw_end = size, np.cumsum(size)
        self.raw = np.frombuffer(b"".join(self.model.raw), np.uint8)

    def _alternatives(self, words: list[str]) -> list[list[tuple[float, bytes, bool]]]:
        """The n best of every word: score, ids, and whether they decode to the word."""
        out = []
        for w in words:
            text = w.replace(SPACE, " ").encode()
            out.append([(s, array("H", x).tobytes(), b"".join(map(self.model.raw.__getitem__, x)) == text)
                        for s, x in self.model.n_best(w, self.n)])
        return out

    def _words(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct words of the texts, each occurrence's number in them, and the first occurrence of every text."""
        col = pa.array(texts, pa.large_string())
        odd = pc.or_(pc.or_(pc.starts_with(col, " "), pc.ends_with(col, " ")),
                     pc.or_(pc.match_substring(col, "  "), pc.match_substring(col, SPACE)))
        irregular = np.flatnonzero(odd.to_numpy(zero_copy_only=False) | (pc.binary_length(col).to_numpy() == 0))
        if len(irregular):  # their words are found one by one; an empty text has none
            own = [[w[1:] for w in words_of(texts[i].replace(SPACE, " "))] for i in irregular.tolist()]
            keep = np.ones(len(texts), bool)
            keep[irregular] = False
            split = pc.split_pattern(col.filter(pa.array(keep)), " ")
            size = np.zeros(len(texts), np.int64)
            size[keep], size[irregular] = split.value_lengths().to_numpy(), [len(x) for x in own]
            first = np.concatenate([[0], np.cumsum(size)])
            flat = pa.concat_arrays([split.flatten(), pa.array([w for x in own for w in x], pa.large_string())])
            coded = flat.dictionary_encode()
            regular = np.repeat(keep, size)
            word = np.empty(len(flat), np.int64)
            n = int(size[keep].sum())
            word[regular], word[~regular] = coded.indices.to_numpy()[:n], coded.indices.to_numpy()[n:]
        else:
            split = pc.split_pattern(col, " ")
            first = np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy())])
            coded = split.flatten().dictionary_encode()
            word = coded.indices.to_numpy().astype(np.int64)
        return [SPACE + w for w in coded.dictionary.to_pylist()], word, first

    def batch(self, texts: list[str | None]) -> Slice:
        """All segmentations of a batch; a missing text is an empty one."""
        full = [t or "" for t in texts]
        names, word, first = self._words(full)
        self.known.ready(set(names))
        own_ids, own_scores, losses = zip(*map(self.known.__getitem__, names)) if names else ((), (), ())
        own = np.frombuffer(b"".join(own_ids), "<u2")
        size = np.fromiter(map(len, own_ids), np.int64, len(names)) // 2
        begin = np.cumsum(size) - size
        loss = np.array(losses, np.float64)[word]
        score = np.concatenate([[0.0], np.cumsum(np.array(own_scores, np.float64)[word])])
        # The best segmentation of everything, one word after the other.
        length = size[word]
        end = np.concatenate([[0], np.cumsum(length)])
        best = own[np.repeat(begin[word] - end[:-1], length) + np.arange(end[-1])]
        round_trip = self._decodes(best, end[first], full)
        parts: list[bytes] = []
        sizes: list[int] = []
        scores: list[float] = []
        same: list[bool] = []
        count: list[int] = []
        raw, few_of = best.tobytes(), self._least(loss, first)
        self.lists.ready({names[word[k]] for few in few_of for k in few})
        for t, few in enumerate(few_of):
            a, b, ok = int(end[first[t]]), int(end[first[t + 1]]), round_trip[t]
            total = float(score[first[t + 1]] - score[first[t]])
            # What stands between the words of the smallest loss is the same in all segmentations.
            chain: list[list[tuple[int, float, object]]] = [[]]
            cuts = [2 * a]
            for k, at in enumerate(few):
                own_lists = self.lists[names[word[at]]]
                chain.append([(k, s - own_lists[0][0], (x, fine)) for s, x, fine in own_lists])
                cuts += [2 * int(end[at]), 2 * int(end[at + 1])]
            cuts.append(2 * b)
            between = [raw[x:y] for x, y in zip(cuts[::2], cuts[1::2])]
            found = search_back(chain, [0.0] * len(chain), self.n)
            for s, path in found:
                ids = b"".join([between[0], *(x for (y, _), z in zip(path, between[1:]) for x in (y, z))])
                parts.append(ids)
                sizes.append(len(ids) // 2)
                scores.append(total + s)
                same.append(ok and all(fine for _, fine in path))
            count.append(len(found))
        return Slice(np.frombuffer(b"".join(parts), "<u2"), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), scores, same,
                     np.concatenate([[0], np.cumsum(count)]).astype(np.int64))

    def _least(self, loss: np.ndarray, first: np.ndarray) -> list[list[int]]:
        """Per text the words of the smallest loss, in order of place; of equal losses the first words."""
        out, n = [], max(1, self.n - 1)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            own = loss[a:b]
            if b - a > 4 * n:  # only what does not exceed the n-th loss can be among them
                near = np.flatnonzero(own <= np.partition(own, n - 1)[n - 1])
                near = near[np.argsort(own[near], kind="stable")[:n]]
            else:
                near = np.argsort(own, kind="stable")[:n]
            out.append(sorted((near + a).tolist()))
        return out

    def _decodes(self, ids: np.ndarray, at: np.ndarray, texts: list[str]) -> list[bool]:
        """For every text: do its ids decode to it?"""
        size = self.raw_size[ids]
        end = np.concatenate([[0], np.cumsum(size)])
        raw = self.raw[np.repeat(self.raw_end[ids] - size - end[:-1], size) + np.arange(end[-1])].tobytes()
        out = []
        for a, b, t in zip(end[at[:-1]].tolist(), end[at[1:]].tolist(), texts):
            got = raw[a:b]
            # Without the blank that encoding puts in front.
            out.append((got[1:] if got[:1] == b" " else got) == t.replace(SPACE, " ").encode())
        return out

    def segmentations(self, text: str | None) -> list[tuple[float, np.ndarray]]:
        """The n best segmentations of a text: (score, ids), best first."""
        s = self.batch([text])
        return [(score, s.ids[a:b]) for score, a, b in zip(s.scores, s.at[:-1], s.at[1:])]

    def encode(self, text: str | None) -> tuple[np.ndarray, float, list[float], list[int]]:
        """Ids of the best segmentation, its score, scores and piece counts of the n best."""
        found = self.segmentations(text)
        return found[0][1], found[0][0], [s for s, _ in found], [len(ids) for _, ids in found]


_encoders: dict[tuple[str, int, int], Encoder] = common.remember({})


def encoder(path: str, n: int, remember: int = CACHE_WORDS) -> Encoder:
    """This worker process's encoder; tasks that follow find its caches filled."""
    enter("pieces")
    if (path, n, remember) not in _encoders:
        _encoders[path, n, remember] = Encoder(path, n, remember)
    return _encoders[path, n, remember]


#: Texts and bytes of text encoded at once.
SLICE_TEXTS, SLICE_TEXT_BYTES = 1024, 2 << 20


def encode_pieces(docs: DataFrame, model: str, n: int = NBEST, with_ids: bool = True,
                  remember: int = CACHE_WORDS, slice_bytes: int = SLICE_TEXT_BYTES) -> DataFrame:
    """Encode every whole text, decode it again; one row per row of ``docs``.

    ``remember`` is the number of words a worker keeps (about 200 bytes each), ``slice_bytes`` the text it encodes at
    once (it takes some 60 times as much); smaller ones take less memory and more time, the rows are the same.

    ``score`` and ``ids`` are the best segmentation's; ``nbest_ids``, their numbers
    ``nbest_pieces``, checksums ``nbest_crc32`` and ``nbest_scores`` belong to the n best
    ones (fewer where a text has fewer). ``round_trip`` and ``nbest_round_trip`` say that the
    decoded ids give the text. Without ``with_ids`` the two columns of ids are left out. The sign for white space itself counts as a
    blank, as in the model's own normalisation. Null and empty texts have one
    segmentation without pieces. Repeated rows are encoded alike, an empty table
    gives an empty result, columns other than ``doc_id`` and ``text`` are not read.
    """
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model, n, remember)
        schema = pa.schema([("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("score", pa.float64()),
                            ("ids_crc32", pa.int64()), ("nbest_scores", pa.list_(pa.float64())),
                            ("nbest_pieces", pa.list_(pa.int64())), ("nbest_crc32", pa.list_(pa.int64())),
                            ("nbest_round_trip", pa.list_(pa.bool_())), ("round_trip", pa.bool_()),
                            ("ids", pa.list_(pa.int32())), ("nbest_ids", pa.list_(pa.list_(pa.int32())))])
        for b in batches:
            for lo, hi in text_slices(b.column(1), SLICE_TEXTS, slice_bytes):
                got = enc.batch(b.column(1).slice(lo, hi - lo).to_pylist())
                first, wide = got.first, got.ids.astype(np.int32)
                pieces, lead = np.diff(got.at), got.first[:-1]
                crc = np.fromiter((zlib.crc32(wide[x:y]) for x, y in zip(got.at[:-1].tolist(), got.at[1:].tolist())),
                                  np.int64, len(pieces))
                scores, same = np.array(got.scores), np.array(got.same, bool)
                own = pa.array(first.astype(np.int32))
                columns = [pa.array(pieces[lead]), pa.array(scores[lead]), pa.array(crc[lead]),
                           pa.ListArray.from_arrays(own, pa.array(scores)), pa.ListArray.from_arrays(own, pa.array(pieces)),
                           pa.ListArray.from_arrays(own, pa.array(crc)), pa.ListArray.from_arrays(own, pa.array(same)),
                           pa.array(same[lead])]
                if with_ids:
                    every = pa.ListArray.from_arrays(pa.array(got.at.astype(np.int32)), pa.array(wide))
                    columns += [every.take(pa.array(lead)), pa.ListArray.from_arrays(own, every)]
                else:
                    columns += [pa.nulls(hi - lo, f.type) for f in list(schema)[-2:]]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), *columns], schema=schema)

    out = d.mapInArrow(returning(run), ROWS)
    return out if with_ids else out.drop("ids", "nbest_ids")
