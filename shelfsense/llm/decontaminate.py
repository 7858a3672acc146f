"""Benchmark decontamination with a generalised suffix automaton.

All normalised test items (lower-cased A-Z, words of letters, digits and
non-ASCII characters) go into one suffix automaton over word numbers. Training
words are streamed through it: a state and the length of the longest match
that ends here. A match of at least ``WINDOW`` words is an occurrence of an item's
window; an item with fewer words is one window, found where the match
reaches its whole length.

Before streaming, a slice of texts is reduced with numpy to the runs in which
every two neighbouring words are neighbours in some item; a match can't leave
such a run, so the automaton sees all that can matter and nothing else.

The automaton is broadcast. Its size is bounded in bytes: a word of an item makes at most two states and takes at
most ``WORD_BYTES``, items are put in blocks of at most ``BLOCK_BYTES``, and every block is one pass over the
texts, so a large benchmark costs passes, not memory; the passes' hits are united per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.llm.common import (ALNUM_WORD, LOWER, U, keyed, materialise, mix, returning, slices, with_text,
                                   word_bounds, word_hashes)

#: Words of a window.
WINDOW = 13
#: Bytes of a broadcast automaton, and of one word in it (measured: 840 at most while it is built).
BLOCK_BYTES, WORD_BYTES = 160 << 20, 900
BLOCK_WORDS = BLOCK_BYTES // WORD_BYTES
#: Rejected from this share of words hit: n_hit * COVERAGE >= n_words.
COVERAGE = 20


def normal_words(text: str | None) -> list[bytes]:
    """The words of a text as the automaton sees them."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    if not len(raw):
        return []
    s, e, _ = word_bounds(raw, np.array([0, len(raw)]), ALNUM_WORD)
    low = LOWER[raw].tobytes()
    return [low[a:b] for a, b in zip(s, e)]


@dataclass
class Automaton:
    """Suffix automaton of several word sequences; ``items`` and ``short`` tell whose windows end in a state."""

    window: int
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    items: list[set[int]] = field(default_factory=lambda: [set()])
    short: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    pairs: set[tuple[int, int]] = field(default_factory=set)
    shortest: int = 1 << 30

    def _state(self, length: int, link: int, step: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        self.items.append(set())
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A state for the words of q that are one longer than p's longest."""
        new = self._state(self.length[p] + 1, self.link[q], dict(self.step[q]))
        self.link[q] = new
        while p != -1 and self.step[p].get(c) == q:
            self.step[p][c] = new
            p = self.link[p]
        return new

    def _extend(self, last: int, c: int) -> int:
        q = self.step[last].get(c)
        if q is not None:  # another item has this prefix already
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        cur, p = self._state(self.length[last] + 1, 0, {}), last
        while p != -1 and c not in self.step[p]:
            self.step[p][c] = cur
            p = self.link[p]
        if p != -1:
            q = self.step[p][c]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return cur

    def add(self, words: list[bytes]) -> None:
        last, ids = 0, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
        for c in ids:
            last = self._extend(last, c)
        self.pairs.update(zip(ids, ids[1:]))
        if ids:
            self.shortest = min(self.shortest, len(ids), self.window)

    def mark(self, item: int, words: list[bytes]) -> None:
        """After all items are added: note the states in which this item's windows end."""
        ids = [self.vocabulary[w] for w in words]
        state, n = 0, 0
        for c in ids:
            state, n = self.step[state][c], n + 1
            u = state
            # Substrings of the window's length and more live in this state and up its links.
            while len(ids) >= self.window and u > 0 and self.length[u] >= self.window and item not in self.items[u]:
                self.items[u].add(item)
                u = self.link[u]
        if 0 < len(ids) < self.window:
            while self.length[self.link[state]] >= len(ids):
                state = self.link[state]
            self.short.setdefault(state, []).append((len(ids), item))

    def matches(self, ids: list[int]) -> Iterator[tuple[int, int, list[int]]]:
        """(end, length, items) of the window occurrences in a run of word numbers."""
        step, link, length, window = self.step, self.link, self.length, self.window
        v = n = 0
        for j, c in enumerate(ids):
            while v and c not in step[v]:
                v = link[v]
                n = length[v]
            v = step[v].get(c, 0)
            n = n + 1 if v else 0
            if n >= window:
                u = v
                while length[link[u]] >= window:
                    u = link[u]
                yield j + 1, window, list(self.items[u])
            if self.short:
                u = v
                while u > 0:
                    for size, item in self.short.get(u, ()):
                        if size <= n:
                            yield j + 1, size, [item]
                    u = link[u]


def build_automaton(items: list[tuple[int, str | None]], window: int = WINDOW) -> Automaton:
    auto, words = Automaton(window), [(i, normal_words(t)) for i, t in items]
    for _, w in words:
        auto.add(w)
    for i, w in words:
        auto.mark(i, w)
    return auto


class Scanner:
    """Streams slices of texts through an automaton."""

    def __init__(self, auto: Automaton):
        self.auto = auto
        raw = b"".join(auto.vocabulary)
        size = np.fromiter(map(len, auto.vocabulary), np.int64, len(auto.vocabulary))
        end = np.cumsum(size)
        h = word_hashes(np.frombuffer(raw, np.uint8), end - size, end) if len(size) else np.zeros(0, U)
        order = np.argsort(h)
        self.known, self.number = h[order], order
        p = np.array(sorted(auto.pairs), np.int64).reshape(-1, 2).astype(U)
        self.pairs = np.sort(mix((p[:, 0] << U(32)) | p[:, 1]))
        self.single = auto.shortest == 1

    def scan(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]], list[set[int]]]:
        """Per row: words; hit ranges (row, first, end) in words of the row; items found."""
        n = len(off) - 1
        s, e, first = word_bounds(buf, off, ALNUM_WORD)
        items: list[set[int]] = [set() for _ in range(n)]
        hits: list[tuple[int, int, int]] = []
        if len(s) and len(self.known):
            h = word_hashes(buf, s, e, LOWER)
            at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
            ids = np.where(self.known[at] == h, self.number[at], -1)
            row = np.repeat(np.arange(n), np.diff(first))
            joined = np.zeros(len(s), bool)  # to the word before
            both = (ids[1:] >= 0) & (ids[:-1] >= 0) & (row[1:] == row[:-1])
            k = np.flatnonzero(both)
            if len(k) and len(self.pairs):
                p = mix((ids[k].astype(U) << U(32)) | ids[k + 1].astype(U))
                q = np.minimum(np.searchsorted(self.pairs, p), len(self.pairs) - 1)
                joined[k[self.pairs[q] == p] + 1] = True
            begin = np.flatnonzero(~joined)
            size = np.diff(np.r_[begin, len(s)])
            for a, m in zip(begin[size >= self.auto.shortest].tolist(), size[size >= self.auto.shortest].tolist()):
                if ids[a] < 0:
                    continue
                r = int(row[a])
                base = a - int(first[r])
                for end, length, found in self.auto.matches(ids[a:a + m].tolist()):
                    hits.append((r, base + end - length, base + end))
                    items[r].update(found)
        return np.diff(first), hits, items


def merge_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[int, str | None]]]:
    """The items in blocks of bounded size; only one block is on the driver at a time."""
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    block, size = [], 0
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        n = len(normal_words(r.text))
        if block and size + n > block_words:
            yield block
            block, size = [], 0
        block.append((r.item_id, r.text))
        size += n
    if block:
        yield block


FOUND = "key bigint, doc_id bigint, n_words bigint, starts array<int>, ends array<int>, items array<bigint>"


def find_windows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS,
                 is_keyed: bool = False) -> DataFrame:
    """Per document: words, ranges of words inside item windows, ids of the items found.

    Null texts and items have no words and match nothing. Repeated rows and ids
    are documents of their own; items of equal id count once. An empty
    benchmark hits nothing.
    """
    d = docs if is_keyed else keyed(docs)
    passes = []
    for block in blocks(benchmark, block_words):
        # A null item id has no name to report; its windows still hit.
        auto = build_automaton([(-(1 << 62) if i is None else i, t) for i, t in block], window)
        shared = d.sparkSession.sparkContext.broadcast(auto)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            scanner = Scanner(shared.value)
            for b in batches:
                for lo, hi, buf, off in slices(b.column(2)):
                    words, hits, items = scanner.scan(buf, off)
                    ranges: list[list[tuple[int, int]]] = [[] for _ in range(hi - lo)]
                    for r, x, y in hits:
                        ranges[r].append((x, y))
                    ranges = [merge_ranges(x) for x in ranges]
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), pa.array(words.astype(np.int64)),
                         pa.array([[x for x, _ in r] for r in ranges], pa.list_(pa.int32())),
                         pa.array([[y for _, y in r] for r in ranges], pa.list_(pa.int32())),
                         pa.array([sorted(x) for x in items], pa.list_(pa.int64()))],
                        ["key", "doc_id", "n_words", "starts", "ends", "items"])

        passes.append(d.mapInArrow(returning(scan), FOUND))
    if not passes:
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for lo, hi, buf, off in slices(b.column(2)):
                    first = word_bounds(buf, off, ALNUM_WORD)[2]
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo),
                                                      pa.array(np.diff(first).astype(np.int64))], ["key", "doc_id", "n_words"])
        counted = d.mapInArrow(returning(count), "key bigint, doc_id bigint, n_words bigint")
        return counted.select("*", F.expr("cast(array() AS array<int>)").alias("starts"),
                              F.expr("cast(array() AS array<int>)").alias("ends"),
                              F.expr("cast(array() AS array<bigint>)").alias("items"))
    if len(passes) == 1:
        return passes[0]
    # Several blocks: each pass is written; rows of a document are united (one per pass).
    united = None
    for i, p in enumerate(passes):
        p = materialise(p, f"windows-{i}")
        united = p if united is None else united.unionAll(p)
    return united.groupBy("key").agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))


def item_list_digest(ids: list[int]) -> str:
    return hashlib.sha256(",".join(sorted(str(i) for i in ids if i != -(1 << 62))).encode()).hexdigest()


def contamination(docs: DataFrame, benchmark: DataFrame, **options: int) -> DataFrame:
    """Per document: ``n_words, n_hit, n_items, items_sha256, contaminated`` and the ranges hit."""
    found = find_windows(docs, benchmark, **options)
    ranges = F.array_sort(F.arrays_zip("starts", "ends"))
    # Ranges of several passes may overlap: each counts what lies beyond the ones before.
    hit = F.expr("""aggregate(ranges, named_struct('n', 0L, 'upto', 0),
        (a, r) -> named_struct('n', a.n + greatest(r.ends - greatest(r.starts, a.upto), 0), 'upto', greatest(a.upto, r.ends)),
        a -> a.n)""")
    named = F.expr(f"filter(items, x -> x <> {-(1 << 62)}L)")
    return (found.select("key", "doc_id", "n_words", ranges.alias("ranges"), named.alias("items"))
            .select("key", "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                    F.sha2(F.concat_ws(",", F.sort_array(F.transform("items", lambda x: x.cast("string")))), 256)
                    .alias("items_sha256"), "ranges")
            .withColumn("contaminated", (F.col("n_hit") > 0) & (COVERAGE * F.col("n_hit") >= F.col("n_words"))))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options: int) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated, without the words hit.

    A document over the coverage limit goes; in the others the hit words, with
    what stands between them, are cut from the text (and ``n_chars`` follows).
    Texts without a hit stay as they are, character by character.
    """
    d = keyed(docs, carry=True)
    hit = materialise(contamination(d.select("key", "doc_id", "text"), benchmark, is_keyed=True, **options)
                      .filter("n_hit > 0").select("key", "ranges", "contaminated"), "hit")

    @F.arrow_udf("string")
    def cut(text: pa.Array, ranges: pa.Array) -> pa.Array:
        out = []
        for t, r in zip(text, ranges):
            if not r.is_valid or not t.is_valid:
                out.append(t.as_py())
                continue
            raw = t.as_buffer().to_pybytes()
            s, e, _ = word_bounds(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), ALNUM_WORD)
            spans = merge_ranges([(x["starts"], x["ends"]) for x in r.as_py()])
            edges = [0, *(y for a, z in spans for y in (int(s[a]), int(e[z - 1]))), len(raw)]
            out.append(b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2])).decode())
        return pa.array(out, pa.string())

    left = d.join(hit.hint("merge"), "key", "left").filter("contaminated IS NULL OR NOT contaminated")
    return with_text(left, docs, cut("text", "ranges"))
