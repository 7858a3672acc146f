"""Ranked lexical search of all documents, term at a time with a limited number of accumulators.

Terms are runs of ASCII letters and digits and of non-ASCII characters, A-Z
lower-cased. Three passes, each over whole tables:

1. Every document is reduced to its length and the frequencies of the terms
   that occur in some item (the forward index of these terms; it is written).
2. Grouped counts over the index give the number of documents, their total
   length and every term's document frequency, hence its weight.
3. Every batch of index rows is inverted in its task and scored for all items.
   An item's terms are taken rarest first. While the bounds of the terms that
   are left (weight times the largest impact in the batch) can lift a new document
   to the k-th best score known - of partial scores in this batch or of whole scores
   seen earlier in the task - postings create accumulators. After that none is
   created, but those that can still reach this score are updated with all
   remaining terms, so their scores are exact. A document without an
   accumulator scores less than k others, so none is lost.

The best ``k`` of every task meet in one ranking per item. Items are taken in
blocks of at most ``BLOCK_TERMS`` (item, term) pairs, as terms and weights of a block are
broadcast (at most 24 bytes a pair); every further block costs a pass over the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfsense.llm.common import ALNUM_WORD, LOWER, U, materialise, slices, word_bounds, word_hashes

#: Documents returned per item.
K = 10
#: (item, term) pairs per broadcast block; postings scored at once in a task.
BLOCK_TERMS, SLICE_POSTINGS = 1_000_000, 4_000_000
#: Bits of a term hash that tell most other words apart before the search in the term list.
SIEVE_BITS = 20


@dataclass
class Block:
    """The terms of some items: sorted hashes, and per item the places of its terms in them."""

    first: int
    item_ids: list[int | None]
    known: np.ndarray
    terms: list[np.ndarray]
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    df: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    n_docs: int = 0
    n_terms: int = 0

    def weigh(self, df: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int) -> None:
        """Take the corpus statistics over; every item's terms are put rarest first."""
        self.df, self.weight, self.n_docs, self.n_terms = df, weight, n_docs, n_terms
        self.terms = [t[np.lexsort((t, df[t]))] for t in self.terms]


def term_hashes(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's terms."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    s, e, _ = word_bounds(raw, np.array([0, len(raw)]), ALNUM_WORD)
    return np.unique(word_hashes(raw, s, e, LOWER)) if len(s) else np.zeros(0, U)


def blocks(items: DataFrame, block_terms: int = BLOCK_TERMS) -> Iterator[Block]:
    """The items in order of id, in blocks of bounded size; one block at a time is on the driver."""
    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    ids: list[int | None] = []
    hashes: list[np.ndarray] = []
    first = 0

    def block() -> Block:
        known = np.unique(np.concatenate(hashes))
        return Block(first, ids, known, [np.searchsorted(known, h) for h in hashes])

    for r in rows.orderBy("item_id", "text").toLocalIterator():
        h = term_hashes(r.text)
        if ids and sum(map(len, hashes)) + len(h) > block_terms:
            yield block()
            first, ids, hashes = first + len(ids), [], []
        ids.append(r.item_id)
        hashes.append(h)
    if ids:
        yield block()


# ------------------------------------------------------------------ index
INDEX = "doc_id bigint, n bigint, terms array<int>, tfs array<int>"


def index_slice(buf: np.ndarray, off: np.ndarray, known: np.ndarray,
                sieve: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per row its number of terms and the end of its postings; term numbers and frequencies of all rows."""
    s, e, first = word_bounds(buf, off, ALNUM_WORD)
    n = len(off) - 1
    if not len(s) or not len(known):
        return np.diff(first), np.zeros(n, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = word_hashes(buf, s, e, LOWER)
    some = np.flatnonzero(sieve[h >> U(64 - SIEVE_BITS)])
    at = np.minimum(np.searchsorted(known, h[some]), len(known) - 1)
    hit = known[at] == h[some]
    row = np.searchsorted(first, some[hit], "right") - 1
    code, tf = np.unique(row * len(known) + at[hit], return_counts=True)
    return np.diff(first), np.searchsorted(code, (np.arange(n) + 1) * len(known)), code % len(known), tf


def forward_index(docs: DataFrame, block: Block) -> DataFrame:
    """``doc_id``, length in terms, and numbers and frequencies of the block's terms, for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(block.known)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        sieve = np.zeros(1 << SIEVE_BITS, bool)
        sieve[known >> U(64 - SIEVE_BITS)] = True
        for b in batches:
            for lo, hi, buf, off in slices(b.column(1)):
                n, end, terms, tfs = index_slice(buf, off, known, sieve)
                at = pa.array(np.r_[0, end], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())),
                     pa.ListArray.from_arrays(at, pa.array(tfs, pa.int32()))], ["doc_id", "n", "terms", "tfs"])

    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(index, INDEX)


# ------------------------------------------------------------------ search
class Best:
    """The best k documents of every item so far: by score, then by id, null ids last."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
        self.rows = [none] * n
        self.limit = np.zeros(n, np.int64)  # the k-th score, 0 while there are fewer

    def add(self, item: int, score: np.ndarray, doc: np.ndarray, no_id: np.ndarray) -> None:
        s, d, z = (np.concatenate(x) for x in zip(self.rows[item], (score, doc, no_id)))
        top = np.lexsort((d, z, -s))[:self.k]
        self.rows[item] = (s[top], d[top], z[top])
        if len(top) == self.k:
            self.limit[item] = s[top[-1]]


def search_slice(block: Block, n: np.ndarray, end: np.ndarray, terms: np.ndarray, tfs: np.ndarray, doc: np.ndarray,
                 no_id: np.ndarray, best: Best) -> int:
    """Score a slice of the forward index for all items; returns the number of accumulators created."""
    if not len(terms):
        return 0
    row = np.repeat(np.arange(len(n)), np.diff(np.r_[0, end]))
    m = 10 + (90 * n * block.n_docs) // block.n_terms
    impact = (1_000_000_000 * tfs) // (1000 * tfs + 8 * m[row])
    order = np.argsort(terms, kind="stable")
    row, impact = row[order], impact[order]
    at = np.searchsorted(terms[order], np.arange(len(block.known) + 1))
    bound = np.zeros(len(block.known), np.int64)
    there = np.flatnonzero(np.diff(at))
    bound[there] = block.weight[there] * np.maximum.reduceat(impact, at[there])
    score, held = np.zeros(len(n), np.int64), np.zeros(len(n), bool)
    created = 0
    for item, own in enumerate(block.terms):
        own = own[bound[own] > 0]
        if not len(own):
            continue
        left = np.cumsum(bound[own][::-1])[::-1]  # what this and the later terms can add
        limit, largest, j = int(best.limit[item]), 0, 0
        for j, t in enumerate(own):
            if left[j] < largest:  # only then can the k-th partial score be beyond reach
                partial = score[held]
                if len(partial) >= best.k:
                    limit = max(limit, int(np.partition(partial, -best.k)[-best.k]))
            if left[j] < limit:
                break
            d = row[at[t]:at[t + 1]]
            score[d] += block.weight[t] * impact[at[t]:at[t + 1]]
            held[d] = True
            largest = max(largest, int(score[d].max()))
        else:
            j = len(own)
        touched = np.flatnonzero(held)
        created += len(touched)
        alive = touched
        if j < len(own):
            alive = touched[score[touched] + left[j] >= limit]
            held[:] = False
            held[alive] = True
            for t in own[j:] if len(alive) else ():
                d = row[at[t]:at[t + 1]]
                on = held[d]
                score[d[on]] += block.weight[t] * impact[at[t]:at[t + 1]][on]
        alive = alive[score[alive] >= max(1, int(best.limit[item]))]
        if len(alive) > best.k:
            alive = alive[score[alive] >= np.partition(score[alive], -best.k)[-best.k]]
        best.add(item, score[alive], doc[alive], no_id[alive])
        score[touched] = 0
        held[:] = False
    return created


RESULT = "item bigint, item_id bigint, doc_id bigint, score bigint"


def _statistics(index: DataFrame, block: Block) -> tuple[int, int]:
    """Document and term counts of the corpus; the block gets its weights."""
    n_docs, n_terms = index.filter("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1)))
    # At most one row per term of the block.
    rows = df.select("term", "df", weight.alias("w")).toArrow()
    dfs, ws = np.zeros(len(block.known), np.int64), np.zeros(len(block.known), np.int64)
    term = rows["term"].to_numpy()
    dfs[term], ws[term] = rows["df"].to_numpy(), rows["w"].to_numpy()
    block.weigh(dfs, ws, n_docs, n_terms)
    return n_docs, n_terms


def search_index(index: DataFrame, block: Block, k: int) -> DataFrame:
    """Every task's best ``k`` documents of every item."""
    shared = index.sparkSession.sparkContext.broadcast(block)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        best = Best(len(own.terms), k)
        for b in batches:
            doc, no_id = b.column(0).fill_null(0).to_numpy(), b.column(0).is_null().to_numpy(zero_copy_only=False)
            n, lists, tfs = b.column(1).to_numpy(), b.column(2), b.column(3).flatten().to_numpy().astype(np.int64)
            terms, end = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())
            lo = 0
            while lo < len(n):
                base = int(end[lo - 1]) if lo else 0
                hi = max(lo + 1, int(np.searchsorted(end, base + SLICE_POSTINGS, "right")))
                search_slice(own, n[lo:hi], end[lo:hi] - base, terms[base:end[hi - 1]], tfs[base:end[hi - 1]],
                             doc[lo:hi], no_id[lo:hi], best)
                lo = hi
        for i, (score, doc, no_id) in enumerate(best.rows):
            if len(score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(score), own.first + i)), pa.array([own.item_ids[i]] * len(score), pa.int64()),
                     pa.array(doc, mask=no_id), pa.array(score)], ["item", "item_id", "doc_id", "score"])

    return index.mapInArrow(search, RESULT)


def lexical_search(docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents of every row of ``items``.

    Scores are above 0; equal ones are ranked by ascending ``doc_id``, null ids
    last. Null texts have no terms: such a document is never found and not counted, such an
    item finds nothing. Rows with equal or null ids are documents and items of their
    own, each with its own ranks. Texts of any length are read whole; a long one is
    a slice of its own. Empty tables give an empty result. Columns besides
    ``doc_id``, ``item_id`` and ``text`` are not read.
    """
    found = None
    for block in blocks(items, block_terms):
        index = materialise(forward_index(docs, block), "lexical-index")
        if _statistics(index, block)[0] == 0:
            continue
        part = materialise(search_index(index, block, k), "lexical-best")
        found = part if found is None else found.unionAll(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], RESULT)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
