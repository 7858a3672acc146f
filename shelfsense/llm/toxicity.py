"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is lower-cased, stripped of outer punctuation and put between ``<`` and
``>``; its features are itself and its character 3- to 5-grams, hashed into
``BUCKETS`` rows of an embedding table. A word's vector is the mean of its
features, a document's the average of its distinct words' (a repeated word
counts once), scaled by the root of their number so that a few words tell as much
in a long text as in a short one, and a softmax over two classes reads it. Table and softmax are trained
together in numpy, so misspelt and inflected forms never seen share the n-gram
vectors of the ones that were.

Training: a bounded sample of labelled rows (``MAX_TRAIN``, a documented
parameter) on the driver. Scoring: whole texts of all rows. As everything
after the embedding is linear, each bucket contributes one number to the
difference of the two logits, so tasks get a vector of ``BUCKETS`` floats
(1 MB, whatever the data), and a word's contribution is computed once for many
new words at a time and remembered in a bounded cache.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.llm.common import U, enter, mix, prefix_hash, returning, span_hash
from shelfsense.llm.labelled import held_out, training_ids, training_rows

BUCKETS, DIM, STEPS = 1 << 18, 4, 80
#: Words added to a document's number of words, so that a few words alone don't decide.
SMOOTH = 4
#: Documents of the sample that a feature must occur in (counted by its words).
MIN_DOCS = 10
#: Step sizes of table, softmax weights and bias; share of the table's largest gradient that damps small ones is DAMP by the
#: number of documents in the smaller class, as few documents tell chance from rule less well.
RATE, DAMP, DAMP_RANGE = (1.0, 0.3, 0.1), 8.0, (0.005, 0.1)
GRAMS = (3, 4, 5)
#: Labelled rows to train on (half of each class where there are so many) and their characters in all (see ``row_limit``).
MAX_TRAIN, MAX_TRAIN_CHARS = 4000, 30_000_000
CACHE_WORDS = 400_000
EDGES = ".,;:!?\"'()[]{}*#$%&|<>-_/\\"
BASE = 0x9FB21C651E98DF25
#: Words whose n-grams are coded at once by scoring tasks, and by the driver in training.
CHUNK, TRAIN_CHUNK = 1 << 16, 1 << 13


def word_of(token: str) -> str:
    return token.strip(EDGES)


def tokens_of(text: str | None) -> set[str]:
    """The distinct tokens of a text."""
    return set((text or "").lower().split())


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature ids of all words one after the other, and where each word's begin (and the end)."""
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(U)
    size = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    start = np.cumsum(size) - size
    prefix = prefix_hash(mix(codes + U(1)), BASE)
    ids, owner = [span_hash(prefix, start, start + size, BASE) ^ U(0x5A5A)], [np.arange(len(words))]
    word_at = np.repeat(np.arange(len(words)), size)
    for n in GRAMS:
        if len(codes) < n:
            continue
        at = np.arange(len(codes) - n + 1)
        at = at[word_at[at] == word_at[at + n - 1]]
        ids.append(span_hash(prefix, at, at + n, BASE) + U(n))
        owner.append(word_at[at])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    feats = (np.concatenate(ids)[order] % U(BUCKETS)).astype(np.int32)
    return feats, np.searchsorted(owner[order], np.arange(len(words) + 1))


@dataclass
class ToxicityModel:
    """``table`` and ``head`` as trained; ``weight`` is each bucket's part of the logit difference."""

    table: np.ndarray
    head: np.ndarray
    bias: np.ndarray

    @property
    def weight(self) -> np.ndarray:
        return (self.table @ (self.head[:, 1] - self.head[:, 0])).astype(np.float32)

    @property
    def offset(self) -> float:
        return float(self.bias[1] - self.bias[0])


def train(texts: list[str], y: list[int], seed: int = 7, steps: int = STEPS) -> ToxicityModel | None:
    """Fit table and softmax together; None without both classes or without a word.

    Adam over the whole (bounded) sample. Where gradients are small against the
    largest of the table, steps are too, so words that tell nothing stay near
    their start and only features of one class move far.
    """
    labels = np.array(y, np.int64)
    vocab: dict[str, int] = {}
    own = [np.array([vocab.setdefault(word_of(w), len(vocab)) for w in tokens_of(t)], np.int64) for t in texts]
    keep = np.array([len(x) > 0 for x in own], bool) if own else np.zeros(0, bool)
    labels, own = labels[keep], [x for x, k in zip(own, keep) if k]
    if len(set(labels.tolist())) < 2:
        return None
    rng = np.random.default_rng(seed)
    # Many words at a time: the ids of all n-grams at once would take more memory than all that follows.
    names, some = list(vocab), []
    for lo in range(0, len(names), TRAIN_CHUNK):
        f, begin = subwords(names[lo:lo + TRAIN_CHUNK])
        some.append((f, np.diff(begin)))
    feats, whole = (np.concatenate(x) for x in zip(*some))
    del names, some
    word, count = np.concatenate(own), np.array([len(x) for x in own])
    doc = np.repeat(np.arange(len(own)), count)
    del own
    # Features of a few documents only could just be learnt by heart; words of none else say nothing.
    seen = np.bincount(feats, np.repeat(np.bincount(word, minlength=len(vocab)), whole), minlength=BUCKETS)
    common = seen[feats] >= MIN_DOCS
    feat_of = np.repeat(np.arange(len(vocab)), whole)[common]
    left = np.unique(feat_of)
    number = np.full(len(vocab), -1)
    number[left] = np.arange(len(left))
    feat_of, feats = number[feat_of], feats[common]
    known = number[word] >= 0
    word, doc = number[word[known]], doc[known]
    del number, known, seen, common
    if not len(word):
        return None
    used, feats = np.unique(feats, return_inverse=True)
    feats, feat_of = feats.astype(np.int32), feat_of.astype(np.int32)
    size, inv = np.bincount(feat_of), (1 / whole[left]).astype(np.float32)
    begin = np.cumsum(size) - size
    # Document x word, by document and by word; word x feature, by feature. No group is empty.
    some, doc = np.unique(doc, return_inverse=True)
    labels, count = labels[some], count[some]
    doc_begin = np.searchsorted(doc, np.arange(len(some)))
    if len(set(labels.tolist())) < 2:
        return None
    by_word = np.argsort(word, kind="stable")
    word_begin, doc_by_word = np.searchsorted(word[by_word], np.arange(len(left))), doc[by_word]
    by_feat = np.argsort(feats, kind="stable").astype(np.int32)
    feat_begin = np.searchsorted(feats[by_feat], np.arange(len(used)))
    feat_word = feat_of[by_feat]
    del by_feat, feat_of
    per_doc = (1 / np.sqrt(count + SMOOTH)).astype(np.float32)
    # Classes weigh the same in all, so a rare class is learnt too.
    n1, n0 = (labels == 1).sum(), (labels != 1).sum()
    weight = np.where(labels == 1, 0.5 / n1, 0.5 / n0).astype(np.float32)
    truth = np.stack([labels != 1, labels == 1]).astype(np.float32)
    # One row per dimension: sums then run along memory.
    params = [rng.normal(0, 0.1, (DIM, len(used))).astype(np.float32), rng.normal(0, 1, (2, DIM)).astype(np.float32),
              np.zeros((2, 1), np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    damp = min(max(DAMP / min(n1, n0), DAMP_RANGE[0]), DAMP_RANGE[1])
    for step in range(1, steps + 1):
        table, head, bias = params
        mean = np.stack([np.add.reduceat((np.add.reduceat(t[feats], begin) * inv)[word], doc_begin) * per_doc
                         for t in table])
        z = head @ mean + bias
        z = np.exp(z - z.max(0))
        d = (z / z.sum(0) - truth) * weight
        d_doc = (head.T @ d) * per_doc
        d_table = np.stack([np.add.reduceat((np.add.reduceat(g[doc_by_word], word_begin) * inv)[feat_word], feat_begin)
                            for g in d_doc])
        for i, (p, g) in enumerate(zip(params, (d_table, d @ mean.T, d.sum(1, keepdims=True)))):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.98 * second[i] + 0.02 * g * g
            m, v = first[i] / (1 - 0.9 ** step), np.sqrt(second[i] / (1 - 0.98 ** step))
            p -= RATE[i] * m / (v + (damp * v.max() if i == 0 else 0.0) + 1e-12)
    full = np.zeros((BUCKETS, DIM), np.float32)
    full[used] = params[0].T
    return ToxicityModel(full, params[1].T, params[2][:, 0])


class WordScores(dict):
    """Token -> its words' mean contribution; unknown tokens are added many at a time."""

    def __init__(self, weight: np.ndarray):
        super().__init__()
        enter("words")
        self.weight = weight

    def learn(self, tokens: set[str]) -> None:
        new = [t for t in tokens if t not in self]
        if len(self) + len(new) > CACHE_WORDS:
            self.clear()
            new = list(tokens)
        for lo in range(0, len(new), CHUNK):
            some = new[lo:lo + CHUNK]
            feats, begin = subwords([word_of(t) for t in some])
            total = np.concatenate([[0.0], np.cumsum(self.weight[feats], dtype=np.float64)])
            self.update(zip(some, ((total[begin[1:]] - total[begin[:-1]]) / np.diff(begin)).tolist()))


def score_texts(texts: list[str | None], scores: WordScores, offset: float) -> np.ndarray:
    tokens = [tokens_of(t) for t in texts]
    scores.learn(set().union(*tokens))
    z = np.array([offset + sum(map(scores.__getitem__, t)) / (len(t) + SMOOTH) ** 0.5 for t in tokens])
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def row_limit(sizes: list[int | None], most: int) -> int | None:
    """The length up to which texts are trained on; None where all together have at most ``most`` characters.

    It is the largest for which the texts stay within ``most`` when each longer
    one, and each sampled id without a text (None), gives way to one of that length;
    so it is never less than an equal share.
    """
    known, left = sorted(x for x in sizes if x is not None), most
    if sum(known) <= most:
        return None
    for i, x in enumerate(known):
        if x * (len(sizes) - i) > left:
            return left // (len(sizes) - i)
        left -= x
    return known[-1]


def sample(docs: DataFrame, labels: DataFrame, max_train: int, most: int) -> tuple[DataFrame, int | None]:
    """(doc_id, text, y) of the rows to learn from, at most ``most`` characters in all, and the limit that held.

    Of each class the rows lowest by hash. Where their texts are too long
    together, the rows over ``row_limit`` give way to the next ones of their class.
    """
    ids = training_ids(labels, "toxic", max_train, per_class=True)
    length = F.sum(F.coalesce(F.char_length("text"), F.lit(0))).alias("chars")
    sizes = ids.join(training_rows(docs, ids).groupBy("doc_id").agg(length), "doc_id", "left").select("chars").collect()
    limit = row_limit([r.chars for r in sizes], most)
    if limit is not None:
        short = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
                 .groupBy("doc_id").agg(length).filter(F.col("chars") <= limit).select("doc_id"))
        own = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic")
        ids = training_ids(own.join(short, "doc_id", "left_semi"), "toxic", max_train, per_class=True)
    return training_rows(docs, ids).fillna("", ["text"]), limit


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, most: int = MAX_TRAIN_CHARS) -> ToxicityModel | None:
    """Train on a bounded sample of the labelled rows that are not held out.

    None if the documents have labelled rows of one class at most, or too few of
    both to learn from. If the sample lacks a class that they have, or texts gave
    way to the limit and nothing could be learnt from the others, that is an error.
    """
    rows, limit = sample(docs, labels, max_train, most)
    got = rows.orderBy("doc_id", "text").select("text", "y").toPandas()
    model = train(got["text"].tolist(), got["y"].astype(int).tolist())
    if model is None and (limit is not None or (got["y"] == 1).nunique() < 2):
        every = training_ids(labels, "toxic", 2 ** 31 - 1)
        there = every.join(docs.select(F.col("doc_id").cast("bigint").alias("doc_id")), "doc_id", "left_semi")
        if there.select((F.col("y") == 1).alias("toxic")).distinct().count() == 2:
            raise ValueError("there are labelled rows of both classes, but nothing can be learnt from the training sample: "
                             f"{int((got['y'] == 1).sum())} toxic and {int((got['y'] != 1).sum())} other rows, length limit {limit}")
    return model


def toxicity_scores(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """Score every whole text: ``doc_id, held_out, score, predicted``, one row per row of ``docs``.

    Null and empty texts are scored by the bias alone; repeated rows alike.
    Without labelled rows of both classes every score is 0 (see ``fit``). Columns other than
    ``doc_id`` and ``text`` are not read.
    """
    spark = docs.sparkSession
    model = fit(docs, labels, max_train)
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if model is None:
        scored = d.select("doc_id", F.lit(0.0).alias("score"))
    else:
        shared = spark.sparkContext.broadcast((model.weight, model.offset))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weight, offset = shared.value
            words = WordScores(weight)
            for b in batches:
                parts = [score_texts(b.column(1).slice(lo, 128).to_pylist(), words, offset)
                         for lo in range(0, b.num_rows, 128)]
                if parts:
                    yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(parts))], ["doc_id", "score"])

        scored = d.mapInArrow(returning(score), "doc_id bigint, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def reject_toxic(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic; nothing is moved."""
    model = fit(docs, labels, max_train)
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast((model.weight, model.offset))

    @F.arrow_udf("double")
    @returning
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weight, offset = shared.value
        words = WordScores(weight)
        for t in texts:
            parts = [score_texts(t.slice(lo, 128).to_pylist(), words, offset) for lo in range(0, len(t), 128)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return docs.filter(score(F.col("text").cast("string")) < 0.5)
