"""Prefix trie of conversations, built as a burst trie.

A turn is a 128-bit hash of its role and text, a conversation the list of
its turns' ids with their lengths; texts stay where they are. Equal conversations are
collapsed first: one entry with the number of its members, the smallest member and
the digest of the ids that end there, so a group of copies of any size is one entry.

The trie's upper part is made of heads. A container holds the suffixes of all entries
below one head by one next turn id; at first a single container, the root's, holds
everything. A container with more than ``LIMIT`` entries is burst: the turns that all of
its entries share become the nodes of a new head, and the entries are dealt to new
containers by their next turn id (an entry that ends there stays with the head).
Bursting goes on in rounds until every container is small. Each round is one grouped
count, and a minimum and maximum per container that is too large: what these two share, all
entries in between share.

The containers lie in shards by hash. In its shard, a container's entries are sorted
and swept once with a stack: neighbours' common prefixes open and close the nodes.
Sums over subtrees that reach into heads come from the containers' top nodes: each
names the heads above it, and grouped sums per head do the rest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.llm.common import materialise

#: Entries of a container that is not burst.
LIMIT = 1024
#: Every conversation begins with turns of the first one of its block of so many ids ...
BLOCK = 100
#: ... as many as its id's checksum modulo this says.
SHARED = 6
#: Ids of members digested together (a range of so many ids).
CHUNK = 512
#: Tables of heads up to this size are broadcast, larger ones joined by shuffle.
BROADCAST_HEADS = 10_000

NOTHING = hashlib.sha256(b"").hexdigest()
KEY = ("ca", "cb")


# ------------------------------------------------------------------ conversations
def sequences(conversations: DataFrame) -> DataFrame:
    """``(conv, seq)``: every rebuilt conversation as a list of turns ``(a, b, n)``: id and code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").cast("bigint").alias("turn"),
        F.char_length(text).alias("n"), F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit(1), role, text).alias("b"))
    own = turns.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "n", "a", "b"))).alias("own")).select(
        "conv", F.transform("own", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["n"].alias("n"))).alias("own"))
    first = own.filter(F.col("conv") % BLOCK == 0).select(
        F.col("conv").alias("host"), F.slice("own", 1, SHARED - 1).alias("lent"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % SHARED).cast("int")
    both = own.withColumns({"host": F.col("conv") - F.col("conv") % BLOCK, "h": h}).join(first, "host", "left")
    return both.select("conv", F.expr("concat(if(lent IS NULL, slice(own, 1, 0), slice(lent, 1, h)), "
                                      "slice(own, h + 1, greatest(size(own) - h, 0)))").alias("seq"))


def _digest_long_lists(chunks: DataFrame) -> DataFrame:
    """SHA-256 of the ids of groups with several chunks, read one after the other in order."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha, out = None, None, []
        for b in batches:
            for key, ids in zip(zip(b.column(0).to_pylist(), b.column(1).to_pylist()), b.column(3).to_pylist()):
                if key != now:
                    if now is not None:
                        out.append((*now, sha.hexdigest()))
                    now, sha = key, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
        if now is not None:
            out.append((*now, sha.hexdigest()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["sa", "sb", "long_ends"])

    n = max(1, int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = chunks.select("sa", "sb", "chunk", "ids").repartition(n, "sa", "sb").sortWithinPartitions("sa", "sb", "chunk")
    return dealt.mapInArrow(digest, "sa bigint, sb bigint, long_ends string")


def entries(seqs: DataFrame) -> DataFrame:
    """``(seq, conv, n, ends)`` of every distinct sequence: smallest member, members, digest of their ids."""
    keyed = seqs.select("conv", "seq", F.xxhash64("seq").alias("sa"), F.xxhash64(F.lit(1), "seq").alias("sb"),
                        F.floor(F.col("conv") / CHUNK).cast("bigint").alias("chunk"))
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    chunks = materialise(keyed.groupBy("sa", "sb", "chunk").agg(
        ids.alias("ids"), F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"), F.first("seq").alias("seq")), "trie-ends")
    one = chunks.groupBy("sa", "sb").agg(F.count(F.lit(1)).alias("chunks"), F.sum("n").alias("n"), F.min("conv").alias("conv"),
                                         F.first("seq").alias("seq"), F.sha2(F.min("ids"), 256).alias("ends"))
    one = materialise(one, "trie-entries")
    several = chunks.join(one.filter("chunks > 1").select("sa", "sb"), ["sa", "sb"], "left_semi")
    long = _digest_long_lists(several)
    return materialise(one.join(long, ["sa", "sb"], "left").select(
        "seq", "conv", "n", F.coalesce("long_ends", "ends").alias("ends")), "trie-digests")


# ------------------------------------------------------------------ bursting
def _shared(x: str, y: str) -> str:
    """SQL: the number of leading elements two arrays share."""
    m = f"least(size({x}), size({y}))"
    return (f"cast(coalesce(nullif(array_position(zip_with(slice({x}, 1, {m}), slice({y}, 1, {m}), (u, v) -> u = v), false), 0) - 1, {m}) "
            "AS int)")


def burst(rows: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Entries in containers of at most ``limit``, and the heads above them."""
    active = rows.select(F.lit(0).cast("bigint").alias("ca"), F.lit(0).cast("bigint").alias("cb"), F.lit(0).alias("p"),
                         F.lit(None).cast("bigint").alias("above"),
                         F.expr("cast(array() AS array<struct<ca:bigint,cb:bigint>>)").alias("heads"), *rows.columns)
    done: list[DataFrame] = []
    heads: list[DataFrame] = []
    while True:
        large = materialise(active.groupBy(*KEY).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > limit)
                            .select(*KEY), "trie-large")
        n = large.count()
        if n == 0:
            done.append(active)
            break
        hint = F.broadcast if n <= BROADCAST_HEADS else (lambda t: t)
        shape = active.join(hint(large), list(KEY), "left_semi").groupBy(*KEY).agg(
            F.first("p").alias("p"), F.first("above").alias("above"), F.first("heads").alias("heads"), F.min("conv").alias("conv"),
            F.sum("n").alias("n"), F.min("seq").alias("low"), F.max("seq").alias("high"), F.min_by("ends", "seq").alias("ends"))
        shape = shape.withColumn("depth", F.expr(_shared("low", "high"))).select(
            *KEY, "p", "depth", "above", "heads", "conv", "n", F.expr("transform(slice(low, 1, depth), t -> t.n)").alias("lengths"),
            F.when(F.size("low") == F.col("depth"), F.col("ends")).otherwise(F.lit(NOTHING)).alias("ends"))
        head = materialise(shape, "trie-heads")
        heads.append(head)
        told = hint(head.select(*KEY, "depth", F.col("conv").alias("head_conv")))
        step = materialise(active.join(told, list(KEY), "left").filter("depth IS NULL OR size(seq) > depth"), "trie-round")
        done.append(step.filter("depth IS NULL").select(*active.columns))
        start = F.expr("slice(seq, 1, depth + 1)")
        active = step.filter("depth IS NOT NULL").select(
            F.xxhash64(start).alias("ca"), F.xxhash64(F.lit(1), start).alias("cb"), (F.col("depth") + 1).alias("p"),
            F.col("head_conv").alias("above"), F.concat("heads", F.array(F.struct(*KEY))).alias("heads"), *rows.columns)
    united = done[0]
    for part in done[1:]:
        united = united.unionAll(part)
    all_heads = None
    for part in heads:
        all_heads = part if all_heads is None else all_heads.unionAll(part)
    return united, all_heads


# ------------------------------------------------------------------ sweeping
NODE = ("conv_id bigint, depth int, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
        "saved_tokens bigint, ends_sha256 string")
SWEPT = NODE + ", heads array<struct<ca:bigint,cb:bigint>>"
_HEAD = pa.list_(pa.struct([("ca", pa.int64()), ("cb", pa.int64())]))
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), _HEAD]


class Sweep:
    """Nodes of sorted containers; one open node per depth is on the stack."""

    CONV, DEPTH, PARENT, N, CHILDREN, LEAVES, SAVED, ENDS, HEADS, LENGTH, BELOW = range(11)

    def __init__(self) -> None:
        self.container = self.top = None
        self.before: list = []
        self.stack: list[list] = []
        self.out: list[list] = []

    def _open(self, depth: int, length: int) -> None:
        self.stack.append([None, depth, None, 0, 0, 0, 0, NOTHING, None, length, []])

    def _close(self) -> None:
        node = self.stack.pop()
        node[self.LEAVES] = node[self.LEAVES] or 1
        node[self.SAVED] += (node[self.N] - 1) * node[self.LENGTH]
        for child in node[self.BELOW]:  # only now is the smallest member known
            child[self.PARENT] = node[self.CONV]
            self.out.append(child)
        node[self.BELOW] = None
        if not self.stack:
            node[self.PARENT], node[self.HEADS] = self.top
            self.out.append(node)
            return
        up = self.stack[-1]
        up[self.BELOW].append(node)
        up[self.CONV] = node[self.CONV] if up[self.CONV] is None else min(up[self.CONV], node[self.CONV])
        up[self.N] += node[self.N]
        up[self.CHILDREN] += 1
        up[self.LEAVES] += node[self.LEAVES]
        up[self.SAVED] += node[self.SAVED]

    def end(self) -> None:
        while self.stack:
            self._close()

    def add(self, container: tuple[int, int], p: int, top: tuple, turns: list, lengths: list[int], conv: int, n: int,
            ends: str) -> None:
        """The next entry in order of (container, turns)."""
        if container != self.container:
            self.end()
            self.container, self.top, shared = container, top, p
            self._open(p, lengths[p - 1] if p else 0)
        else:
            shared, most = p, min(len(turns), len(self.before))
            while shared < most and turns[shared] == self.before[shared]:
                shared += 1
            while len(self.stack) - 1 + p > shared:
                self._close()
        for d in range(shared, len(turns)):
            self._open(d + 1, lengths[d])
        node = self.stack[-1]
        node[self.CONV] = conv if node[self.CONV] is None else min(node[self.CONV], conv)
        node[self.N] += n
        node[self.ENDS] = ends
        self.before = turns

    def take(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        columns = list(zip(*rows))[:len(_TYPES)] if rows else [[]] * len(_TYPES)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)],
                                          [c.strip().split()[0] for c in NODE.split(",")] + ["heads"])


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sweep = Sweep()
    for b in batches:
        ca, cb, p, above, seq, conv, n, ends = (b.column(i) for i in (0, 1, 2, 3, 5, 6, 7, 8))
        flat = seq.flatten()
        turns = list(zip(flat.field(0).to_pylist(), flat.field(1).to_pylist()))
        lengths = flat.field(2).to_pylist()
        at = 0
        keys = list(zip(ca.to_pylist(), cb.to_pylist()))
        rows = zip(keys, p.to_pylist(), above.to_pylist(), seq.value_lengths().to_pylist(), conv.to_pylist(), n.to_pylist(),
                   ends.to_pylist())
        for i, (key, depth, up, size, c, members, digest) in enumerate(rows):
            top = (up, b.column(4)[i].as_py()) if key != sweep.container else None
            sweep.add(key, depth, top, turns[at:at + size], lengths[at:at + size], c, members, digest)
            at += size
            if len(sweep.out) > 20_000:
                yield sweep.take()
    sweep.end()
    yield sweep.take()


def _head_nodes(heads: DataFrame, tops: DataFrame) -> DataFrame:
    """The nodes of the heads; what lies below them comes from the containers' top nodes."""
    own = F.expr("(n - 1) * aggregate(slice(lengths, greatest(p, 1), greatest(depth - greatest(p, 1) + 1, 0)), 0L, (s, x) -> s + x)")
    above = F.explode("heads").alias("head")
    below = (tops.select(above, F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
             .unionAll(heads.select(above, F.lit(0).cast("bigint").alias("leaves"), own.alias("saved")))
             .groupBy("head").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    next_to = F.element_at("heads", -1).alias("head")
    children = (tops.filter("size(heads) > 0").select(next_to).unionAll(heads.filter("size(heads) > 0").select(next_to))
                .groupBy("head").agg(F.count(F.lit(1)).alias("children")))
    h = heads.withColumn("head", F.struct(*KEY)).join(below, "head").join(children, "head")
    d = h.select("*", F.explode(F.sequence("p", "depth")).alias("at"))
    path = F.expr("(n - 1) * aggregate(slice(lengths, greatest(at, 1), greatest(depth - greatest(at, 1) + 1, 0)), 0L, (s, x) -> s + x)")
    last = F.col("at") == F.col("depth")
    return d.select(
        F.col("conv").alias("conv_id"), F.col("at").alias("depth"),
        F.when(F.col("at") == F.col("p"), F.col("above")).otherwise(F.col("conv")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, F.col("children")).otherwise(1).cast("bigint").alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("saved") + path).alias("saved_tokens"),
        F.when(last, F.col("ends")).otherwise(F.lit(NOTHING)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per node of the trie over the rebuilt conversations.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the root),
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Null roles and texts are empty; null turn numbers come first; turns of equal
    number are put in order of length, then hash, so repeated rows are turns next to each other. Rows
    with a null ``conv_id`` belong to no conversation and are left out. A very long text
    is only hashed and measured; of a very long conversation 24 bytes per turn come
    together. An empty table has no nodes, not even a root. Columns besides
    ``conv_id``, ``turn``, ``role``, ``text`` are not read.
    """
    spark = conversations.sparkSession
    rows, heads = burst(entries(sequences(conversations)), limit)
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("ca"), F.col("cb"), F.col("seq")]
    dealt = rows.select("ca", "cb", "p", "above", "heads", "seq", "conv", "n", "ends").repartition(n, *KEY).sortWithinPartitions(*order)
    swept = materialise(dealt.mapInArrow(_sweep, SWEPT), "trie-nodes")
    names = [c.strip().split()[0] for c in NODE.split(",")]
    nodes = swept.select(*names)
    if heads is not None:
        nodes = nodes.unionAll(_head_nodes(heads, swept.filter("heads IS NOT NULL")).select(*names))
    return nodes.withColumn("depth", F.col("depth").cast("bigint"))
