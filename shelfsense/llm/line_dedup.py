"""Line deduplication against levelled sorted runs of line hashes, in DataFrame functions only.

A line's key is the line without white space at its ends and with A-Z
lower-cased; keys of fewer than ``MIN_CHARS`` code points are never touched. Of
all other keys only the lines of the first document that holds them stay.

Keys are remembered as 128-bit hashes in a ``LineRuns`` store, laid out like a log-structured
merge tree. A run is a table ``(h1, h2, first)`` sorted and bucketed by the hash;
no two runs hold the same hash. Batches of documents come in document order. A
batch is reduced to one row per key (partial sums in every task, so a line of a
third of all documents is one row per task), anti-joined with every run - the
runs are bucketed by the join key, so they are merged as they lie, without an
exchange - and what is left becomes a new run of level 0. Where that would be the
``fanout``-th run of a level, they are compacted to one of the next as the batch is written, so a
batch meets at most ``(fanout - 1) * levels`` runs and a hash is rewritten at most once per level.

Which lines go is an anti-join, too: a line stays if the runs say that its own
document is the first. That join's key has the document in it, so a
frequent line spreads over all tasks; it is made once, after the last batch. Every step writes a file
per bucket, and on a local file system each file costs the executor some processes: few steps write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsense.llm.common import discard, keyed, materialise, release
from shelfsense.session import scratch_path

#: Shortest key that counts, in code points.
MIN_CHARS = 10
#: Batches that ``line_dedup`` cuts a table into; runs of a level that are compacted to one.
BATCHES, FANOUT = 6, 3

BLANKS = " \t\n\x0b\x0c\r"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "h1 BIGINT, h2 BIGINT, first BIGINT"


def line_entries(rows: DataFrame) -> DataFrame:
    """``(key, at, h1, h2)``: document key, line number from 0 and line hash of every line that counts."""
    lines = rows.select("key", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("at", "line"))
    solid = lines.select("key", "at", F.btrim("line", F.lit(BLANKS)).alias("solid")).filter(F.char_length("solid") >= MIN_CHARS)
    line = F.translate("solid", CAPITALS, SMALL)
    return solid.select("key", "at", F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"))


class LineRuns:
    """The levelled runs of one store in a shared folder.

    ``add`` takes the entries of a batch whose document keys are all larger
    than those of earlier batches. The manifest in the folder lists the runs
    after every step, so ``LineRuns(spark, folder)`` in another session goes on
    where the last one stopped; runs that a crashed step left are not in it.
    """

    def __init__(self, spark: SparkSession, folder: str, fanout: int = FANOUT) -> None:
        self.spark, self.folder, self.fanout = spark, folder, fanout
        self.version = 0
        self.levels: dict[int, list[str]] = {}
        self.buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        self._tables: set[str] = set()
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifest")
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            seen = spark.read.parquet(f"{folder}/manifest")
            self.version = seen.agg(F.max("version")).first()[0]
            for r in seen.filter(F.col("version") == self.version).orderBy("run").collect():
                self.buckets = r["buckets"]
                if r["run"]:
                    self.levels.setdefault(r["level"], []).append(r["run"])

    # ------------------------------------------------------------------ tables
    def table(self, run: str) -> DataFrame:
        """A run, registered as a bucketed table if this session has not seen it."""
        if run not in self._tables:
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {run} ({RUN}) USING parquet CLUSTERED BY (h1, h2) "
                           f"SORTED BY (h1, h2) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{run}'")
            self._tables.add(run)
        return self.spark.table(run)

    @property
    def runs(self) -> list[str]:
        return [r for level in sorted(self.levels) for r in self.levels[level]]

    def _write(self, rows: DataFrame) -> str:
        self.version += 1
        run = scratch_path(self.spark, f"run_{self.version:05d}").rsplit("/", 1)[1].replace("-", "_")
        (rows.write.format("parquet").bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
         .option("path", f"{self.folder}/{run}").saveAsTable(run))
        self._tables.add(run)
        release(self.spark)
        return run

    def _note(self) -> None:
        rows = [(self.version, level, run, self.buckets) for level, runs in self.levels.items() for run in runs]
        (self.spark.createDataFrame(rows or [(self.version, 0, "", self.buckets)],
                                    "version int, level int, run string, buckets int")
         .coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest"))

    def _forget(self, run: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{run}")
        self.spark.sql(f"DROP TABLE IF EXISTS {run}")
        self._tables.discard(run)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    # ------------------------------------------------------------------ steps
    def learn(self, entries: DataFrame) -> None:
        """Remember a batch; its hashes and all levels they fill are written as one run."""
        fresh = entries.groupBy("h1", "h2").agg(F.min("key").alias("first"))
        for run in self.runs:
            fresh = fresh.join(self.table(run).select("h1", "h2"), ["h1", "h2"], "left_anti")
        level, old = 0, []
        while len(self.levels.get(level, [])) + 1 >= self.fanout:
            old += self.levels[level]
            self.levels[level] = []
            level += 1
        for run in old:
            fresh = fresh.unionAll(self.table(run))
        if old:
            fresh = fresh.repartition(self.buckets, "h1", "h2").sortWithinPartitions("h1", "h2")
        self.levels.setdefault(level, []).append(self._write(fresh))
        self._note()
        for run in old:
            self._forget(run)

    def later(self, entries: DataFrame, since: int | None = None) -> DataFrame:
        """Of remembered entries those ``(key, at)`` whose line stands in an earlier document.

        ``since``: no entry's key is smaller, so hashes first seen before it are not joined.
        """
        own = None
        for run in self.runs:
            own = self.table(run) if own is None else own.unionAll(self.table(run))
        if since is not None:
            own = own.filter(F.col("first") >= since)
        own = own.select("h1", "h2", F.col("first").alias("key"))
        return materialise(entries.join(own, ["h1", "h2", "key"], "left_anti").select("key", "at"), "dropped")

    def add(self, entries: DataFrame) -> DataFrame:
        """Remember a batch; returns its entries ``(key, at)`` whose line stands in an earlier document."""
        self.learn(entries)
        return self.later(entries, entries.agg(F.min("key")).first()[0])

    def clear(self) -> None:
        for run in self.runs:
            self._forget(run)
        self.levels = {}


def dropped_lines(rows: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``(key, at)`` of all lines that go."""
    spark = rows.sparkSession
    shares = F.array(*[F.lit(i / batches) for i in range(1, batches)])
    cuts = rows.agg(F.percentile_approx("key", shares, 10_000)).first()[0] if batches > 1 else None
    batch = F.lit(0)
    for c in cuts or []:
        batch = batch + (F.col("key") > F.lit(c)).cast("int")
    path = scratch_path(spark, "line-entries")
    line_entries(rows).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    release(spark)
    entries = spark.read.schema("key bigint, at int, h1 bigint, h2 bigint, batch int").parquet(path)
    entries.scratch = path
    store = LineRuns(spark, scratch_path(spark, "line-runs"), fanout)
    for b in range(batches):
        store.learn(entries.filter(F.col("batch") == b).drop("batch"))
    out = store.later(entries)
    store.clear()
    discard(entries)
    return out


def line_dedup(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """Every document without the lines whose key an earlier document has.

    Returns ``doc_id, n_lines, n_dropped, kept_sha256, text`` (the kept lines joined
    by ``\\n``). Documents are in order of ``doc_id``. Null and empty texts are one
    empty line. Rows with null or repeated ids are separate documents, null
    ids first, equal ids in order of a hash of their text; of equal rows the
    first keeps its lines. Lines repeated inside one document stay together or go
    together. Very long texts are handled line by line; only the positions
    of their dropped lines come together again. An empty table gives an empty
    result. Columns besides ``doc_id`` and ``text`` are not read.
    """
    rows = keyed(docs)
    gone = dropped_lines(rows, batches, fanout)
    # At most one entry per line of the document.
    lists = gone.groupBy(F.col("key").alias("gone_key")).agg(F.collect_list("at").alias("gone"))
    text = F.coalesce("text", F.lit(""))
    d = rows.join(lists, F.col("key") == F.col("gone_key"), "left").select(
        "doc_id", text.alias("text"), F.coalesce("gone", F.array().cast("array<int>")).alias("gone"))
    n_lines = F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    # The lines are bound once per text: the split stands outside of the lambda.
    kept = F.expr("get(transform(array(split(text, '\\n')), lines -> array_join(transform("
                  "array_except(sequence(0, size(lines) - 1), gone), p -> get(lines, p)), '\\n')), 0)")
    return d.select(
        "doc_id", n_lines.cast("bigint").alias("n_lines"), F.size("gone").cast("bigint").alias("n_dropped"),
        F.when(F.size("gone") == 0, F.col("text")).otherwise(kept).alias("text"),
    ).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"), "text")
