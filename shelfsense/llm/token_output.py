"""Token-id output: flat unsigned integer files with 64-bit document offsets.

Layout of one written corpus (a folder in the shared file system):

* ``part-00007-<attempt>.bin`` - the ids of a range of documents, little-endian
  unsigned integers in ascending document order, nothing else: of 16 bits where
  the vocabulary fits (half the disk), else of 32; the manifest says which;
* ``part-00007-<attempt>.off`` - per document two little-endian 64-bit
  integers: the global start of its ids and its document id (``.idx``: the same
  with starts counted in the part, from which the offsets are made);
* ``manifest/`` - a Parquet table written by Spark with one row per part: its
  files, its document and token counts and its base, the number of ids in all
  parts before it (a prefix sum). Only parts of successful task attempts are
  listed, so a retried task leaves at most an unused file behind.

Documents are range-partitioned and sorted by id; every task encodes its range
and writes ids while they come, so memory does not grow with a part. The bases
need only one count per part (a few bytes for each), summed on the driver.
Readers memory-map the files where the folder is local and take them as a
buffer from the file system otherwise.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsense.llm.common import attempt_name, enter, filesystem, make_folder, remember, text_slices
from shelfsense.session import scratch_path

PARTS = "part int, bin string, idx string, dtype string, n_docs bigint, n_tokens bigint"
ROWS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, part int"
#: Entries of a worker's caches: whole pieces, and tokenized parts in each of two generations.
CACHE_PIECES, CACHE_PARTS = 350_000, 350_000
#: Texts and bytes of text encoded at once.
SLICE_TEXTS, SLICE_TEXT_BYTES = 4096, 2 << 20


class Memo(dict):
    """Bounded memory of ``make(keys) -> values``; of dear values the last generation is kept too."""

    def __init__(self, make, entries: int, dear: bool = False):
        super().__init__()
        self.make, self.entries, self.dear, self.older = make, entries, dear, {}

    def ready(self, need: set[str]) -> None:
        """Have all of ``need`` in this dict."""
        new = [k for k in need if k not in self]
        if len(self) + len(new) > self.entries:
            self.older = dict(self) if self.dear else {}
            self.clear()
            new = list(need)
        unknown = new
        if self.older:
            self.update((k, self.older[k]) for k in new if k in self.older)
            unknown = [k for k in new if k not in self.older]
        for lo in range(0, len(unknown), 8192):
            some = unknown[lo:lo + 8192]
            self.update(zip(some, self.make(some)))


def byte_signs() -> dict[int, str]:
    """The character by which a byte-level vocabulary writes each byte.

    Printable bytes stand for themselves, the others are numbered from 256 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


#: Signs that end a letter run as a piece of their own whatever letters come before.
ENDINGS = ".,;:!?*#$%&|)"


class PieceEncoder:
    """Encodes texts with a byte-level tokenizer, remembering pieces between spaces.

    Such a tokenizer never joins across a single space between other
    characters, a single line feed between others, or from a letter to the
    signs after it, so these parts are encoded once. Texts with more white
    space around a space are encoded whole.
    """

    def __init__(self, path: str, end_id: int):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.dtype = id_type(max(self.tok.get_vocab_size() - 1, end_id))
        self.end = np.array([end_id], self.dtype).tobytes()
        self.signs = byte_signs()
        self.parts = Memo(self._encode_parts, CACHE_PARTS, dear=True)
        self.first = Memo(lambda p: self._encode_pieces(p, ""), CACHE_PIECES // 8)
        self.later = Memo(lambda p: self._encode_pieces(p, " "), CACHE_PIECES)

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        """Letter runs (with the blank before them) are one pre-token: the tokenizer's BPE model takes them at once."""
        merge, signs, out = self.tok.model.tokenize, self.signs, [b""] * len(parts)
        runs, plain, other = [], [], []
        for i, p in enumerate(parts):
            if not p.lstrip(" ").isalpha() or p[1:2] == " ":
                other.append(i)
            elif p.isascii():
                plain.append(i)
            else:
                runs.append((i, p.encode().decode("latin-1").translate(signs)))
        # Of ASCII letters only the blank has another sign; no run has a line feed.
        told = "\n".join([parts[i] for i in plain]).replace(" ", signs[0x20])
        runs += zip(plain, told.split("\n"))
        ids: list[int] = []
        ends = [0]
        for _, run in runs:
            ids += [t.id for t in merge(run)]
            ends.append(len(ids))
        raw, width = np.array(ids, self.dtype).tobytes(), np.dtype(self.dtype).itemsize
        for (i, _), x, y in zip(runs, ends, ends[1:]):
            out[i] = raw[x * width:y * width]
        for i, e in zip(other, self.tok.encode_batch_fast([parts[i] for i in other], add_special_tokens=False)):
            out[i] = np.array(e.ids, self.dtype).tobytes()
        return out

    def _encode_pieces(self, pieces: list[str], lead: str) -> list[bytes | None]:
        """Ids of pieces after ``lead``; None where white space next to the cut would join it."""
        cores, tails, odd = [], [], {}
        for p in pieces:
            core = p if p.isalpha() else p.rstrip(ENDINGS)
            if core.isalpha():
                cores.append(lead + core)
                tails.append(p[len(core):])
            else:
                odd[len(cores)] = self._cut(p, lead)
                cores.append("")
                tails.append("")
        self.parts.ready({*cores, *tails, *(y for x in odd.values() if x for y in x)})
        get = self.parts.__getitem__
        out = [get(c) + get(t) if t else get(c) for c, t in zip(cores, tails)]
        for i, x in odd.items():
            out[i] = None if x is None else b"".join(map(get, x))
        return out

    @staticmethod
    def _cut(piece: str, lead: str) -> list[str] | None:
        if not piece or piece[0].isspace() or piece[-1].isspace():
            return None
        lines, own, before = piece.split("\n"), [], lead
        if len(lines) > 1 and any(not x or x[0].isspace() or x[-1].isspace() for x in lines):
            lines = [piece]
        for i, x in enumerate(lines):
            if i:
                own.append("\n")
            core = x.rstrip(ENDINGS)
            if core and len(core) < len(x) and core[-1].isalpha():
                own += [before + core, x[len(core):]]
            else:
                own.append(before + x)
            before = ""
        return own

    def batch(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a string column with their end ids, one after the other, and every text's number of them; null is empty.

        Each piece of the batch is looked up once, however often it occurs.
        """
        col = pc.fill_null(col, "").cast(pa.large_string())
        split = pc.split_pattern(col, " ")
        size = split.value_lengths().to_numpy().astype(np.int64)
        last = np.cumsum(size)
        flat = split.flatten()
        coded = flat.dictionary_encode()
        later = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        word = coded.indices.to_numpy().astype(np.int64)
        # The first piece of a text has no blank before it: it is numbered after the others.
        heads = flat.take(pa.array(last - size)).dictionary_encode()
        first = heads.dictionary.to_numpy(zero_copy_only=False).tolist()
        word[last - size] = heads.indices.to_numpy().astype(np.int64) + len(later)
        # A piece seen only as a first one is not asked for after a blank.
        after = np.zeros(len(later) + len(first), bool)
        after[word] = True
        seen = [p for p, x in zip(later, after.tolist()) if x]
        self.later.ready(set(seen))
        self.first.ready(set(first))
        got = [self.later[p] if x else b"" for p, x in zip(later, after.tolist())] + [self.first[p] for p in first]
        own = [b"" if x is None else x for x in got] + [self.end]
        # The end id is one more piece behind every text; a text with a piece that white space joins is encoded whole.
        word = np.insert(word, last, len(got))
        last = last + np.arange(1, len(last) + 1)
        joined = np.fromiter((x is None for x in got), bool, len(got))
        if joined.any():
            text = np.repeat(np.arange(len(size)), size + 1)
            whole = np.unique(text[np.append(joined, False)[word]])
            own += [np.array(e.ids, self.dtype).tobytes() + self.end for e in self.tok.encode_batch_fast(
                col.take(pa.array(whole)).to_pylist(), add_special_tokens=False)]
            gone = np.zeros(len(size), bool)
            gone[whole] = True
            keep = ~gone[text]
            keep[last[whole] - 1] = True
            word[last[whole] - 1] = len(got) + 1 + np.arange(len(whole))
            word = word[keep]
            last = np.cumsum(np.where(gone, 1, size + 1))
        flat_ids = np.frombuffer(b"".join(own), self.dtype)
        length = np.fromiter(map(len, own), np.int64, len(own)) // flat_ids.itemsize
        begin = np.cumsum(length) - length
        n = length[word]
        end = np.cumsum(n)
        ids = flat_ids[np.repeat(begin[word] - (end - n), n) + np.arange(end[-1] if len(end) else 0)]
        return ids, np.diff(end[last - 1], prepend=0)

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Bytes of the ids of each text, with the end id; null is empty."""
        ids, n = self.batch(pa.array(texts, pa.large_string()))
        at = 0
        for x in n.tolist():
            yield ids[at:at + x].tobytes()
            at += x


def id_type(largest: int) -> str:
    """The narrowest unsigned little-endian type that holds every id: 16 or 32 bits."""
    return "<u2" if largest < 1 << 16 else "<u4"


_encoders: dict[tuple[str, int], PieceEncoder] = remember({})


def encoder(path: str, end_id: int) -> PieceEncoder:
    """This worker process's encoder; tasks that follow find its cache filled."""
    enter("tokens")
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = PieceEncoder(path, end_id)
    return _encoders[path, end_id]


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Encode whole texts and write the corpus files to ``folder`` (shared); return the manifest.

    Null texts are empty and get only the end id. Rows with a null id come
    first; rows with equal ids lie side by side in order of their text. An
    empty table gives an empty manifest. Other columns are not read.
    """
    spark = docs.sparkSession
    make_folder(folder)
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n = parts or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = d.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        fs, root = filesystem(folder)
        enc, sink, n_docs, n_tokens = None, None, 0, 0
        starts: list[np.ndarray] = []
        for b in batches:
            if not b.num_rows:
                continue
            if sink is None:
                enc = encoder(tokenizer, end_id)
                name = attempt_name(f"part-{part:05d}", "")
                sink = fs.open_output_stream(f"{root}/{name}.bin", buffer_size=1 << 20)
            ids = b.column(0)
            sizes = np.zeros(b.num_rows, np.int64)
            for lo, hi in text_slices(b.column(1), SLICE_TEXTS, SLICE_TEXT_BYTES):
                out, sizes[lo:hi] = enc.batch(b.column(1).slice(lo, hi - lo))
                sink.write(out.tobytes())
            row = np.zeros((b.num_rows, 2), "<i8")
            row[:, 0] = n_tokens + np.cumsum(sizes) - sizes
            row[:, 1] = ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            starts.append(row)
            n_docs += b.num_rows
            n_tokens += int(sizes.sum())
        if sink is not None:
            sink.close()
            with fs.open_output_stream(f"{root}/{name}.idx") as out:
                for row in starts:
                    out.write(row.tobytes())
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "bin": [f"{name}.bin"],
                                              "idx": [f"{name}.idx"], "dtype": [enc.dtype],
                                              "n_docs": [n_docs], "n_tokens": [n_tokens]})

    stage = f"{folder}/parts"
    ranged.mapInArrow(write, PARTS).write.parquet(stage)
    # One row per part: the prefix sum over parts runs on the driver.
    found = sorted(spark.read.schema(PARTS).parquet(stage).collect(), key=lambda r: r.part)
    base, rows = 0, []
    for r in found:
        rows.append((*r, base))
        base += r.n_tokens
    manifest = spark.createDataFrame(rows, f"{PARTS}, base bigint").repartition(max(1, len(rows)), "part")
    _finish_index(manifest, folder)
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _finish_index(manifest: DataFrame, folder: str) -> None:
    """Write each part's offset file: the starts of its index file plus its base."""

    def write_global(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = filesystem(folder)
        for f in frames:
            for r in f.itertuples():
                with fs.open_input_stream(f"{root}/{r.idx}") as src:
                    local = np.frombuffer(src.read(), "<i8").reshape(-1, 2).copy()
                local[:, 0] += r.base
                tmp = f"{root}/{attempt_name(r.idx, '.tmp')}"
                with fs.open_output_stream(tmp) as out:
                    out.write(local.tobytes())
                fs.move(tmp, f"{root}/{r.idx[:-4]}.off")  # atomic, and equal for every attempt
                yield pd.DataFrame({"part": [r.part]})

    manifest.select("part", "idx", "base").mapInPandas(write_global, "part int").write.format("noop").mode(
        "overwrite").save()


def open_array(fs, path: str, dtype: str) -> np.ndarray:
    """A file's integers: memory-mapped where it is local, else a buffer of the file system."""
    import pyarrow.fs as pafs
    if not fs.get_file_info(path).size:
        return np.zeros(0, dtype)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with fs.open_input_file(path) as src:
        return np.frombuffer(src.read(), dtype)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of a written corpus: id, global start, count and checksum of its ids, from the files."""
    manifest = spark.read.parquet(f"{folder}/manifest")

    def load(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = filesystem(folder)
        for f in frames:
            for r in f.itertuples():
                ids = open_array(fs, f"{root}/{r.bin}", r.dtype)
                off = open_array(fs, f"{root}/{r.idx[:-4]}.off", "<i8").reshape(-1, 2)
                start = np.asarray(off[:, 0])
                end = np.append(start[1:], r.base + r.n_tokens)
                for lo in range(0, len(start), 4096):
                    s, e = start[lo:lo + 4096], end[lo:lo + 4096]
                    crc = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(s - r.base, e - r.base)]
                    doc = pd.array(off[lo:lo + 4096, 1], dtype="Int64")
                    doc[off[lo:lo + 4096, 1] == np.iinfo(np.int64).min] = pd.NA
                    yield pd.DataFrame({"doc_id": doc, "start": s, "n_tokens": e - s, "ids_crc32": crc, "part": r.part})

    return manifest.select("part", "bin", "idx", "dtype", "base", "n_tokens").repartition("part").mapInPandas(load, ROWS)


def token_output(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` as a token corpus in the shared folder and read it back."""
    folder = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, folder, tokenizer, end_id)
    return read_tokens(docs.sparkSession, folder)
