"""WARC archives with a Zstandard dictionary: writer and reader.

An archive file is a skippable frame (magic 0x184D2A5D, 32-bit length) that
holds a dictionary built from records of this archive, then one Zstandard
frame per WARC/1.1 record, compressed with that dictionary. Any record can be
read by itself once the leading frame is known.

Equal payloads: of the records whose payload has at least ``min_revisit_bytes``
bytes and the same SHA-1 and length, the one with the smallest id is written as
a response; the others are ``revisit`` records (profile
identical-payload-digest) that refer to it and carry no payload.

Work on Spark: the digests are grouped (partial counts first, so a payload
repeated in a third of the rows is one row per partition before the shuffle)
and the first ids joined back to the narrow (id, digest) rows; payloads are
shuffled once, by id. A task writes its records while they come; only the
first ``TRAIN_BYTES`` are held back to build the dictionary. File names are
unique per task attempt and only those of successful attempts are listed in
the manifest, a table written by Spark.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsense.llm.common import attempt_name, filesystem, make_folder, materialise
from shelfsense.session import scratch_path

SKIPPABLE = 0x184D2A5D
MANIFEST = "file string, n_records bigint, n_bytes bigint"
RECORDS = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
           "url string, payload binary")
#: Payload bytes of the first records from which a dictionary is built, and the dictionary's size.
TRAIN_BYTES, DICT_BYTES = 4 << 20, 64 << 10
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_uri(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def uri_id(uri: str) -> int | None:
    own = uri.strip("<>").rpartition(":")[2]
    return None if own == "null" else int(own)


def build_record(page_id: int | None, url: str | None, payload: bytes, revisit: bool, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; its block is an HTTP response (of a revisit: only the head)."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    target = "".join(c for c in url or "" if c not in "\r\n")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_uri(page_id)}",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_uri(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> dict:
    """The fields of a record that ``build_record`` or another WARC writer made."""
    top, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in top.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    revisit = fields["WARC-Type"] == "revisit"
    return {"page_id": uri_id(fields["WARC-Record-ID"]), "payload_bytes": size,
            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"), "record_type": fields["WARC-Type"],
            "refers_to": uri_id(fields["WARC-Refers-To"]) if revisit else None,
            "url": fields["WARC-Target-URI"], "payload": None if revisit else payload}


def build_dictionary(samples: list[bytes]):
    """A trained dictionary; where records are too few to train, their raw bytes serve."""
    import zstandard as zstd
    try:
        if len(samples) >= 8:
            return zstd.train_dictionary(DICT_BYTES, samples)
    except zstd.ZstdError:
        pass
    return zstd.ZstdCompressionDict(b"".join(samples)[:DICT_BYTES] or b"WARC/1.1", dict_type=zstd.DICT_TYPE_RAWCONTENT)


def _write_part(folder: str, level: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard as zstd
        fs, root = filesystem(folder)
        name, sink, press = attempt_name("pages", ".warc.zst"), None, None
        held: list[bytes] = []
        n, size, held_bytes = 0, 0, 0

        def start():
            nonlocal sink, press, size
            words = build_dictionary(held)
            sink = fs.open_output_stream(f"{root}/{name}", buffer_size=1 << 20)
            data = words.as_bytes()
            sink.write(struct.pack("<II", SKIPPABLE, len(data)) + data)
            size += 8 + len(data)
            press = zstd.ZstdCompressor(level=level, dict_data=words, write_content_size=True)

        def put(record: bytes):
            nonlocal size
            frame = press.compress(record)
            sink.write(frame)
            size += len(frame)

        for b in batches:
            for page, url, html, revisit, first in zip(*(b.column(i) for i in range(5))):
                record = build_record(page.as_py(), url.as_py(), (html.as_py() or "").encode(), revisit.as_py(),
                                      first.as_py())
                n += 1
                if sink is None:
                    held.append(record)
                    held_bytes += len(record)
                    if held_bytes >= TRAIN_BYTES:
                        start()
                        for r in held:
                            put(r)
                        held.clear()
                else:
                    put(record)
        if n:
            if sink is None:
                start()
                for r in held:
                    put(r)
            sink.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "n_records": [n], "n_bytes": [size]})

    return write


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               min_revisit_bytes: int = 0, level: int = 3) -> DataFrame:
    """Write one record per row of ``pages`` to archives in ``folder`` (shared); return the manifest.

    A null html is an empty payload, a null url an empty target. Rows with a
    null id come last among equal payloads; of rows with equal id and payload
    one is the response, the others revisit it. An empty table gives no file.
    Columns other than the three are not read.
    """
    spark = pages.sparkSession
    make_folder(folder)
    p = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                     F.col(html_col).cast("string").alias("html"))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    payload = F.coalesce("html", F.lit(""))
    rows = p.select("page_id", "url", "html", F.sha1(payload.cast("binary")).alias("sha1"),
                    F.octet_length(payload).alias("size"), F.xxhash64("url").alias("url_hash"))
    # One narrow row per record; the first of each payload has the smallest id (then url).
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "url_hash")
    firsts = (rows.filter(F.col("size") >= min_revisit_bytes)
              .groupBy("sha1", "size").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("copies"))
              .filter("copies > 1"))
    narrow = rows.select("page_id", "url_hash", "sha1", "size")
    later = (narrow.join(firsts, ["sha1", "size"])
             .filter(~order.eqNullSafe(F.col("first")))
             .select("page_id", "url_hash", "sha1", F.col("first.page_id").alias("refers_to"),
                     F.lit(True).alias("revisit")).distinct())
    # Rows equal in id, url and payload are numbered; the second and later ones revisit the first.
    same = (firsts.join(narrow.groupBy("sha1", "size", "page_id", "url_hash").agg(F.count(F.lit(1)).alias("n"))
                        .filter("n > 1"), ["sha1", "size"])
            .filter(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "url_hash").eqNullSafe(F.col("first")))
            .select("page_id", "url_hash", "sha1"))
    later = materialise(later, "warc-revisits")
    same = materialise(same, "warc-same")
    marked = (rows.alias("r").join(later.alias("l"),
                                   F.col("r.page_id").eqNullSafe(F.col("l.page_id"))
                                   & (F.col("r.url_hash") == F.col("l.url_hash")) & (F.col("r.sha1") == F.col("l.sha1")),
                                   "left")
              .select("r.*", "l.refers_to", F.coalesce("l.revisit", F.lit(False)).alias("revisit")))
    if not same.isEmpty():
        from pyspark.sql import Window
        w = Window.partitionBy("page_id", "url_hash", "sha1").orderBy("size")
        again = (marked.withColumn("copy", F.row_number().over(w)).alias("m")
                 .join(same.alias("s"), F.col("m.page_id").eqNullSafe(F.col("s.page_id"))
                       & (F.col("m.url_hash") == F.col("s.url_hash")) & (F.col("m.sha1") == F.col("s.sha1")), "left")
                 .withColumn("repeat", F.col("s.sha1").isNotNull() & (F.col("copy") > 1)))
        marked = again.select("m.page_id", "m.url", "m.html",
                              F.when(F.col("repeat"), F.col("m.page_id")).otherwise(F.col("refers_to")).alias("refers_to"),
                              (F.col("repeat") | F.col("revisit")).alias("revisit"))
    out = (marked.select("page_id", "url", "html", "revisit", "refers_to")
           .repartition(n, "page_id").sortWithinPartitions("page_id"))
    out.mapInArrow(_write_part(folder, level), MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def frames(src) -> Iterator[bytes]:
    """The records of an open archive, one after the other."""
    import zstandard as zstd
    magic, size = struct.unpack("<II", src.read(8))
    if magic != SKIPPABLE:
        raise ValueError("the archive does not begin with a dictionary frame")
    data = src.read(size)
    auto = data[:4] == struct.pack("<I", 0xEC30A437)
    words = zstd.ZstdCompressionDict(data, dict_type=zstd.DICT_TYPE_FULLDICT if auto else zstd.DICT_TYPE_RAWCONTENT)
    un = zstd.ZstdDecompressor(dict_data=words)
    rest = b""
    while True:
        if not rest:
            rest = src.read(1 << 20)
            if not rest:
                return
        one = un.decompressobj()
        parts = [one.decompress(rest)]
        while not one.eof:
            more = src.read(1 << 20)
            if not more:
                raise ValueError("the archive ends inside a record")
            parts.append(one.decompress(more))
        rest = one.unused_data
        yield b"".join(parts)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the archives that the manifest of ``folder`` lists."""
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").select("file").repartition(n, "file")
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
                            ("payload", pa.binary())])
        for b in batches:
            for file in b.column(0).to_pylist():
                with fs.open_input_stream(f"{root}/{file}") as src:
                    rows, size = [], 0
                    for record in frames(src):
                        rows.append(parse_record(record))
                        size += len(record)
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    return files.mapInArrow(load, RECORDS).select(*names)


def warc_archive(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    write_warc(pages, folder, min_revisit_bytes=min_revisit_bytes)
    return read_warc(spark, folder)
