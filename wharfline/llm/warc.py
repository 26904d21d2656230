"""WARC archives as a table of payload chunks.

``write_archives`` writes one record per row: a ``response`` with its payload,
or a ``revisit`` without one that names the response with the same payload.
Every record is a gzip member of its own, as is usual for ``.warc.gz``.

``read_chunks`` streams archives into rows (record, chunk number, bytes). A
payload of any length passes through memory one chunk at a time; each chunk
carries the length and the SHA-1 of the payload up to its end, so that the last
chunk of a record holds the digest of the whole, without gathering a record.

Archives have names of their own for every attempt of a task and only files
that a finished task reports are read. A lost executor or a second attempt
therefore leaves a file that nothing refers to.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wharfline.sources.files import posix_path
from wharfline.workdir import new_dir

from .common import row_tag, store

CHUNK_BYTES = 1 << 20        # payload bytes of a chunk row
ARCHIVE_BYTES = 64 << 20     # an archive is closed once it is longer
INPUT_BYTES = 1 << 18        # compressed bytes read at a time
HEADER_LIMIT = 1 << 16       # bytes of a record header before it counts as damaged

ARCHIVE_SCHEMA = "file string, n_records long, n_bytes long"
CHUNK_SCHEMA = ("record_id string, row_id long, record_type string, refers_to long, target_uri string, "
                "stated_digest string, chunk_no int, is_last boolean, n_bytes long, sha1 string, data binary")


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_types(rows: DataFrame) -> DataFrame:
    """Add ``digest``, ``record_type`` and ``refers_to`` to row_id, uri, payload.

    Among rows with equal payloads (a null one equals an empty one) those with
    the smallest id are responses, the others revisit that id. Rows without an
    id are revisits where any row with the payload has one, else responses.
    Payloads that occur once are not looked up, and those that occur often
    shuffle one partial row per task.
    """
    keyed = rows.withColumn("digest", F.sha1(F.coalesce("payload", F.lit("").cast("binary"))))
    first = (
        keyed.groupBy("digest").agg(F.min("row_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").drop("n")
    )
    again = F.col("first").isNotNull() & ~F.col("row_id").eqNullSafe(F.col("first"))
    return keyed.join(first, "digest", "left").select(
        "row_id", F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"), "digest", "uri", "payload")


def _record(row_id, uri, digest: str, kind: str, refers_to, payload: memoryview) -> bytes:
    """One gzip member."""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Row-ID: {'' if row_id is None else row_id}",
    ]
    if uri is not None:
        # header values end at the line's end, so controls and per cent are escaped
        safe = "".join(f"%{ord(c):02X}" if ord(c) < 33 or c == "%" else c for c in uri)
        lines.append(f"WARC-Target-URI: {safe}")
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"X-Refers-To-Row: {refers_to}")
    length = 0 if kind == "revisit" else len(payload)
    lines.append(f"Content-Length: {length}")
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    parts = [packer.compress(("\r\n".join(lines) + "\r\n\r\n").encode())]
    for at in range(0, length, CHUNK_BYTES):
        parts.append(packer.compress(payload[at:at + CHUNK_BYTES]))
    parts += [packer.compress(b"\r\n\r\n"), packer.flush()]
    return b"".join(parts)


def write_archives(typed: DataFrame, out_dir: str) -> DataFrame:
    """Write rows of ``record_types`` below ``out_dir``; returns the archives written."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(out_dir)
        fs.create_dir(root, recursive=True)
        sink, name, count, size = None, "", 0, 0

        def done():
            sink.close()
            return pa.RecordBatch.from_pydict(
                {"file": [name], "n_records": pa.array([count], pa.int64()), "n_bytes": pa.array([size], pa.int64())})

        for batch in batches:
            ids, kinds, refers, digests, uris = (batch.column(i).to_pylist() for i in (0, 1, 2, 3, 4))
            bodies = batch.column(5)
            for i, row_id in enumerate(ids):
                if sink is None:
                    name, count, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink = fs.open_output_stream(name)
                digest = base32_sha1(bytes.fromhex(digests[i]))
                body = bodies[i].as_buffer() if bodies[i].is_valid else b""
                raw = _record(row_id, uris[i], digest, kinds[i], refers[i], memoryview(body))
                sink.write(raw)
                count, size = count + 1, size + len(raw)
                if size >= ARCHIVE_BYTES:
                    yield done()
                    sink = None
        if sink is not None:
            yield done()

    return typed.mapInArrow(work, ARCHIVE_SCHEMA)


def _pieces(source) -> Iterator[tuple[bytes, bool]]:
    """Decompressed bytes of the members of a gzip stream, each with whether it ends its member."""
    raw = source.read(INPUT_BYTES)
    while raw:
        member = zlib.decompressobj(31)
        while True:
            piece = member.decompress(raw, CHUNK_BYTES)
            yield piece, member.eof
            if member.eof:
                raw = member.unused_data or source.read(INPUT_BYTES)
                break
            raw = member.unconsumed_tail or source.read(INPUT_BYTES)
            if not raw and not piece:
                raise ValueError("archive ends within a record")


def iter_chunks(source, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple]:
    """Chunk rows (see CHUNK_SCHEMA) of an open archive, in order."""
    buffer, header, ended = b"", None, False  # ended: the payload is read, the member's end is not
    left, sha, n_bytes, chunk_no = 0, hashlib.sha1(), 0, 0
    for piece, last in _pieces(source):
        buffer += piece
        if header is None:
            cut = buffer.find(b"\r\n\r\n")
            if cut >= 0:
                header = _header(buffer[:cut])
                left, buffer = int(header["Content-Length"]), buffer[cut + 4:]
                sha, n_bytes, chunk_no = hashlib.sha1(), 0, 0
            elif last or len(buffer) > HEADER_LIMIT + CHUNK_BYTES:
                raise ValueError("record header without an end")
        while header is not None and not ended and len(buffer) >= min(left, chunk_bytes):
            data, buffer = buffer[:min(left, chunk_bytes)], buffer[min(left, chunk_bytes):]
            left -= len(data)
            sha.update(data)
            n_bytes += len(data)
            ended = left == 0
            yield (header["WARC-Record-ID"], _number(header.get("X-Row-ID")), header["WARC-Type"],
                   _number(header.get("X-Refers-To-Row")), header.get("WARC-Target-URI"),
                   header["WARC-Payload-Digest"].removeprefix("sha1:"), chunk_no, ended, n_bytes,
                   base32_sha1(sha.digest()), data)
            chunk_no += 1
        if last:
            if not ended:
                raise ValueError("member ends within a record")
            buffer, header, ended = b"", None, False


def _header(raw: bytes) -> dict[str, str]:
    version, *fields = raw.decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a record: {version[:40]!r}")
    return {name: value for name, _, value in (f.partition(": ") for f in fields)}


def _number(text: str | None) -> int | None:
    return int(text) if text else None


def read_chunks(archives: DataFrame, root: str, keep_data: bool = True) -> DataFrame:
    """Chunk rows of the archives in ``archives.file``; ``root`` is any uri on their file system.

    There are as many tasks as archives, so one task reads at most a few; without a
    number Spark would put the short rows of names into one task. Without
    ``keep_data`` the bytes are dropped after they are digested.
    """
    names = [c.split(" ")[0] for c in CHUNK_SCHEMA.split(", ")]

    def rows(source) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in iter_chunks(source):
            held.append(row if keep_data else (*row[:-1], None))
            size += len(row[-1]) if keep_data else 0
            if len(held) >= 4096 or size >= 8 * CHUNK_BYTES:
                yield batch(held)
                held, size = [], 0
        if held:
            yield batch(held)

    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(),
             pa.bool_(), pa.int64(), pa.string(), pa.binary()]

    def batch(held) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(root)
        for found in batches:
            for name in found.column(0).to_pylist():
                with fs.open_input_stream(name) as source:
                    yield from rows(source)

    dealt = archives.select("file").repartition(max(1, archives.count()), "file")
    return dealt.mapInArrow(work, CHUNK_SCHEMA)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record: its last chunk; a revisit takes length and digest of its response.

    ``digest_ok``: the digest of the bytes read is the one the header states.
    """
    last = chunks.where("is_last").select(
        "row_id", "record_type", "refers_to", "target_uri", "stated_digest", "n_bytes", "sha1")
    again, own = last.where("record_type = 'revisit'"), last.where("record_type <> 'revisit'")
    # repeated rows may give several responses with one id and payload
    original = own.select(
        F.col("row_id").alias("o_id"), F.col("n_bytes").alias("o_bytes"), F.col("sha1").alias("o_sha1"),
        F.col("stated_digest").alias("o_stated")).dropDuplicates(["o_id", "o_sha1"])
    joined = again.join(
        original, (F.col("refers_to") == F.col("o_id")) & (F.col("stated_digest") == F.col("o_stated")), "left")
    cols = ["row_id", "record_type", "refers_to", "target_uri"]
    return own.select(
        *cols, F.col("n_bytes").alias("payload_bytes"), F.col("sha1").alias("payload_digest"),
        (F.col("sha1") == F.col("stated_digest")).alias("digest_ok"),
    ).unionByName(joined.select(
        *cols, F.col("o_bytes").alias("payload_bytes"), F.col("o_sha1").alias("payload_digest"),
        F.coalesce(F.col("o_sha1") == F.col("stated_digest"), F.lit(False)).alias("digest_ok")))


def archive_table(rows: DataFrame, id_col: str, payload: str, uri: str | None = None,
                  out_dir: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Write ``rows`` as archives; returns (archives, their chunk rows).

    Null and empty payloads are records of length 0 and equal each other; null
    uris leave their header out; repeated rows are records of their own; other
    columns are ignored. An empty table writes nothing and has no rows.
    """
    row_tag(rows, id_col, payload)
    out_dir = out_dir or new_dir(rows.sparkSession, "warc")
    plain = posix_path(out_dir)
    if plain is not None:
        out_dir = f"file://{os.path.abspath(plain)}"
    own = rows.select(
        F.col(id_col).cast("long").alias("row_id"),
        (F.col(uri).cast("string") if uri else F.lit(None).cast("string")).alias("uri"),
        F.col(payload).cast("binary").alias("payload"))
    archives = store(write_archives(record_types(own), out_dir), "archives")
    return archives, read_chunks(archives, out_dir, keep_data=False)


def op4_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    _, chunks = archive_table(pages, "page_id", "html", "url")
    return records(store(chunks, "chunks")).select(
        F.col("row_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


def oracle() -> str | None:
    """DuckDB has SHA-1 in hex; base32 is built from blocks of 5 hex digits (20 bits, 4 letters)."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    letters = " || ".join(
        f"substr('{alphabet}', ((('0x' || substr(h, {5 * i + 1}, 5))::INT >> {s}) & 31) + 1, 1)"
        for i in range(8) for s in (15, 10, 5, 0))
    return f"""WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
    d AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS h FROM p),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d)
    SELECT page_id, payload_bytes, {letters} AS payload_digest,
      CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN first < page_id THEN first END AS refers_to, true AS digest_ok
    FROM f"""
