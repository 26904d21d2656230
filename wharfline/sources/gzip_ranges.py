"""One huge gzip file read by many tasks.

A gzip stream has no places to start from by itself. One streaming pass, by one
task for each file, makes an index of such places, about one for every ``span``
bytes of text: the beginnings of members, and block boundaries together with the
32 KB of text before them, which are all that the decoder needs to go on. The
index is a stored table; made once, it lets every later read use a task for each
place.

The decoder is zlib's own, called through ctypes since Python's module can
neither stop at a block boundary nor start at one. Executors need ``libz``.
"""

from __future__ import annotations

import ctypes
import ctypes.util
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import wharfline
from wharfline.sources.files import open_file
from wharfline.workdir import new_dir

cloudpickle.register_pickle_by_value(wharfline)

SPAN_BYTES = 64 * 1024 * 1024
INDEX_SCHEMA = (
    "uri string, point bigint, in_at bigint, out_at bigint, out_end bigint, bits int, window binary, error string"
)
_WINDOW = 32 * 1024
_READ = 1 << 20
_EMIT = 4 << 20

# Fixed values of zlib's interface.
_Z_OK, _Z_STREAM_END, _Z_BUF_ERROR, _Z_NO_FLUSH, _Z_BLOCK = 0, 1, -5, 0, 5
_RAW, _GZIP = -15, 31
_BLOCK_END, _LAST_BLOCK = 128, 64
MEMBER = -1  # instead of a bit count: the place is the beginning of a member


class GzipError(OSError):
    """A stream that is damaged or ends too early."""


def _zlib() -> tuple[ctypes.CDLL, type[ctypes.Structure]]:
    """The library and its stream structure, made where they are used: neither travels to other processes."""

    class Stream(ctypes.Structure):
        _fields_ = [
            ("next_in", ctypes.c_void_p),
            ("avail_in", ctypes.c_uint),
            ("total_in", ctypes.c_ulong),
            ("next_out", ctypes.c_void_p),
            ("avail_out", ctypes.c_uint),
            ("total_out", ctypes.c_ulong),
            ("msg", ctypes.c_char_p),
            ("state", ctypes.c_void_p),
            ("zalloc", ctypes.c_void_p),
            ("zfree", ctypes.c_void_p),
            ("opaque", ctypes.c_void_p),
            ("data_type", ctypes.c_int),
            ("adler", ctypes.c_ulong),
            ("reserved", ctypes.c_ulong),
        ]

    lib = ctypes.CDLL(ctypes.util.find_library("z") or "libz.so.1")
    lib.zlibVersion.restype = ctypes.c_char_p
    return lib, Stream


class _Inflater:
    """A decoder over a file: ``read`` gives text, ``in_at`` is where the file has been used up to."""

    def __init__(self, body, in_at: int, bits: int, window: bytes):
        self.lib, stream = _zlib()
        self.z, self.body = stream(), body
        self.out = ctypes.create_string_buffer(_READ)
        self.raw = bits != MEMBER
        start = in_at - 1 if bits > 0 else in_at
        body.seek(start)
        self.buffer, self.in_at, self.ended = b"", start, False
        self._check(self.lib.inflateInit2_(
            ctypes.byref(self.z), _RAW if self.raw else _GZIP, self.lib.zlibVersion(), ctypes.sizeof(stream)))
        if bits > 0:
            self._fill()
            first = self.buffer[0]
            self._take(1)
            self._check(self.lib.inflatePrime(ctypes.byref(self.z), bits, first >> (8 - bits)))
        if self.raw and window:
            self._check(self.lib.inflateSetDictionary(ctypes.byref(self.z), window, len(window)))

    def close(self) -> None:
        self.lib.inflateEnd(ctypes.byref(self.z))

    def _check(self, code: int) -> None:
        if code != _Z_OK:
            raise GzipError(f"zlib error {code} at byte {self.in_at}: {(self.z.msg or b'').decode()}")

    def _fill(self) -> bool:
        """Whether there is input left."""
        if not self.buffer:
            self.buffer = bytes(self.body.read(_READ))
        return bool(self.buffer)

    def _take(self, n: int) -> None:
        self.buffer = self.buffer[n:]
        self.in_at += n

    def _next_member(self) -> bool:
        """Go on after the end of a member; False at the end of the file. A raw stream leaves its trailer to be skipped."""
        skip = 8 if self.raw else 0
        while skip and self._fill():
            n = min(skip, len(self.buffer))
            self._take(n)
            skip -= n
        if skip:
            raise GzipError(f"the stream ends within a trailer, at byte {self.in_at}")
        # zero bytes may fill a file up
        while self._fill() and self.buffer[0] == 0:
            self._take(len(self.buffer) - len(self.buffer.lstrip(b"\0")))
        if not self._fill():
            return False
        self.raw = False
        self._check(self.lib.inflateReset2(ctypes.byref(self.z), _GZIP))
        return True

    def step(self, flush: int = _Z_NO_FLUSH) -> bytes:
        """Some text; b'' without text may come at block boundaries and between members. ``ended`` tells the end."""
        if not self._fill():
            raise GzipError(f"the stream ends too early, at byte {self.in_at}")
        z = self.z
        z.next_in = ctypes.cast(ctypes.c_char_p(self.buffer), ctypes.c_void_p)
        z.avail_in = len(self.buffer)
        z.next_out, z.avail_out = ctypes.addressof(self.out), _READ
        code = self.lib.inflate(ctypes.byref(z), flush)
        text = ctypes.string_at(self.out, _READ - z.avail_out)
        self._take(len(self.buffer) - z.avail_in)
        self.at_block = code == _Z_OK and bool(z.data_type & _BLOCK_END) and not z.data_type & _LAST_BLOCK
        self.bits = z.data_type & 7
        self.at_member = False
        if code == _Z_STREAM_END:
            self.at_member = self._next_member()
            self.ended = not self.at_member
        elif code != _Z_BUF_ERROR:
            self._check(code)
        return text


def _places(body, span: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(in_at, out_at, bits, window) of the places to start from, then the end of the text with no place."""
    inflater, out_at, last, window = _Inflater(body, 0, MEMBER, b""), 0, 0, b""
    try:
        yield 0, 0, MEMBER, b""
        while not inflater.ended:
            text = inflater.step(_Z_BLOCK)
            out_at += len(text)
            window = text[-_WINDOW:] if len(text) >= _WINDOW else (window + text)[-_WINDOW:]
            if out_at - last >= span and (inflater.at_member or inflater.at_block):
                bits = MEMBER if inflater.at_member else inflater.bits
                yield inflater.in_at, out_at, bits, window[-1:] if inflater.at_member else window
                last = out_at
        yield -1, out_at, MEMBER, b""
    finally:
        inflater.close()


def _index_rows(span: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                yield from one(uri)

    def one(uri: str) -> Iterator[pa.RecordBatch]:
        number, before = 0, None
        try:
            with open_file(uri) as body:
                if not body.read(1):
                    return  # an empty file holds no text
                for place in _places(body, span):
                    if before:
                        yield _row(uri, number, *before[:2], place[1], *before[2:], None)
                        number += 1
                    before = place
        except Exception as e:  # noqa: BLE001 - one bad file must not end the pass
            yield _row(uri, number, -1, -1, -1, MEMBER, b"", f"{type(e).__name__}: {e}")

    return index


def _row(*cells) -> pa.RecordBatch:
    names = ["uri", "point", "in_at", "out_at", "out_end", "bits", "window", "error"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, types, strict=True)], names=names)


def index_gzip(files: DataFrame, out: str | None = None, span: int = SPAN_BYTES) -> DataFrame:
    """Make and store the index of the files in ``uri``; returns the table (INDEX_SCHEMA).

    A file that can't be read to its end has one row with ``error`` besides the
    places before. Each file is read once, by one task.
    """
    spark = files.sparkSession
    table = out or new_dir(spark, "gzip-index")
    listed = files.select("uri").distinct()
    tasks = max(spark.sparkContext.defaultParallelism, 1)
    listed.repartition(tasks, "uri").mapInArrow(_index_rows(span), INDEX_SCHEMA).write.mode("overwrite").parquet(table)
    return read_index(spark, table)


def read_index(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(table)


def _text_from(body, in_at: int, bits: int, window: bytes) -> Iterator[bytes]:
    inflater = _Inflater(body, in_at, bits, window)
    try:
        while not inflater.ended:
            text = inflater.step()
            if text:
                yield text
    finally:
        inflater.close()


def lines_of_range(chunks: Iterator[bytes], start: int, end: int, before: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of the lines that begin in [start, end); ``chunks`` is the text from ``start`` on.

    Lines end at ``\\n``, ``\\r`` and ``\\r\\n``. ``before`` is the byte ahead of
    ``start``, empty at the beginning of the text. The last line is read on beyond
    ``end``, and a line that began before ``start`` is left to its own range.
    """
    at, rest = start, b""
    skipping, after_return = before not in (b"", b"\n", b"\r"), before == b"\r"
    for chunk in chunks:
        if after_return and chunk:
            after_return = False
            if chunk[:1] == b"\n":
                chunk, at = chunk[1:], at + 1
        pieces = (rest + chunk).splitlines(keepends=True)
        # a return at the end may be half of a line end
        rest = pieces.pop() if pieces and not pieces[-1].endswith(b"\n") else b""
        for piece in pieces:
            if skipping:
                skipping = False
            elif at >= end:
                return
            else:
                yield at, piece.rstrip(b"\r\n")
            at += len(piece)
        if skipping and rest and not rest.endswith(b"\r"):
            at, rest = at + len(rest), b""
        if at >= end:
            return
    if rest and not skipping and at < end:
        yield at, rest.rstrip(b"\r\n")


def _range_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            if row["error"] is not None:
                raise GzipError(f"{row['uri']}: {row['error']}")
            with open_file(row["uri"]) as body:
                window = row["window"] or b""
                chunks = _text_from(body, row["in_at"], row["bits"], window)
                at, lines, size = [], [], 0
                for offset, line in lines_of_range(chunks, row["out_at"], row["out_end"], window[-1:]):
                    at.append(offset)
                    lines.append(line.removeprefix(b"\xef\xbb\xbf") if offset == 0 else line)
                    size += len(line) + 16
                    if size >= _EMIT:
                        yield _emit(row["uri"], at, lines)
                        at, lines, size = [], [], 0
                if at:
                    yield _emit(row["uri"], at, lines)


def _emit(uri: str, at: list[int], lines: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "uri": pa.array([uri] * len(at), pa.string()), "at": pa.array(at, pa.int64()), "value": pa.array(lines, pa.binary())})


def read_ranges(index: DataFrame) -> DataFrame:
    """``value`` per line and ``pos``, a struct of uri and byte offset in the text, which sorts in input order.

    Each place of the index is a task's worth of work. Files with an error in
    the index raise; leave their rows out to read the others. A byte-order mark
    at the start of a file is dropped, as Spark's reader does.
    """
    spark = index.sparkSession
    n = index.count()
    tasks = max(1, min(n, 8 * spark.sparkContext.defaultParallelism))
    dealt = index.repartition(tasks, "uri", "point")
    rows = dealt.mapInArrow(_range_lines, "uri string, at bigint, value binary")
    return rows.select(F.col("value").cast("string").alias("value"), F.struct(F.col("uri").alias("file"), "at").alias("pos"))
