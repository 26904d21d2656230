"""Removal of repeated runs of lines, cut by content.

Boundaries come from line hashes alone, in several families of chunks:

- A rolling hash over two line hashes runs along each text; a chunk ends after
  every line whose value is below those of both neighbours. Such cuts depend on
  four lines only, so an insertion elsewhere doesn't move them, and no two follow
  each other nor is there one before the last line, so every chunk of a text of
  several lines has two or more.
- A short run seldom holds two such cuts of its own. So for each of ``FAMILY_BITS``
  bits of a line's hash and each value of it, one more family cuts before every
  line that has the value and after every line that has not. One line decides on
  either side, whatever surrounds it. The chunks of several lines are then two
  lines, the first with the value, the second without; over all these families
  they are the neighbours whose hashes differ in these bits.

A chunk of two lines or more that occurs more than once in the corpus, compared
byte by byte, stays at its first place (smallest id, then line) and its lines are
removed elsewhere. A line goes only if an earlier place holds it, so its first
place always stays. Texts of one line and blank chunks stay.

Keys alone are counted and joined; counts combine within tasks before they are
shuffled, and AQE splits the join where a chunk is very frequent. Of a text's
repeated chunks only as many as cover its lines are compared, with compressed
bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, row_tag, store

_MASK = (1 << 32) - 1
_BLANK = b" \t\n\r\x0b\x0c"
FAMILY_BITS = 6   # of two neighbours one pair in 64 differs in none of them


def line_hash(line: bytes) -> int:
    return int.from_bytes(hashlib.md5(line).digest()[:4], "big")


def cut(lines: list[bytes], hashes: np.ndarray | None = None) -> list[tuple[int, int]]:
    """(first line, line after the last) of each chunk of the first family."""
    n = len(lines)
    if n < 3:
        return [(0, n)]
    h = np.array([line_hash(x) for x in lines], np.uint64) if hashes is None else hashes
    rolled = (np.concatenate([[0], h[:-1]]).astype(np.uint64) * np.uint64(31) + h) & np.uint64(_MASK)
    low = (rolled[1:-2] < rolled[:-3]) & (rolled[1:-2] < rolled[2:-1])  # never before the last line
    ends = [*(np.flatnonzero(low) + 2).tolist(), n]
    return list(zip([0, *ends[:-1]], ends, strict=True))


def all_chunks(lines: list[bytes]) -> list[tuple[int, int]]:
    """(first line, line after the last) of the chunks of several lines of all families."""
    if len(lines) < 2:
        return []
    h = np.array([line_hash(x) for x in lines], np.uint64)
    differ = np.flatnonzero((h[1:] ^ h[:-1]) & np.uint64((1 << FAMILY_BITS) - 1)).tolist()
    return sorted({(i, i + 2) for i in differ}.union(c for c in cut(lines, h) if c[1] - c[0] > 1))


def cover(chunks: list[tuple[int, int]]) -> list[int]:
    """Places of few chunks that hold all lines which any of ``chunks`` (in order) holds."""
    out, upto, i = [], 0, 0
    while i < len(chunks):
        upto = max(upto, chunks[i][0])
        best = None
        while i < len(chunks) and chunks[i][0] <= upto:
            if chunks[i][1] > upto and (best is None or chunks[i][1] > chunks[best][1]):
                best = i
            i += 1
        if best is not None:
            out.append(best)
            upto = chunks[best][1]
    return out


def _begins(lines: list[bytes]) -> list[int]:
    """Bytes before each line and, by one too many, after the last."""
    return np.concatenate([[0], np.cumsum([len(x) + 1 for x in lines])]).tolist()


def chunk_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, text_key, line, n_lines, chunk_key) of all chunks that may be removed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        md5 = hashlib.md5
        for batch in batches:
            ids, keys, texts = (batch.column(i) for i in range(3))
            doc, first, size, chunk_key = [], [], [], []
            for i, text in enumerate(texts):
                raw = text.as_py()
                if raw is None or b"\n" not in raw:
                    continue
                lines = raw.split(b"\n")
                at = _begins(lines)
                for a, b in all_chunks(lines):
                    body = raw[at[a]:at[b] - 1]
                    if body.strip(_BLANK):
                        doc.append(i)
                        first.append(a)
                        size.append(b - a)
                        chunk_key.append(md5(body).digest())
                if len(doc) > 1 << 17:
                    yield out(ids, keys, doc, first, size, chunk_key)
                    doc, first, size, chunk_key = [], [], [], []
            yield out(ids, keys, doc, first, size, chunk_key)

    def out(ids, keys, doc, first, size, chunk_key) -> pa.RecordBatch:
        at = pa.array(doc, pa.int64())
        return pa.RecordBatch.from_arrays(
            [ids.take(at), keys.take(at), pa.array(first, pa.int32()), pa.array(size, pa.int32()),
             pa.array(chunk_key, pa.binary())], ["doc", "text_key", "line", "n_lines", "chunk_key"])

    return _keyed(docs, id_col, text_col).mapInArrow(
        work, "doc long, text_key long, line int, n_lines int, chunk_key binary")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("text_key"),
                       F.col(text_col).cast("binary").alias("text"))


def _chunk_bytes(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``found`` (doc, text_key, line, n_lines, chunk_key, is_first) with ``data``: all first places, and of the others
    as many as cover their lines."""
    wanted = found.groupBy(F.col("doc").alias("w_doc"), F.col("text_key").alias("w_key")).agg(
        F.sort_array(F.collect_set(F.struct("line", "n_lines", "chunk_key", "is_first"))).alias("wanted"))

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            packed = pa.array([pack(raw.as_py()) for raw in batch.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], ["doc", "text_key", "text"])

    # a text of one line has no chunk to compare
    several = _keyed(docs, id_col, text_col).where(F.contains("text", F.lit(b"\n")))
    texts = several.mapInArrow(squeeze, "doc long, text_key long, text binary").join(
        wanted, F.col("doc").eqNullSafe(F.col("w_doc")) & (F.col("text_key") == F.col("w_key"))
    ).select("doc", "text_key", "text", "wanted")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, unpack = zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdDecompressor().decompress
        for batch in batches:
            size, rows = 0, []
            for doc, key, raw, found in zip(*(batch.column(i) for i in range(4)), strict=True):
                raw, found, head = unpack(raw.as_py()), found.as_py(), (doc.as_py(), key.as_py())
                at = _begins(raw.split(b"\n"))
                copies = [c for c in found if not c["is_first"]]
                picked = cover([(c["line"], c["line"] + c["n_lines"]) for c in copies])
                for c in [c for c in found if c["is_first"]] + [copies[i] for i in picked]:
                    body = raw[at[c["line"]]:at[c["line"] + c["n_lines"]] - 1]
                    rows.append((*head, *c.values(), pack(body)))
                    size += len(body)
                if size > 16 << 20:
                    yield out(rows)
                    size, rows = 0, []
            yield out(rows)

    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_(), pa.binary()]
    names = ["doc", "text_key", "line", "n_lines", "chunk_key", "is_first", "data"]

    def out(rows) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return texts.mapInArrow(
        work, "doc long, text_key long, line int, n_lines int, chunk_key binary, is_first boolean, data binary")


def removed_chunks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, text_key, removed): chunks (line, n_lines) that hold all lines to remove, for texts that lose any.

    Rows of one id and text are one document; a null id comes before all others.
    """
    place = F.struct("doc", "line")
    keys = chunk_table(docs, id_col, text_col)
    first = (
        keys.groupBy("chunk_key").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").drop("n")
    )
    found = keys.join(first, "chunk_key").withColumn("is_first", F.col("first").eqNullSafe(place)).drop("first")
    found = store(_chunk_bytes(docs, found, id_col, text_col), "chunks")
    original = found.where("is_first").groupBy("chunk_key").agg(F.min("data").alias("original"))
    copies = found.where("not is_first").join(original, "chunk_key").where("data = original")
    return copies.groupBy("doc", "text_key").agg(F.collect_set(F.struct("line", "n_lines")).alias("removed"))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        stats: str | None = None) -> DataFrame:
    """``docs`` with the text that is left; with ``stats`` also that struct column.

    ``stats``: n_lines, n_chunks (of the first family), n_removed (runs of removed
    lines), n_removed_lines. A null text stays null and has no lines; an empty one
    has one line and stays; texts and lines may be of any length. Rows with one id
    and text are treated alike. Other columns stay as they are.
    """
    row_tag(docs, id_col, text_col)
    removed = removed_chunks(docs, id_col, text_col)
    own_id, own_key, gone, report = (free_name(docs, n) for n in ("own_id", "own_key", "gone", "report"))
    report = stats or report
    keyed = docs.drop(report).withColumns({own_id: F.col(id_col).cast("long"), own_key: F.xxhash64(text_col)})
    removed = removed.select(F.col("doc").alias("r_doc_"), F.col("text_key").alias("r_key_"), F.col("removed").alias(gone))
    joined = keyed.join(
        removed, F.col(own_key).eqNullSafe(F.col("r_key_")) & F.col(own_id).eqNullSafe(F.col("r_doc_")), "left"
    ).drop("r_doc_", "r_key_", own_id, own_key)
    at, gone_at = joined.columns.index(text_col), joined.columns.index(gone)
    ddl = "struct<n_lines:bigint,n_chunks:bigint,n_removed:bigint,n_removed_lines:bigint>"
    schema = joined.withColumn(text_col, F.col(text_col).cast("string")).withColumn(
        report, F.lit(None).cast(ddl)).drop(gone).schema
    kind = pa.struct([(n, pa.int64()) for n in ("n_lines", "n_chunks", "n_removed", "n_removed_lines")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = [], []
            for text, numbers in zip(batch.column(at), batch.column(gone_at).to_pylist(), strict=True):
                raw = text.as_py()
                if raw is None:
                    texts.append(None)
                    found.append((0, 0, 0, 0))
                    continue
                lines = raw.encode().split(b"\n")
                keep = np.ones(len(lines), bool)
                for c in numbers or ():
                    keep[c["line"]:c["line"] + c["n_lines"]] = False
                left = [x for x, stays in zip(lines, keep.tolist(), strict=True) if stays]
                texts.append(b"\n".join(left).decode() if numbers else raw)
                runs = np.count_nonzero(~keep & np.concatenate([[True], keep[:-1]]))
                found.append((len(lines), len(cut(lines)), runs, len(lines) - len(left)))
            columns = {n: c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != gone}
            columns[text_col] = pa.array(texts, pa.string())
            columns[report] = pa.array(
                [dict(zip(("n_lines", "n_chunks", "n_removed", "n_removed_lines"), x, strict=True)) for x in found], kind)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    out = joined.mapInArrow(work, schema)
    return out if stats else out.drop(report)


def clean_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str = "n_chars") -> DataFrame:
    """``docs`` with what ``drop_repeated_lines`` leaves, without those of which nothing but blanks is left.

    Texts that lose nothing stay whatever they are. A column ``count_col`` gets the new number of characters of
    texts that lost any.
    """
    stats = free_name(docs, "found")
    out = drop_repeated_lines(docs, id_col, text_col, stats)
    lost = F.col(f"{stats}.n_removed") > 0
    out = out.where(~lost | F.rlike(text_col, F.lit(r"[^\x09-\x0D\x20]")))
    if count_col in docs.columns:
        kind = docs.schema[count_col].dataType
        out = out.withColumn(count_col, F.when(lost, F.length(text_col).cast(kind)).otherwise(F.col(count_col)))
    return out.where(F.col(text_col).isNotNull() | ~lost).drop(stats)


def op10_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return drop_repeated_lines(docs, stats="found").select(
        "doc_id", "found.*", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def oracle() -> str:
    return r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL),
    h AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM l),
    r AS (SELECT *, lead(line) OVER w AS next, lead(h) OVER w AS next_h, (coalesce(lag(h) OVER w, 0) * 31 + h) % 4294967296 AS r FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
    b AS (SELECT *, coalesce(r < lag(r) OVER w AND r < lead(r) OVER w AND lead(i, 2) OVER w > 0, false)::INT AS ends FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
    c AS (SELECT *, sum(ends) OVER (PARTITION BY doc_id ORDER BY i) - ends AS chunk FROM b),
    k AS (SELECT doc_id, min(i) AS a, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS body FROM c GROUP BY doc_id, chunk),
    p AS (SELECT doc_id, a, n, body FROM k WHERE n > 1 UNION
        SELECT doc_id, i, 2, line || chr(10) || next FROM r WHERE next IS NOT NULL AND h % 64 <> next_h % 64),
    f AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, a) > 1
        AND regexp_matches(body, '[^\x09-\x0D\x20]') AS gone FROM p),
    g AS (SELECT DISTINCT doc_id, unnest(range(a, a + n)) AS i FROM f WHERE gone),
    m AS (SELECT l.doc_id, l.i, line, g.i IS NOT NULL AS gone, coalesce(lag(g.i) OVER (PARTITION BY l.doc_id ORDER BY l.i), 0) > 0 AS goes_on
        FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.i = g.i),
    n AS (SELECT doc_id, count(*) AS n_chunks FROM k GROUP BY doc_id)
    SELECT d.doc_id, count(m.i) AS n_lines, coalesce(any_value(n_chunks), 0)::BIGINT AS n_chunks,
        count(*) FILTER (gone AND NOT goes_on) AS n_removed, count(*) FILTER (gone) AS n_removed_lines,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY m.i) FILTER (NOT gone), '')) AS kept_sha256
    FROM documents d LEFT JOIN m USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id"""
