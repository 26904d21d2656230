"""Byte-level BPE: texts to token ids by ranked merges, and ids back to bytes.

The merges are Spark higher-order functions over the bytes of distinct words;
the ranks are one literal of the plan.

1. ``regexp_extract_all`` cuts texts into words (the pattern's matches). Tasks
   gather documents into packs of ``PACK_BYTES``, give each distinct word of a
   pack a code, and store codes and words, compressed.
2. The words of all packs meet in buckets of about ``BUCKET_BYTES``, one row for
   each distinct word with the packs that hold it. ``encode_word`` folds the
   merges over the bytes of each such row.
3. Ids go back to the packs, where the documents are put together.

What is shuffled are a pack's distinct words, not the words of all texts, so a
very frequent word is one entry a pack. A task holds one pack or one bucket; a
longer text is a pack of its own.

Bytes are written as characters of ISO 8859-1, one for each, so that they can be
split, joined and looked up as strings.

Null and empty texts have no tokens. Rows that repeat, in part or whole, are
documents of their own; an empty table gives an empty one. Other columns are not
looked at.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from wharfline.sources.bucketed import write_buckets
from wharfline.workdir import new_dir

from .common import arrow_rows, row_tag
from .exchange import bucket_of, expand, runs, squeeze
from .kernels import column_bytes, word_hashes

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
PACK_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20
DECODED_ROWS = 256
TEXT_ROWS = 512       # texts that go to a task's Python at a time
SLOT_BITS = 17        # of the literal hash table of ranks; vocabularies of up to 60,000 tokens fit
LATIN = "ISO-8859-1"


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _slots(keys: list[str]) -> list[int]:
    """A hash table of the keys' numbers with two places for each key, by the low and the high bits of its crc32; -1 is empty."""
    size = 1 << SLOT_BITS
    places = [((c := zlib.crc32(k.encode())) % size, c >> (32 - SLOT_BITS)) for k in keys]
    slots = [-1] * size
    for number in range(len(keys)):
        held, at = number, places[number][0]
        for _ in range(500):
            held, slots[at] = slots[at], held
            if held < 0:
                break
            # what was here goes to its other place
            at = places[held][1] if places[held][0] == at else places[held][0]
        else:
            raise ValueError("the vocabulary is too large for SLOT_BITS")
    return slots


def rank_table(ranks: dict[bytes, int]) -> Column:
    """The rank map as a literal struct: ``tokens`` by rank, and ``slots`` that lead from a token to its rank.

    Spark looks a key up in a map literal by going through it; here two places
    are enough. The literal's text is parsed once, when the plan is made.
    """
    tokens = [""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token.decode(LATIN)
    text = json.dumps({"tokens": tokens, "slots": _slots(tokens)})
    return F.from_json(F.lit(text), "struct<tokens:array<string>,slots:array<int>>")


def _rank(table: Column, key: Column) -> Column:
    """Rank of a byte string; null if it has none or is null."""
    slots, tokens = table["slots"], table["tokens"]

    def found(k: Column, c: Column) -> Column:
        first = slots[c.bitwiseAND((1 << SLOT_BITS) - 1).cast("int")]
        second = slots[F.shiftright(c, 32 - SLOT_BITS).cast("int")]
        return F.when(F.get(tokens, first) == k, first).when(F.get(tokens, second) == k, second)

    return _bind(key, lambda k: _bind(F.crc32(k), lambda c: found(k, c)))


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def _merge(state: Column, table: Column) -> Column:
    """Join the neighbours of least rank, the leftmost of them; only the ranks beside them are looked up anew.

    ``state`` has parts and, for each part, the rank of it joined with its right neighbour.
    """
    parts, ranks = state["parts"], state["ranks"]

    def joined(at: Column, new: Column) -> Column:
        left = F.when(at > 1, F.array(_rank(table, F.concat(parts[at - 2], new)))).otherwise(F.array().cast("array<int>"))
        right = F.array(_rank(table, F.concat(new, F.get(parts, at + 1))))
        size = F.size(parts)
        return F.struct(
            F.concat(F.slice(parts, F.lit(1), at - 1), F.array(new), F.slice(parts, at + 2, size)).alias("parts"),
            F.concat(F.slice(ranks, F.lit(1), F.greatest(at - 2, F.lit(0))), left, right, F.slice(ranks, at + 2, size)).alias("ranks"))

    at = F.array_position(ranks, F.array_min(ranks)).cast("int")
    merged = lambda i: _bind(F.concat(parts[i - 1], parts[i]), lambda new: joined(i, new))
    return _bind(at, lambda i: F.when(i.isNull(), state).otherwise(merged(i)))


def encode_word(word: Column, table: Column) -> Column:
    """``array<int>``: the ids of one word, given as byte characters; null for null, empty for ''.

    A word that is a token is that token. Otherwise the fold has a round for
    every byte but one; rounds after the last merge change nothing. A round
    goes through the parts once, so a word of n bytes takes n*n steps.
    """

    def whole(ranks: Column) -> Column:
        parts = F.split(word, "")
        start = F.struct(
            parts.alias("parts"),
            F.zip_with(parts, F.slice(parts, F.lit(2), F.size(parts)), lambda a, b: _rank(ranks, F.concat(a, b))).alias("ranks"))
        folded = F.aggregate(
            F.slice(parts, F.lit(2), F.size(parts)), start, lambda state, _: _merge(state, ranks),
            lambda state: F.transform(state["parts"], lambda p: _rank(ranks, p)))
        token = _rank(ranks, word)
        return F.when(word == "", F.array().cast("array<int>")).when(token.isNotNull(), F.array(token)).otherwise(folded)

    return _bind(table, whole)


def words_of(text: Column, pattern: str) -> Column:
    """``array<string>``: the pattern's matches from left to right; none for null.

    ``(?U)`` gives blanks their Unicode meaning, as tiktoken's engine does. Letters
    and digits are those of the JVM's Unicode version.
    """
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?U)" + pattern), F.lit(0))


def _planes(codes: np.ndarray, level: int = 3) -> bytes:
    """Codes by byte planes, the small ones of frequent words close together."""
    return squeeze(codes.astype(np.uint32).view(np.uint8).reshape(-1, 4).T, level)


def _codes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(expand(raw, np.uint8).reshape(4, -1).T).view(np.uint32).reshape(-1)


def _words(row: dict) -> pa.Array:
    sizes = expand(row["sizes"], np.int32)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    text = zstandard.ZstdDecompressor().decompress(row["words"])
    return pa.Array.from_buffers(pa.string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(text)])


def _packed(words: pa.Array) -> dict:
    text, at = column_bytes(words) if len(words) else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
    return {"sizes": [squeeze(np.diff(at).astype(np.int32), 3)], "words": [squeeze(text[at[0]:at[-1]], 3)]}


def _to_packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs of documents: ids, numbers of words, words as codes by frequency, the distinct words in order and their codes."""
    number = TaskContext.get().partitionId() << 24
    ids, counts, values, size = [], [], [], 0

    def pack() -> pa.RecordBatch:
        coded = pa.concat_arrays(values).dictionary_encode()
        places = coded.indices.to_numpy(zero_copy_only=False)
        code = np.empty(len(coded.dictionary), np.uint32)
        code[np.argsort(-np.bincount(places, minlength=len(code)), kind="stable")] = np.arange(len(code))
        order = pc.sort_indices(coded.dictionary)
        return pa.RecordBatch.from_pydict({
            "pack": pa.array([number], pa.int64()), "ids": [pa.concat_arrays(ids).to_pylist()],
            "counts": [squeeze(np.concatenate(counts).astype(np.int64))], "codes": [_planes(code[places], 6)],
            "code_of": [_planes(code[order.to_numpy()])], **_packed(coded.dictionary.take(order))}, schema=_PACK)

    for batch in batches:
        column = batch.column(1)
        starts = column.offsets.to_numpy().astype(np.int64)
        at = column_bytes(column.values)[1] if len(column.values) else np.zeros(1, np.int64)
        first = 0
        while first < len(column):
            sizes = at[starts[first + 1:]] - at[starts[first]]
            last = min(len(column), first + 1 + int(np.searchsorted(sizes, PACK_BYTES - size)))
            ids.append(batch.column(0).slice(first, last - first))
            counts.append(np.diff(starts[first:last + 1]))
            values.append(column.values.slice(starts[first], starts[last] - starts[first]))
            size += int(sizes[last - first - 1])
            first = last
            if size >= PACK_BYTES:
                yield pack()
                ids, counts, values, size, number = [], [], [], 0, number + 1
                pa.default_memory_pool().release_unused()
    if ids:
        yield pack()


_PACK = pa.schema([("pack", pa.int64()), ("ids", pa.list_(pa.int64())), *((n, pa.binary()) for n in ("counts", "codes", "code_of", "sizes", "words"))])
_PACK_SQL = "pack long, ids array<bigint>, counts binary, codes binary, code_of binary, sizes binary, words binary"


def _send(buckets: int):
    """A pack's words dealt to buckets, in order, each with its place among the pack's words."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = _words(row)
                if not len(words):
                    continue
                text, at = column_bytes(words)
                bucket = bucket_of(word_hashes(text, at[:-1], at[1:]), buckets)
                order = np.argsort(bucket, kind="stable")
                for a, b in zip(*runs(bucket[order]), strict=True):
                    own = order[a:b]
                    yield pa.RecordBatch.from_pydict({
                        "bucket": pa.array([bucket[own[0]]], pa.int64()), "pack": pa.array([row["pack"]], pa.int64()),
                        "places": [squeeze(np.diff(own, prepend=0).astype(np.int32), 3)], **_packed(words.take(pa.array(own)))})

    return send


def _meet(table: pa.Table) -> pa.Table:
    """Each distinct word of a bucket, in order, with the packs and places where it is."""
    cells = table.to_pylist()
    words = pa.concat_arrays([_words(c) for c in cells])
    place = np.concatenate([np.cumsum(expand(c["places"], np.int32)) for c in cells])
    pack = np.repeat([c["pack"] for c in cells], [len(expand(c["places"], np.int32)) for c in cells])
    coded = words.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    word = rank[coded.indices.to_numpy(zero_copy_only=False)]
    by_word = np.argsort(word, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(order)))])
    spots = pa.StructArray.from_arrays([pa.array(pack[by_word], pa.int64()), pa.array(place[by_word], pa.int32())], names=["pack", "place"])
    rows = pa.table({"word": coded.dictionary.take(order), "spots": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spots)})
    return pa.Table.from_batches(rows.to_batches(max_chunksize=10_000), rows.schema)


def _list_parts(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(sizes, values) of a list array that may be a slice."""
    starts = column.offsets.to_numpy()
    return np.diff(starts), column.values.slice(starts[0], starts[-1] - starts[0])


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``flat[start:start + size]`` one after the other."""
    before = np.cumsum(sizes) - sizes
    return flat[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


def _to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each pack, one cell with the places and ids of its words in a batch."""
    for batch in batches:
        if not len(batch):
            continue
        n_spots, spots = _list_parts(batch.column("spots"))
        n_ids, ids = _list_parts(batch.column("ids"))
        ids, pack, place = ids.to_numpy().astype(np.uint32), spots.field(0).to_numpy(), spots.field(1).to_numpy()
        word, at = np.repeat(np.arange(len(batch)), n_spots), np.cumsum(n_ids) - n_ids
        order = np.lexsort([place, pack])
        for a, b in zip(*runs(pack[order]), strict=True):
            own = order[a:b]
            w = word[own]
            yield pa.RecordBatch.from_pydict({
                "pack": pa.array([pack[own[0]]], pa.int64()), "places": [squeeze(np.diff(place[own], prepend=0).astype(np.int32), 3)],
                "n_ids": [squeeze(n_ids[w].astype(np.int32), 3)], "ids": [_planes(_gather(ids, at[w], n_ids[w]))]})


def _pieces(ranks: dict[bytes, int]) -> list[bytes]:
    pieces = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    return pieces


def _decoded(column: pa.Array, pieces: pa.Array) -> pa.Array:
    """The concatenated pieces of each cell of little-endian 32-bit ids; null for null."""
    raw, at = column_bytes(column)
    ids = np.frombuffer(raw[at[0]:at[-1]].tobytes(), "<u4")
    lists = pa.LargeListArray.from_arrays(pa.array((at - at[0]) // 4, pa.int64()), pieces.take(pa.array(ids)))
    return pc.if_else(pc.is_null(column), pa.scalar(None, pa.binary()), pc.binary_join(lists, pa.scalar(b"", pa.binary()))).cast(pa.binary())


def _put_together(pieces: list[bytes] | None):
    """Documents of one pack from the cells of its words, decoded where pieces are given."""

    def put(packs: pa.Table, cells: pa.Table) -> pa.Table:
        pack = packs.to_pylist()[0]
        code_of = _codes(pack["code_of"]).tolist()
        ids = [b""] * len(code_of)
        for cell in cells.to_pylist():
            raw, at = _codes(cell["ids"]).tobytes(), 0
            ends = (4 * np.cumsum(expand(cell["n_ids"], np.int32).astype(np.int64))).tolist()
            for place, end in zip(np.cumsum(expand(cell["places"], np.int32)).tolist(), ends, strict=True):
                ids[code_of[place]] = raw[at:end]
                at = end
        codes, encoded, at = _codes(pack["codes"]), [], 0
        for n in expand(pack["counts"], np.int64).tolist():
            encoded.append(b"".join([ids[c] for c in codes[at:at + n].tolist()]))
            at += n
        rows = pa.table({"doc_id": pa.array(pack["ids"], pa.int64()), "n_tokens": pa.array([len(e) // 4 for e in encoded], pa.int64()),
                         "ids": pa.array(encoded, pa.binary())})
        batches = rows.to_batches(max_chunksize=DECODED_ROWS)
        if pieces is not None:
            known = pa.array(pieces, pa.binary())
            batches = [pa.RecordBatch.from_arrays([*b.columns, _decoded(b.column("ids"), known)], names=[*b.schema.names, "decoded"]) for b in batches]
        return pa.Table.from_batches(batches)

    return put


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     path: str | None = None, pattern: str = public_tokenizers.PATTERN, decoded: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids: the token ids of each text as little-endian unsigned 32-bit numbers in a binary cell.

    ``path`` names the vocabulary file. With ``decoded`` the ids are decoded in the
    same tasks, as ``decode_documents`` does it, to a column of that name.
    """
    row_tag(docs, id_col, text_col)
    spark, ranks = docs.sparkSession, read_ranks(path or public_tokenizers.path(VOCABULARY))
    cut = docs.select(F.col(id_col).cast("long"), words_of(F.col(text_col), pattern))
    # in buckets, so that the codes are not shuffled when the ids come back to them
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with arrow_rows(spark, TEXT_ROWS):
        packs = write_buckets(cut.mapInArrow(_to_packs, _PACK_SQL), new_dir(spark, "bpe-packs"), ["pack"], n, gather=False)
    n_bytes = packs.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    buckets = 1 + 3 * n_bytes // BUCKET_BYTES   # words are stored in about a third of their bytes
    sent = packs.select("pack", "sizes", "words").mapInArrow(_send(buckets), "bucket long, pack long, places binary, sizes binary, words binary")
    met = sent.groupBy("bucket").applyInArrow(_meet, "word string, spots array<struct<pack:bigint,place:int>>")
    latin = F.decode(F.encode("word", "UTF-8"), LATIN)
    encoded = met.select("spots", encode_word(latin, rank_table(ranks)).alias("ids"))
    cells = encoded.mapInArrow(_to_cells, "pack long, places binary, n_ids binary, ids binary")
    return packs.drop("words", "sizes").groupBy("pack").cogroup(cells.groupBy("pack")).applyInArrow(
        _put_together(_pieces(ranks) if decoded else None), "doc_id long, n_tokens long, ids binary" + (", decoded binary" if decoded else ""))


def decode_documents(encoded: DataFrame, ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """Adds ``decoded``: the concatenated bytes of the ids that a binary cell holds; null for null."""
    ranks = read_ranks(path or public_tokenizers.path(VOCABULARY))
    row_tag(encoded, ids_col)
    pieces = _pieces(ranks)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(pieces, pa.binary())
        for batch in batches:
            for first in range(0, len(batch), DECODED_ROWS):
                some = batch.slice(first, DECODED_ROWS)
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, _decoded(some.column(ids_col), known)], names=[*some.schema.names, "decoded"])

    return encoded.mapInArrow(decode, StructType([*encoded.schema.fields, StructField("decoded", BinaryType())]))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and of decoded bytes of every document."""
    docs = encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), decoded=True)
    return docs.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
