"""Packs of rows, and which 64-bit keys occur in more than one of them.

A pack holds a few megabytes of rows as one compressed cell, stored in the
shared folder. Work on very many small things (grams, shingles) sends arrays of
them between packs and buckets, so that Spark shuffles thousands of cells
instead of billions of rows. Keys are dealt to buckets by their leading bits;
every pack sends a key once, however often it holds it, so that a frequent key
costs one entry per pack.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PACK_BYTES = 4 << 20
NO_ID = np.iinfo(np.int64).max   # stands for a null id, after all others
LOW_BITS = 40                    # bits of a key that travel; the bucket tells the leading ones


def bucket_count(spark: SparkSession) -> int:
    """Buckets of a key exchange: a few for every shuffle partition of the session."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_of(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of each run of equal values."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1])
    return begin, np.append(begin[1:], len(values))


def squeeze(values: np.ndarray, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(np.ascontiguousarray(values).tobytes())


def expand(raw: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype)


def text_packs(docs: DataFrame, id_col: str, text_col: str, pack_bytes: int = PACK_BYTES) -> DataFrame:
    """(pack, ids, sizes, data); null texts are empty. Store the result before use: pack numbers are made anew."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, count = TaskContext.get().partitionId() << 24, 0
        ids, texts, size = [], [], 0

        def out():
            return pa.RecordBatch.from_pydict({
                "pack": pa.array([base + count], pa.int64()),
                "ids": [squeeze(np.array(ids, np.int64))],
                "sizes": [squeeze(np.array([len(t) for t in texts], np.int64))],
                "data": [zstandard.ZstdCompressor(level=3).compress(b"".join(texts))]})

        for batch in batches:
            own = batch.column(0).fill_null(NO_ID).to_pylist()
            for i, text in zip(own, batch.column(1), strict=True):
                raw = text.as_py() or b""
                ids.append(i)
                texts.append(raw)
                size += len(raw)
                if size >= pack_bytes or len(ids) >= 1 << 16:
                    yield out()
                    ids, texts, size, count = [], [], 0, count + 1
        if ids:
            yield out()

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary"))
    return rows.mapInArrow(work, "pack long, ids binary, sizes binary, data binary")


def open_pack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, offsets, bytes) of a text pack."""
    sizes = expand(row["sizes"], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return expand(row["ids"], np.int64), offsets, expand(row["data"], np.uint8)


def _low(keys: np.ndarray) -> np.ndarray:
    return keys & np.uint64((1 << LOW_BITS) - 1)


def _narrow(keys: np.ndarray) -> bytes:
    """The travelling bits of keys, byte planes apart."""
    return np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, :LOW_BITS // 8]).tobytes()


def _widen(raw: bytes) -> np.ndarray:
    narrow = np.frombuffer(raw, np.uint8).reshape(-1, LOW_BITS // 8)
    wide = np.zeros((len(narrow), 8), np.uint8)
    wide[:, :LOW_BITS // 8] = narrow
    return wide.view(np.uint64).reshape(-1)


def codes(keys: np.ndarray, buckets: int) -> np.ndarray:
    """What two keys have in common once they have travelled: bucket and low bits."""
    return (bucket_of(keys, buckets).astype(np.uint64) << np.uint64(LOW_BITS)) | _low(keys)


def shared_keys(packs: DataFrame, keys_of: Callable[[dict], tuple[np.ndarray, np.ndarray]], buckets: int) -> DataFrame:
    """(pack, bucket, keys, counts): for each pack, those of its keys whose counts sum to 2 or more over all packs.

    ``keys_of`` gives a pack's distinct keys, ascending, with counts. Read the
    result with ``shared_codes``.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = keys_of(row)
                where = bucket_of(keys, buckets)
                at, ends = runs(where)
                counts = np.minimum(counts, 255).astype(np.uint8) if len(counts) else np.zeros(0, np.uint8)
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(where[at], pa.int64()),
                    "pack": pa.array([row["pack"]] * len(at), pa.int64()),
                    "keys": pa.array([_narrow(keys[a:b]) for a, b in zip(at, ends, strict=True)], pa.binary()),
                    "counts": pa.array([squeeze(counts[a:b]) for a, b in zip(at, ends, strict=True)], pa.binary())})

    def meet(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        packs_ = table.column("pack").to_numpy()
        keys = [_widen(k) for k in table.column("keys").to_pylist()]
        owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        counts = np.concatenate([expand(c, np.uint8) for c in table.column("counts").to_pylist()]).astype(np.int64)
        all_keys = np.concatenate(keys)
        order = np.argsort(all_keys, kind="stable")
        all_keys, counts, owner = all_keys[order], counts[order], owner[order]
        first, ends = runs(all_keys)
        total = np.repeat(np.add.reduceat(counts, first), ends - first)
        keep = total > 1
        all_keys, owner, total = all_keys[keep], owner[keep], total[keep].astype(np.uint32)
        order = np.argsort(owner, kind="stable")
        all_keys, owner, total = all_keys[order], owner[order], total[order]
        at, ends = runs(owner)
        return pa.table({
            "pack": pa.array(packs_[owner[at]], pa.int64()), "bucket": pa.array([bucket] * len(at), pa.int64()),
            "keys": pa.array([_narrow(all_keys[a:b]) for a, b in zip(at, ends, strict=True)], pa.binary()),
            "counts": pa.array([squeeze(total[a:b]) for a, b in zip(at, ends, strict=True)], pa.binary())})

    sent = packs.mapInArrow(send, "bucket long, pack long, keys binary, counts binary")
    return sent.groupBy("bucket").applyInArrow(meet, "pack long, bucket long, keys binary, counts binary")


def shared_codes(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(codes ascending, summed counts) of the rows that ``shared_keys`` made for one pack."""
    parts = [(np.uint64(b << LOW_BITS) | _widen(k), expand(c, np.uint32)) for b, k, c in zip(
        rows.column("bucket").to_pylist(), rows.column("keys").to_pylist(), rows.column("counts").to_pylist(), strict=True)]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    code, count = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(code)
    return code[order], count[order]


def members(values: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each value is in the ascending ``among``, its place there)."""
    if not len(among):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(among, values), len(among) - 1)
    return among[at] == values, at
