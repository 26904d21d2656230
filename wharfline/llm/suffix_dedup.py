"""Removal of byte strings that an earlier document holds, by sorted suffixes.

Sorting every suffix of a corpus would shuffle many times its size. Two places
whose next 50 bytes are equal also agree on which 20-byte gram of these has the
least hash, so suffixes need comparing only where they begin at such an anchor,
each with the few bytes before it that its windows cover.

1. Equal texts become one; a copy with a larger id is removed as a whole.
2. Anchors that only one text holds are dropped (a key exchange between packs).
3. The suffixes at the other anchors are range-partitioned by their leading
   bytes with sampled splitters. Equal leading bytes are never parted, so a
   match can't lie across a boundary. A frequent suffix is sent once per pack.
4. A range goes through its suffixes in order. Runs of them are sorted by
   multikey quicksort on eight bytes at a time. The lengths that neighbours
   share, to the right and to the left of the anchor, tell which windows are
   equal and so the smallest id that holds each window.
5. Each text joins the windows found in smaller ids into removed spans.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import row_tag, store
from .exchange import (
    NO_ID, bucket_count, codes, expand, members, open_pack, runs, shared_codes, shared_keys, squeeze, text_packs)
from .kernels import BLOCK_BYTES, mix

SPAN = 50            # bytes of a match
GRAM = 20            # bytes of an anchor
REACH = SPAN - GRAM  # bytes that a window may have before its anchor
WIDTH = REACH + SPAN
RUN_ROWS = 40_000    # suffixes sorted at a time; more where their leading bytes are equal
SAMPLE_PACKS, SAMPLE_LEADS = 16, 4096   # packs sampled for splitters, suffixes of each

_OCCURRENCE = np.dtype([("row", "<i4"), ("place", "<i8"), ("doc", "<i8")])


def _loaded(padded: np.ndarray, at: int, n: int) -> np.ndarray:
    """The eight bytes from every place on, as one number each."""
    return np.ndarray((n,), "<u8", padded.data, at, (1,)).astype(np.uint64)


def anchors(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, anchor, anchor hash): runs of windows with one anchor.

    ``offsets`` bound the texts in ``buf``; windows lie within one text.
    """
    n = len(buf)
    none = np.zeros(0, np.int64)
    if n < SPAN:
        return none, none, none, np.zeros(0, np.uint64)
    padded = np.concatenate([buf, np.zeros(GRAM + 8, np.uint8)])
    h = mix(_loaded(padded, 0, n) * np.uint64(0x9E3779B97F4A7C15)
            + _loaded(padded, 8, n) * np.uint64(0xD6E8FEB86659FD93)
            + _loaded(padded, GRAM - 8, n) * np.uint64(0xA0761D6478BD642F))
    least, width = h.copy(), 1
    while width < REACH + 1:  # minima over REACH + 1 places by doubling
        step = min(width, REACH + 1 - width)
        least[:n - step] = np.minimum(least[:n - step], least[step:])
        width += step
    valid = np.ones(n, bool)
    for end in offsets[1:]:
        valid[max(0, end - SPAN + 1):end] = False
    change = np.concatenate([[True], (least[1:] != least[:-1]) | ~valid[:-1]])
    change[offsets[:-1][offsets[:-1] < n]] = True
    begin = np.flatnonzero(change & valid)
    if not len(begin):
        return none, none, none, np.zeros(0, np.uint64)
    stop = np.append(np.flatnonzero(change | ~valid), n)
    end = stop[np.searchsorted(stop, begin, "right")] - 1
    value = least[begin]
    out = []
    while len(begin):
        near = h[np.minimum(begin[:, None] + np.arange(REACH + 1), n - 1)] == value[:, None]
        anchor = begin + near.argmax(1)
        last = np.minimum(end, anchor)
        out.append((begin, last, anchor, value))
        more = end > anchor  # the same gram again: the windows after its first place
        begin, end, value = anchor[more] + 1, end[more], value[more]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _pieces(row: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, ids, bytes, offsets) of blocks of the chosen texts of a pack."""
    ids, offsets, data = open_pack(row)
    chosen = np.arange(len(ids)) if "rows" not in row else np.array(row["rows"], np.int64)
    first = 0
    size = np.cumsum(offsets[chosen + 1] - offsets[chosen])
    while first < len(chosen):
        base = size[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(size, base + BLOCK_BYTES, "right")))
        part = chosen[first:last]
        yield (part, ids[part], np.concatenate([data[offsets[i]:offsets[i + 1]] for i in part]),
               np.concatenate([[0], size[first:last] - base]))
        first = last


def text_table(packs: DataFrame) -> DataFrame:
    """(pack, row, doc, n_bytes, text_key) of every text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, offsets, data = open_pack(row)
                n = len(ids)
                yield pa.RecordBatch.from_pydict({
                    "pack": pa.array([row["pack"]] * n, pa.int64()), "row": pa.array(range(n), pa.int32()),
                    "doc": pa.array(ids), "n_bytes": pa.array(np.diff(offsets)),
                    "text_key": pa.array([hashlib.sha256(data[a:b]).digest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)])})

    return packs.mapInArrow(work, "pack long, row int, doc long, n_bytes long, text_key binary")


def _anchor_keys(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Distinct anchor hashes of a pack and how many of its texts have each."""
    found = [np.zeros(0, np.uint64)]
    for _, _, buf, offsets in _pieces(row):
        _, _, anchor, value = anchors(buf, offsets)
        doc = np.searchsorted(offsets, anchor, "right")
        order = np.lexsort((doc, value))
        value, doc = value[order], doc[order]
        new = np.concatenate([[True], (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])])[:len(value)]
        found.append(value[new])
    return np.unique(np.concatenate(found), return_counts=True)


_SUFFIX = "part long, pack long, body binary, before binary, windows binary, seen binary, places binary"


def splitters(packs: DataFrame, parts: int) -> np.ndarray:
    """Leading bytes that part all suffixes about evenly, from a bounded sample of packs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, offsets, data = open_pack(row)
                at = anchors(data, offsets)[2]
                at = at[:: max(1, len(at) // SAMPLE_LEADS)]
                yield pa.RecordBatch.from_pydict({"lead": pa.array([data[i:i + GRAM].tobytes() for i in at], pa.binary())})

    # numbers alone are sorted; whole packs would meet in one task
    drawn = packs.select("pack").orderBy(F.xxhash64("pack"), "pack").limit(SAMPLE_PACKS).collect()
    some = packs.where(F.col("pack").isin([r["pack"] for r in drawn]))
    leads = np.sort(np.array(some.mapInArrow(work, "lead binary").toArrow().column(0).to_pylist(), f"S{GRAM}"))
    at = np.linspace(0, len(leads), parts + 1)[1:-1].astype(int)
    return np.unique(leads[at]) if len(leads) else leads


def _suffixes(buckets: int, bounds: np.ndarray):
    """A pack's suffixes at shared anchors, equal ones as one with all their places; one cell per range of leading bytes."""

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        bodies, before, windows, seen, cells = [], [], [], [], []
        shared, _ = shared_codes(right)
        row = left.to_pylist()[0] if left.num_rows else {"rows": None}
        if row["rows"] and len(shared):
            for part, ids, buf, offsets in _pieces(row):
                first, last, anchor, value = anchors(buf, offsets)
                keep = members(codes(value, buckets), shared)[0]
                first, last, anchor = first[keep], last[keep], anchor[keep]
                at = anchor[:, None] + np.arange(-REACH, SPAN)
                body = buf[np.clip(at, 0, len(buf) - 1)]
                body[(at < first[:, None]) | (at >= last[:, None] + SPAN)] = 0
                bodies.append(body)
                before.append(anchor - first)
                windows.append(last - first + 1)
                own = np.searchsorted(offsets, first, "right") - 1
                place = np.zeros(len(first), _OCCURRENCE)
                place["row"], place["place"], place["doc"] = part[own], first - offsets[own], ids[own]
                seen.append(place)
        if sum(map(len, bodies)):
            # ordered from the anchor on, then by what lies before it
            key = np.concatenate([np.concatenate(bodies), np.concatenate(before)[:, None].astype(np.uint8),
                                  np.concatenate(windows)[:, None].astype(np.uint8)], 1)
            order = multikey_order(np.roll(key, -REACH, axis=1))
            key, place = key[order], np.concatenate(seen)[order]
            begin = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(1)]))
            size = np.diff(np.append(begin, len(key)))
            key, ends = key[begin], np.cumsum(size)
            lead = np.ascontiguousarray(key[:, REACH:REACH + GRAM]).view(f"S{GRAM}").reshape(-1)
            where = np.searchsorted(bounds, lead, "right")
            for a, b in zip(*runs(where), strict=True):
                cells.append((int(where[a]), row["pack"], squeeze(key[a:b, :WIDTH]), squeeze(key[a:b, WIDTH]),
                              squeeze(key[a:b, WIDTH + 1]), squeeze(size[a:b]), squeeze(place[ends[a] - size[a]:ends[b - 1]])))
        kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 5)
        columns = list(zip(*cells, strict=True)) or [[]] * 7
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                        names=[c.split(" ")[0] for c in _SUFFIX.split(", ")])

    return work


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Order of byte rows, ties looked at eight bytes further on each round."""
    pad = -rows.shape[1] % 8
    wide = np.ascontiguousarray(np.pad(rows, ((0, 0), (0, pad)))).view(">u8").astype(np.uint64)
    order = np.argsort(wide[:, 0], kind="stable")
    group = np.cumsum(np.concatenate([[0], wide[order[1:], 0] != wide[order[:-1], 0]]))
    for level in range(1, wide.shape[1]):
        size = np.bincount(group)
        tied = np.flatnonzero(size[group] > 1)
        if not len(tied):
            break
        own, g = order[tied], group[tied]
        sort = np.lexsort((wide[own, level], g))
        own = own[sort]  # groups keep their places, since g is ascending
        order[tied] = own
        word = wide[own, level]
        split = np.zeros(len(order), np.int64)
        split[tied[1:]] = (g[1:] == g[:-1]) & (word[1:] != word[:-1])
        group = group + np.cumsum(split)
    return order


def _common(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Leading bytes that each row shares with the one before it in order."""
    apart = rows[order[1:]] != rows[order[:-1]]
    return np.concatenate([[0], np.where(apart.any(1), apart.argmax(1), rows.shape[1])])


def least_holders(body: np.ndarray, before: np.ndarray, windows: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each suffix and each distance of a window's begin before its anchor: the smallest id that holds the window.

    NO_ID where the suffix has no such window.
    """
    right, left = body[:, REACH:], body[:, :REACH][:, ::-1]
    r_order, l_order = multikey_order(right), multikey_order(left)
    r_common, l_common = _common(right, r_order), _common(left, l_order)
    out = np.full((len(body), REACH + 1), NO_ID, np.int64)
    r_class, l_class = np.zeros(len(body), np.int64), np.zeros(len(body), np.int64)
    for j in range(REACH + 1):
        own = np.flatnonzero((before >= j) & (before - windows + 1 <= j))
        if not len(own):
            continue
        # equal windows: the same j bytes before the anchor and the same SPAN - j after
        r_class[r_order] = np.cumsum(r_common < SPAN - j)
        l_class[l_order] = np.cumsum(l_common < j)
        both = r_class[own] * (len(body) + 1) + l_class[own]
        order = np.argsort(both)
        begin, end = runs(both[order])
        out[own[order], j] = np.repeat(np.minimum.reduceat(doc[own[order]], begin), end - begin)
    return out


_COVERED = "pack long, spans binary"
_SPAN_ROW = np.dtype([("row", "<i4"), ("begin", "<i8"), ("end", "<i8")])


def _covered(body, before, windows, pack, owner, place) -> tuple[np.ndarray, np.ndarray]:
    """(pack, span) of what lies in windows of smaller ids. ``owner``: the suffix of each place, ascending."""
    doc = np.minimum.reduceat(place["doc"], np.searchsorted(owner, np.arange(len(body))))
    least = least_holders(body, before, windows, doc)
    some = least.min(1)[owner] < place["doc"]  # most places have no smaller holder at all
    owner, place = owner[some], place[some]
    # windows in text order: the first begins farthest before the anchor
    step = np.arange(REACH + 1)
    at = before[owner][:, None] - step
    hit = (at >= 0) & (step < windows[owner][:, None])
    hit &= np.take_along_axis(least[owner], np.maximum(at, 0), 1) < place["doc"][:, None]
    edge = np.diff(np.pad(hit.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    up, down = np.argwhere(edge == 1), np.argwhere(edge == -1)
    spans = np.zeros(len(up), _SPAN_ROW)
    spans["row"], spans["begin"] = place["row"][up[:, 0]], place["place"][up[:, 0]] + up[:, 1]
    spans["end"] = place["place"][down[:, 0]] + down[:, 1] - 1 + SPAN
    return pack[owner[up[:, 0]]], spans


def _meet(table: pa.Table) -> pa.Table:
    """Goes through the suffixes of a range of leading bytes in their order."""
    opened = lambda name, dtype: [expand(c, dtype) for c in table.column(name).to_pylist()]
    body = np.concatenate(opened("body", np.uint8)).reshape(-1, WIDTH)
    before, windows = (np.concatenate(opened(c, np.uint8)).astype(np.int64) for c in ("before", "windows"))
    seen = opened("seen", np.int64)
    pack = np.repeat(table.column("pack").to_numpy(), [len(x) for x in seen])
    seen, places = np.concatenate(seen), np.concatenate(opened("places", _OCCURRENCE))
    ends = np.cumsum(seen)
    order = multikey_order(body[:, REACH:REACH + GRAM])
    lead = body[order, REACH:REACH + GRAM]
    new = np.append(np.flatnonzero((lead[1:] != lead[:-1]).any(1)) + 1, len(order))
    packs, spans, start = [np.zeros(0, np.int64)], [np.zeros(0, _SPAN_ROW)], 0
    while start < len(order):
        # a run ends where the leading bytes change
        stop = int(new[min(np.searchsorted(new, start + RUN_ROWS), len(new) - 1)])
        own = order[start:stop]
        owner = np.repeat(np.arange(len(own)), seen[own])
        pick = np.arange(len(owner)) + np.repeat((ends - seen)[own] - (np.cumsum(seen[own]) - seen[own]), seen[own])
        p, found = _covered(body[own], before[own], windows[own], pack[own], owner, places[pick])
        packs.append(p)
        spans.append(found)
        start = stop
    pack, spans = np.concatenate(packs), np.concatenate(spans)
    order = np.argsort(pack, kind="stable")
    pack, spans = pack[order], spans[order]
    return pa.table({"pack": pa.array([int(pack[a]) for a, _ in zip(*runs(pack), strict=True)], pa.int64()),
                     "spans": pa.array([squeeze(spans[a:b]) for a, b in zip(*runs(pack), strict=True)], pa.binary())})


_RESULT = "pack long, row int, n_removed long, spans array<long>, kept_sha256 string"


def _cut(with_kept: bool):
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, removed, spans, digests, kept = [], [], [], [], []
        if left.num_rows:
            row = left.to_pylist()[0]
            _, offsets, data = open_pack(row)
            found = [expand(s, _SPAN_ROW) for s in right.column("spans").to_pylist()]
            found = np.concatenate(found or [np.zeros(0, _SPAN_ROW)])
            found = found[np.argsort(found["row"], kind="stable")]
            by_row = {int(found["row"][a]): found[a:b] for a, b in zip(*runs(found["row"]), strict=True)}
            for i in row["rows"]:
                text = data[offsets[i]:offsets[i + 1]]
                own, flat = by_row.get(i), []
                if own is not None:
                    order = np.argsort(own["begin"], kind="stable")
                    begin, end = own["begin"][order], np.maximum.accumulate(own["end"][order])
                    new = np.concatenate([[True], begin[1:] > end[:-1]])
                    begin, end = begin[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]
                    flat = np.stack([begin, end], 1).reshape(-1).tolist()
                    gone = np.zeros(len(text) + 1, np.int64)
                    gone[begin] += 1
                    gone[end] -= 1
                    text = text[np.cumsum(gone)[:-1] == 0]
                rows.append(i)
                removed.append(sum(flat[1::2]) - sum(flat[::2]))
                spans.append(flat)
                digests.append(hashlib.sha256(text).hexdigest())
                kept.append(text.tobytes() if with_kept else None)
        columns = {"pack": pa.array([row["pack"]] * len(rows) if rows else [], pa.int64()), "row": pa.array(rows, pa.int32()),
                   "n_removed": pa.array(removed, pa.int64()), "spans": pa.array(spans, pa.list_(pa.int64())),
                   "kept_sha256": pa.array(digests, pa.string())}
        return pa.table(columns | ({"kept": pa.array(kept, pa.binary())} if with_kept else {}))

    return work


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False) -> DataFrame:
    """One row per row of ``docs``: the id, n_bytes, n_removed, spans (begin and end of each), kept_sha256.

    With ``with_kept`` also ``kept``, the remaining bytes. Null texts are empty;
    texts below 50 bytes lose nothing; rows of one id never remove bytes of each
    other, so repeated rows have equal results; a null id comes after all others;
    other columns are ignored.
    """
    row_tag(docs, id_col, text_col)
    buckets = bucket_count(docs.sparkSession)
    packs = store(text_packs(docs, id_col, text_col), "packs")
    table = store(text_table(packs), "texts")
    reps = table.groupBy("text_key").agg(F.min(F.struct("doc", "pack", "row")).alias("r"))
    rows = reps.groupBy("r.pack").agg(F.sort_array(F.collect_list("r.row")).alias("rows"))
    chosen = packs.join(rows, "pack")
    shared = shared_keys(packs, _anchor_keys, buckets)
    suffixes = chosen.groupBy("pack").cogroup(shared.groupBy("pack")).applyInArrow(
        _suffixes(buckets, splitters(packs, buckets)), _SUFFIX)
    spans = suffixes.groupBy("part").applyInArrow(_meet, _COVERED)
    schema = _RESULT + (", kept binary" if with_kept else "")
    # nothing is stored in between, so that both cogroups read one shuffle of the packs
    result = chosen.groupBy("pack").cogroup(spans.groupBy("pack")).applyInArrow(_cut(with_kept), schema)
    by_text = reps.select("text_key", F.col("r.doc").alias("first"), F.col("r.pack").alias("pack"), F.col("r.row").alias("row")) \
        .join(result, ["pack", "row"]).drop("pack", "row")
    copy = (F.col("doc") > F.col("first")) & (F.col("n_bytes") >= SPAN)
    whole = F.array(F.lit(0).cast("long"), F.col("n_bytes"))
    return table.join(by_text, "text_key").select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias(id_col), "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, whole).otherwise(F.col("spans")).alias("spans"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
        *([F.when(copy, F.lit(b"")).otherwise(F.col("kept")).alias("kept")] if with_kept else []))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_bytes", "n_removed", (F.size("spans") / 2).cast("long").alias("n_spans"), "kept_sha256")
