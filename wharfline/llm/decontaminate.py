"""Benchmark decontamination by suffix arrays over the training texts.

Tasks build suffix arrays over the words of runs of training texts (shards) and
look up every suffix of every benchmark item in them. A shard's array is built
as far as it is asked for: its suffixes are sorted by their first word, and
only intervals that some item's suffix falls into are sorted by the next word,
and so on. At each depth an item's suffix is found by binary search. An interval
that is still hit at the window's length is an occurrence; going on until no
interval is hit gives the longest verbatim match at every place.

Nothing is shuffled, so a passage that a third of all texts hold is no hot key.
Items are handed to the tasks in blocks of ``BLOCK_WORDS`` words; for a larger
benchmark the texts pass through one step per block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, row_tag
from .kernels import ALNUM, LOWERED, blocks, word_hashes, words

WINDOW = 10
BLOCK_WORDS = 500_000   # benchmark words that a task holds at a time
SHARD_BYTES = 4 << 20   # text of one suffix array; a longer text has its own

_END = np.uint64(0)     # what follows the last word of a text


@dataclass(frozen=True)
class Items:
    """Suffixes of the items of one block."""

    ids: list[str]
    hashes: np.ndarray   # words of all items, each item followed by _END
    suffix: np.ndarray   # where suffixes begin that may hold a window
    item: np.ndarray     # item of each suffix
    need: np.ndarray     # words of its window


def item_words(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, n, hashes): the words of each item that has any."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, packed = [], []
            for _, buf, offsets in blocks(batch.column(1)):
                low = LOWERED[buf]
                starts, ends, counts = words(low, offsets, ALNUM)
                hashes = word_hashes(low, starts, ends)
                n += np.diff(counts).tolist()
                packed += [hashes[a:b].tobytes() for a, b in zip(counts[:-1], counts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(packed, pa.binary())], ["item", "n", "hashes"])

    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col).cast("binary"))
    return rows.mapInArrow(work, "item string, n long, hashes binary").where("n > 0")


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                block_words: int = BLOCK_WORDS, window: int = WINDOW) -> Iterator[Items]:
    """The items in blocks of about ``block_words`` words; an item is never cut."""
    held, size = [], 0
    for row in item_words(benchmark, id_col, text_col).distinct().toLocalIterator():
        if held and size + row["n"] > block_words:
            yield _items(held, window)
            held, size = [], 0
        held.append((row["item"], np.frombuffer(row["hashes"], np.uint64)))
        size += row["n"]
    if held:
        yield _items(held, window)


def _items(held: list[tuple[str, np.ndarray]], window: int) -> Items:
    ids = sorted({name for name, _ in held})
    number = {name: i for i, name in enumerate(ids)}
    parts, suffix, item, need, at = [], [], [], [], 0
    for name, hashes in held:
        w = min(window, len(hashes))
        n = len(hashes) - w + 1
        suffix.append(np.arange(at, at + n))
        item.append(np.full(n, number[name]))
        need.append(np.full(n, w))
        parts += [np.maximum(hashes, 1), np.array([_END])]
        at += len(hashes) + 1
    return Items(ids, np.concatenate(parts), *(np.concatenate(x) for x in (suffix, item, need)))


def search(text: np.ndarray, items: Items) -> tuple[list[tuple[np.ndarray, np.ndarray, int]], np.ndarray]:
    """Look up all suffixes of ``items`` in the suffix array of ``text``.

    ``text``: word hashes, each document followed by _END. Returns the
    occurrences as (places in text, items, words) and, for every place, the
    length of the longest match that begins there.
    """
    longest = np.zeros(len(text), np.int64)
    found: list[tuple[np.ndarray, np.ndarray, int]] = []
    if not len(text) or not len(items.suffix):
        return found, longest
    order = np.argsort(text)               # suffixes by their first word
    group = np.zeros(len(order), np.int64)
    key = text[order]
    tests, test_group = np.arange(len(items.suffix)), np.zeros(len(items.suffix), np.int64)
    depth = 0
    while True:
        # the next word of each test, and its interval among the suffixes of its group
        word = items.hashes[np.minimum(items.suffix[tests] + depth, len(items.hashes) - 1)]
        alive = word != _END
        tests, test_group, word = tests[alive], test_group[alive], word[alive]
        if not len(tests):
            return found, longest
        if depth:
            # order-preserving numbers make (group, next word) one sortable value
            values = np.unique(word)
            place = np.searchsorted(values, key)
            known = values[np.minimum(place, len(values) - 1)] == key
            order, group, place = order[known], group[known], place[known]
            composite = group * len(values) + place
            sort = np.argsort(composite, kind="stable")
            order, composite = order[sort], composite[sort]
            wanted = test_group * len(values) + np.searchsorted(values, word)
        else:
            composite, wanted = key, word
        low = np.searchsorted(composite, wanted, "left")
        high = np.searchsorted(composite, wanted, "right")
        hit = high > low
        tests, low, high = tests[hit], low[hit], high[hit]
        if not len(tests):
            return found, longest
        # tests with one prefix share an interval; intervals are disjoint
        bounds, test_group = np.unique(low, return_inverse=True)
        size = np.zeros(len(bounds), np.int64)
        size[test_group] = high - low
        pick = np.arange(int(size.sum())) + np.repeat(bounds - (np.cumsum(size) - size), size)
        order, group = order[pick], np.repeat(np.arange(len(bounds)), size)
        depth += 1
        longest[order] = depth
        done = np.flatnonzero(items.need[tests] == depth)
        if len(done):
            by_group = done[np.argsort(test_group[done], kind="stable")]
            names, begin = np.unique(test_group[by_group], return_index=True)
            first = np.searchsorted(group, names, "left")
            last = np.searchsorted(group, names, "right")
            for g, members in enumerate(np.split(by_group, begin[1:])):
                found.append((order[first[g]:last[g]], np.unique(items.item[tests[members]]), depth))
        key = text[np.minimum(order + depth, len(text) - 1)]
        inside = key != _END
        order, group, key = order[inside], group[inside], key[inside]


def _shard(buf: np.ndarray, offsets: np.ndarray, items: Items):
    """(words, hit words, longest match, item numbers) of each document."""
    n = len(offsets) - 1
    low = LOWERED[buf]
    starts, ends, counts = words(low, offsets, ALNUM)
    hashes = np.maximum(word_hashes(low, starts, ends), 1)
    size = np.diff(counts)
    doc = np.repeat(np.arange(n), size)
    text = np.full(len(hashes) + n, _END)
    text[np.arange(len(hashes)) + doc] = hashes
    found, longest = search(text, items)
    begin = counts[:-1] + np.arange(n)      # of each document in text
    edges = np.zeros(len(text) + 1, np.int64)
    named: list[set[int]] = [set() for _ in range(n)]
    for places, numbers, width in found:
        edges[places] += 1                  # places of one window are distinct
        edges[places + width] -= 1
        for d in np.unique(np.searchsorted(begin, places, "right") - 1):
            named[d].update(numbers.tolist())
    hit = np.cumsum(edges)[:-1] > 0
    longest_doc = np.maximum.reduceat(longest, begin) if n else longest[:0]
    return size, hit, begin, longest_doc, named


def mark(docs: DataFrame, items: Items, text_col: str, state: str) -> DataFrame:
    """Add one block's findings to the struct column ``state``.

    ``state``: n_words, hits (begin and end of runs of hit words), longest,
    items. A column of that name holds what earlier blocks have found.
    """
    had = state in docs.columns
    at = docs.columns.index(text_col)
    kind = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(pa.int64())), ("longest", pa.int64()),
                      ("items", pa.list_(pa.string()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before = batch.column(batch.schema.get_field_index(state)).to_pylist() if had else None
            out = []
            for first, buf, offsets in blocks(batch.column(at), SHARD_BYTES):
                size, hit, begin, longest, named = _shard(buf, offsets, items)
                for d, n in enumerate(size):
                    flags, names = hit[begin[d]:begin[d] + n], {items.ids[i] for i in named[d]}
                    most = int(longest[d])
                    if before is not None:
                        old = before[first + d]
                        for a, b in zip(old["hits"][::2], old["hits"][1::2], strict=True):
                            flags[a:b] = True
                        names.update(old["items"])
                        most = max(most, old["longest"])
                    runs = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
                    out.append({"n_words": int(n), "hits": runs.tolist(), "longest": most, "items": sorted(names)})
            found = pa.array(out, kind)
            kept = [i for i, name in enumerate(batch.schema.names) if name != state]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), found], [*(batch.schema.names[i] for i in kept), state])

    plain = docs.drop(state)
    ddl = "struct<n_words:bigint,hits:array<bigint>,longest:bigint,items:array<string>>"
    schema = plain.withColumn(state, F.lit(None).cast(ddl)).schema
    return docs.mapInArrow(work, schema)


def find_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 item_text: str = "text", state: str = "found", block_words: int = BLOCK_WORDS,
                 window: int = WINDOW) -> DataFrame:
    """``docs`` with the struct ``state``: n_words, hits, longest, items.

    Null and empty texts have no words and no hits; null and empty items match
    nothing; a null item id counts as the empty string; items of one id are one
    item. An empty benchmark hits nothing. Repeated rows are judged alike. A
    column named like ``state`` is replaced.
    """
    row_tag(docs, text_col)
    out, none = docs.drop(state), True
    for items in item_blocks(benchmark, id_col, item_text, block_words, window):
        out, none = mark(out, items, text_col, state), False
    return mark(out, _no_items(), text_col, state) if none else out


def _no_items() -> Items:
    none = np.zeros(0, np.int64)
    return Items([], np.zeros(0, np.uint64), none, none, none)


def n_hit(state: str = "found") -> Column:
    """Words in runs of hits: ends less begins."""
    hits = F.col(f"{state}.hits")
    return F.aggregate(F.transform(hits, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"),
                       lambda a, x: a + x)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those in which any window of any item occurs."""
    state = free_name(docs, "found")
    return find_matches(docs, benchmark, state=state).where(F.size(f"{state}.hits") == 0).drop(state)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", F.col("found.n_words").alias("n_words"), n_hit().alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("found.items"), ","), 256).alias("items_sha256"),
        (F.size("found.hits") > 0).alias("contaminated"))


def oracle() -> str:
    """Windows as joined words."""
    lower = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    split = "regexp_extract_all(" + lower + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""WITH d AS (SELECT doc_id, coalesce({split.format('text')}, []) AS w FROM documents),
    i AS (SELECT item_id, {split.format('text')} AS w FROM benchmark WHERE text IS NOT NULL),
    iw AS (SELECT item_id, len(w) AS n, least(len(w), {WINDOW}) AS size, w, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS p0
      FROM i WHERE len(w) > 0),
    win AS (SELECT DISTINCT item_id, size, array_to_string(w[p0:p0 + size - 1], ' ') AS t FROM iw),
    dw AS (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS p0
      FROM d, (SELECT DISTINCT size FROM win) WHERE len(w) >= size),
    dt AS (SELECT doc_id, size, p0, array_to_string(w[p0:p0 + size - 1], ' ') AS t FROM dw),
    hit AS (SELECT doc_id, item_id, dt.size, p0 FROM dt JOIN win ON dt.size = win.size AND dt.t = win.t),
    words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(p0, p0 + size)) AS p FROM hit) GROUP BY doc_id),
    names AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
      string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
      sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN words USING (doc_id) LEFT JOIN names USING (doc_id)"""
