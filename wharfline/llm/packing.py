"""Packing by lexical retrieval.

Texts become token ids once, stored in the shared folder. Document frequencies
of all tokens over all texts make the weights of BM25; the vocabulary bounds
their number. Texts are then put in the order of a min-hash that favours rare
tokens, wherever they were stored, so that lexically close ones lie side by
side, and every task goes through its range of that order in shards. A shard
has an inverted index; a window starts with a seed, the seed's BM25 neighbours
that are still unused follow, best first (ties in order), and the text that
does not fit is cut, its rest being the next seed. What is open at the end of a
shard goes on in the next. The last window of a task is cut into pieces whose
lengths are powers of two, which need no padding.

The order has the text's hash after the min-hash, so ranges split a min-hash
that very many texts share; neighbours are looked for within a shard.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import row_tag, store
from .kernels import LOWERED, NOT_SPACE, blocks, word_hashes, words

WINDOW = 4096
END_ID = 2                 # follows every text, by contract
SHARD_TOKENS = 1 << 20     # tokens of a shard; a longer text is one by itself
K1, B = 1.2, 0.75
TASK_SHARDS = 32           # shards of a task where there are enough of them
DENSE_SHARE = 8            # tokens in one of so many texts of a shard have a row of all its texts
FIRST_NEIGHBOURS = 64      # best ones put in order at first; the rest only when a window asks for more
CACHE_WORDS = 3_000_000    # words whose ids a worker remembers
SLOT_BITS = 18             # of the table of remembered words at first; it grows with them

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_workers: dict[str, tuple] = {}


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where printable, else one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class WordTokenizer:
    """Token ids of texts, word by word.

    The tokenizer must treat words between blanks independently and not tell
    upper from lower case, as one does that lowers its input and drops white
    space before it splits. Each distinct word is then encoded once per worker;
    the ids of a text are put together from arrays.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = [t.content for t in added.values()]
        self.mark = min(added, default=None)
        self.letters = str.maketrans(dict(enumerate(_byte_letters())))
        probe = ["word", "straße", "été", "niño", "unhappiness"]
        self.direct = [self._model(w) for w in probe] == [e.tolist() for e in self.encode(probe)]
        self._forget()

    def _forget(self):
        # known words from place 1 on
        self.keys = np.zeros(1, np.uint64)     # their hashes
        self.at = np.zeros(1, np.int64)        # where their ids begin
        self.size = np.zeros(1, np.int64)
        self.pool = np.zeros(0, np.uint32)
        self.bits = SLOT_BITS
        self.slots = np.zeros(1 << self.bits, np.int32)  # places by the leading bits of hashes, or next to them; 0 is empty

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _model(self, word: str) -> list[int]:
        mapped = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.tokenizer.model.tokenize(mapped)]

    def learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of each word's). One run of Latin letters goes to the model as it is; others take
        the whole way, in runs with a special token between them."""
        flat: list[int] = []
        size = np.zeros(len(words), np.int64)
        tokenize, rest = self.tokenizer.model.tokenize, []
        order = []  # words in the order of their ids in flat
        for i, w in enumerate(words):
            if self.direct and w.isalpha() and w.islower():  # ASCII letters alone
                found = [t.id for t in tokenize(w.decode())]
            elif self.direct and w.isascii():
                rest.append(i)
                continue
            else:
                t = w.decode("utf-8", "replace")
                t = unicodedata.normalize("NFC", t).lower() if self.direct and max(t) < "\u0250" else ""
                if not t.isalpha():
                    rest.append(i)
                    continue
                found = self._model(t)
            order.append(i)
            size[i] = len(found)
            flat += found
        parts = [np.array(flat, np.uint32)]
        texts = {i: words[i].decode("utf-8", "replace") for i in rest}
        between = self.tokenizer.id_to_token(self.mark) if self.mark is not None else None
        plain = [i for i in rest if between and not any(a in texts[i] for a in self.added)]
        for at in range(0, len(plain), 2000):
            run = plain[at:at + 2000]
            ids = self.encode([between.join(texts[i] for i in run)])[0]
            is_mark = ids == self.mark
            size[run] = np.diff(np.concatenate([[-1], np.flatnonzero(is_mark), [len(ids)]])) - 1
            parts.append(ids[~is_mark])
            order += run
        plain = set(plain)
        others = [i for i in rest if i not in plain]
        for i, ids in zip(others, self.encode([texts[i] for i in others]) if others else [], strict=True):
            size[i] = len(ids)
            parts.append(ids)
        order = np.array(order + others, np.int64)
        # back to the order of the words
        begin = np.zeros(len(words), np.int64)
        begin[order] = np.cumsum(size[order]) - size[order]
        pick = np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)
        return np.concatenate(parts)[pick], size

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Places of words by their hashes, 0 for unknown ones."""
        at = self._slot(hashes)
        place = self.slots[at]
        left = np.flatnonzero((self.keys[place] != hashes) & (place > 0))
        at = at[left]
        while len(left):
            at = (at + 1) & (len(self.slots) - 1)
            place[left] = found = self.slots[at]
            on = (self.keys[found] != hashes[left]) & (found > 0)
            left, at = left[on], at[on]
        return place

    def _enter(self, first: int) -> None:
        """Put the known words from ``first`` on in their slots; at most half of these are taken."""
        if 2 * len(self.keys) > len(self.slots):
            self.bits = (2 * len(self.keys)).bit_length()
            self.slots, first = np.zeros(1 << self.bits, np.int32), 1
        left = np.arange(first, len(self.keys), dtype=np.int32)
        at = self._slot(self.keys[first:])
        while len(left):
            free = self.slots[at] == 0
            self.slots[at[free]] = left[free]
            lost = self.slots[at] != left
            left, at = left[lost], (at[lost] + 1) & (len(self.slots) - 1)

    def _places(self, hashes: np.ndarray, words_at: Callable[[np.ndarray], list[bytes]]) -> np.ndarray:
        """Places of words among the known ones; unknown ones are learned first."""
        place = self._find(hashes)
        new = np.flatnonzero(place == 0)
        if len(new):
            keys, one = np.unique(hashes[new], return_index=True)
            if len(self.keys) + len(keys) > CACHE_WORDS:
                self._forget()
                new = np.arange(len(hashes))
                keys, one = np.unique(hashes, return_index=True)
            found, size = self.learn(words_at(new[one]))
            first, at = len(self.keys), len(self.pool) + np.cumsum(size) - size
            self.pool = np.concatenate([self.pool, found])
            self.keys, self.at, self.size = np.concatenate([self.keys, keys]), np.concatenate([self.at, at]), np.concatenate([self.size, size])
            self._enter(first)
            place[new] = self._find(hashes[new])
        return place

    def ids(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids before each text)."""
        low = LOWERED[buf]
        starts, ends, counts = words(buf, offsets, NOT_SPACE)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        # special tokens differ by case, so words that may hold one stay as they are
        for i in np.unique(np.searchsorted(starts, np.flatnonzero(buf == 0x3C), "right") - 1):
            low[starts[i]:ends[i]] = buf[starts[i]:ends[i]]
        # a comma or full stop after a letter is a word by itself
        last = low[ends - 1]
        before = low[np.maximum(ends - 2, 0)]
        stop = (ends - starts > 1) & ((last == 0x2C) | (last == 0x2E)) & (before >= 0x61) & (before <= 0x7A)
        owner = np.repeat(np.arange(len(starts)), 1 + stop)
        tail = np.concatenate([[False], owner[1:] == owner[:-1]])
        begin = np.where(tail, ends[owner] - 1, starts[owner])
        end = np.where(tail | ~stop[owner], ends[owner], ends[owner] - 1)
        hashes = word_hashes(low, begin, end)
        raw = low.tobytes()
        cut = lambda new: [raw[a:b] for a, b in zip(begin[new].tolist(), end[new].tolist(), strict=True)]
        place = self._places(hashes, cut)
        size = self.size[place]
        total = np.concatenate([[0], np.cumsum(size)])
        pick = np.arange(total[-1]) + np.repeat(self.at[place] - total[:-1], size)
        return self.pool[pick], total[np.searchsorted(owner, counts)]


def _tokenizer(path: str) -> WordTokenizer:
    """One per worker process, kept between tasks."""
    if path not in _workers:
        _workers.clear()
        _workers[path] = WordTokenizer(path)
    return _workers[path]


def token_table(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids): 16-bit ids where all fit, else 32-bit; ``end_id`` at the end."""
    row_tag(docs, id_col, text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path)
        for batch in batches:
            for first, buf, offsets in blocks(batch.column(1)):
                ids, at = tokenizer.ids(buf, offsets)
                packed = [pack_ids(np.append(ids[a:b], np.uint32(end_id))) for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(packed)), pa.array(packed, pa.binary())], ["doc_id", "ids"])

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary"))
    return rows.mapInArrow(work, "doc_id long, ids binary")


def pack_ids(ids: np.ndarray) -> bytes:
    narrow = len(ids) == 0 or int(ids.max()) < 1 << 16
    return (b"\x02" if narrow else b"\x04") + ids.astype("<u2" if narrow else "<u4").tobytes()


def unpack_ids(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if raw[:1] == b"\x02" else "<u4", offset=1).astype(np.uint32)


def token_weights(tokens: DataFrame) -> tuple[np.ndarray, float]:
    """(BM25 weight of each token id, mean length) over all texts. At most one number per vocabulary entry."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(1 << 16, np.int64)
        n = total = 0
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                ids = unpack_ids(raw)
                n, total = n + 1, total + len(ids)
                own = np.unique(ids)
                if own[-1] >= len(df):
                    df = np.concatenate([df, np.zeros(int(own[-1]) + 1 - len(df), np.int64)])
                df[own] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({
            "term": pa.array([-2, -1, *at.tolist()], pa.int64()), "n": pa.array([n, total, *df[at].tolist()], pa.int64())})

    counts = tokens.select("ids").mapInArrow(work, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    terms, n = found.column("term").to_numpy(), found.column("n").to_numpy()
    docs, total = int(n[terms == -2].sum()), int(n[terms == -1].sum())
    keep = terms >= 0
    df = np.zeros(int(terms.max(initial=0)) + 1)
    df[terms[keep]] = n[keep]
    return np.log1p((docs - df + 0.5) / (df + 0.5)).astype(np.float32), total / max(1, docs)


def text_places(tokens: DataFrame, idf: np.ndarray) -> DataFrame:
    """Add ``place``: a min-hash of a text's distinct tokens, in which a token counts by the fourth power of its weight.

    The same token of two texts has the same rank, so texts that share their rare tokens mostly share the least one.
    """
    tag = (np.arange(len(idf), dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    uniform = ((tag ^ (tag >> np.uint64(29))) >> np.uint64(11)).astype(np.float64) / 2.0**53
    draw = -np.log1p(-uniform) / np.maximum(idf.astype(np.float64), 1e-9) ** 4
    rank = np.empty(len(idf), np.int32)
    rank[np.argsort(draw, kind="stable")] = np.arange(len(idf))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [int(rank[unpack_ids(raw)].min()) for raw in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], ["doc_id", "ids", "place"])

    return tokens.select("doc_id", "ids").mapInArrow(work, "doc_id long, ids binary, place long")


def task_count(tokens: DataFrame, shard_tokens: int) -> int:
    """Ranges by the size of the stored ids: ``TASK_SHARDS`` shards each, fewer where that leaves cores without one."""
    size = tokens.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    shards = size // (2 * shard_tokens) + 1
    return max(-(-shards // TASK_SHARDS), min(shards, 2 * tokens.sparkSession.sparkContext.defaultParallelism))


class _Index:
    """BM25 inverted index of one shard.

    Tokens of many texts have a row of weights of all texts, which adds up
    without scattering; these rows hold at most ``DENSE_SHARE`` numbers for each
    posting. Other tokens have lists.
    """

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        self.n = len(docs)
        length = np.array([len(d) for d in docs])
        flat = np.concatenate(docs).astype(np.int64) * self.n + np.repeat(np.arange(self.n), length)
        pairs, n = np.unique(flat, return_counts=True)
        term, doc = np.divmod(pairs, self.n)
        n = n.astype(np.float32)
        norm = (K1 * (1 - B + B * length / mean)).astype(np.float32)[doc]
        weight = idf[term] * n * np.float32(K1 + 1) / (n + norm)
        _, first, place = np.unique(term, return_index=True, return_inverse=True)
        many = np.diff(np.append(first, len(term))) * DENSE_SHARE >= self.n
        # places of a text's tokens, text by text
        order = np.argsort(doc, kind="stable")
        self.own, self.begin = place[order], np.searchsorted(doc[order], np.arange(self.n + 1))
        self.row = np.where(many, np.cumsum(many) - 1, -1)
        in_row = many[place]
        self.rows = np.zeros((int(many.sum()), self.n), np.float32)
        self.rows[self.row[place[in_row]], doc[in_row]] = weight[in_row]
        self.doc, self.posted = doc[~in_row], weight[~in_row]
        self.first = np.searchsorted(place[~in_row], np.arange(len(first) + 1))

    def scores(self, seed: int) -> np.ndarray:
        """Score of every text for all of the seed's tokens."""
        own = self.own[self.begin[seed]:self.begin[seed + 1]]
        row = self.row[own]
        score = self.rows[row[row >= 0]].sum(axis=0)
        listed = own[row < 0]
        at, size = self.first[listed], self.first[listed + 1] - self.first[listed]
        pick = np.arange(size.sum()) + np.repeat(at - (np.cumsum(size) - size), size)
        return score + np.bincount(self.doc[pick], self.posted[pick], self.n)

    def neighbours(self, seed: int, unused: np.ndarray) -> Iterator[int]:
        """Unused texts by their score for all of the seed's tokens; those without one come last, in order."""
        left = np.flatnonzero(unused)
        score = -self.scores(seed)[left]
        if len(left) > FIRST_NEIGHBOURS:
            # all as good as the last of the first ones are among them, so ties stay in order
            best = score <= np.partition(score, FIRST_NEIGHBOURS - 1)[FIRST_NEIGHBOURS - 1]
            yield from left[best][np.argsort(score[best], kind="stable")].tolist()
            left, score = left[~best], score[~best]
        yield from left[np.argsort(score, kind="stable")].tolist()


def pack(tokens: DataFrame, idf: np.ndarray, mean: float, window: int = WINDOW,
         shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``window`` is a power of two. Every id of every text lies in one piece; all
    sequences are full or have a power of two ids. Sequence ids are unique: the
    task's number and a count.
    """
    places = text_places(tokens, idf)
    # ids decide what else is equal: a task that runs again meets the same order
    ordered = places.withColumn("spread", F.xxhash64("doc_id", "ids"))
    ranges = task_count(tokens, shard_tokens)
    ordered = ordered.repartitionByRange(ranges, "place", "spread").sortWithinPartitions("place", "spread", "doc_id", "ids")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        state = {"sequence": 0, "open": []}  # open: (doc_id, doc_tokens, start, ids) of the window being filled
        rows: list[tuple] = []

        def emit(parts):
            offset = 0
            for doc_id, total, start, ids in parts:
                rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total,
                             base + state["sequence"], offset))
                offset += len(ids)
            state["sequence"] += 1

        def flush():
            columns = zip(*rows, strict=True) if rows else [[]] * 7
            names = [c.split(" ")[0] for c in _PIECES.split(", ")]
            out = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
            rows.clear()
            return out

        def close():
            """Cut what is open into runs of power-of-two lengths."""
            parts = state["open"]
            left = sum(len(p[3]) for p in parts)
            while left:
                size, taken = 1 << (left.bit_length() - 1), []
                left -= size
                while size:
                    doc_id, total, start, ids = parts.pop(0)
                    taken.append((doc_id, total, start, ids[:size]))
                    if len(ids) > size:
                        parts.insert(0, (doc_id, total, start + size, ids[size:]))
                    size -= min(size, len(ids))
                emit(taken)

        def shard(held):
            docs = [d for _, d in held]
            index = _Index(docs, idf, mean)
            unused = np.ones(len(docs), bool)
            queue: Iterator[int] = iter(())
            used, cursor = sum(len(p[3]) for p in state["open"]), 0
            while True:
                # a window takes its seed's neighbours; without a seed here, the next text in order
                pick = next((i for i in queue if unused[i]), None)
                if pick is None:
                    while cursor < len(docs) and not unused[cursor]:
                        cursor += 1
                    if cursor == len(docs):
                        return
                    pick = cursor
                    queue = index.neighbours(pick, unused)
                unused[pick] = False
                doc_id, ids, start = held[pick][0], docs[pick], 0
                while len(ids):
                    part = ids[:window - used]
                    state["open"].append((doc_id, len(docs[pick]), start, part))
                    used, start, ids = used + len(part), start + len(part), ids[len(part):]
                    if used == window:
                        emit(state["open"])
                        state["open"], used = [], 0
                        # the rest of this text, if any, is the next seed
                        queue = index.neighbours(pick, unused) if len(ids) and len(ids) < window else iter(())

        held, total = [], 0
        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = unpack_ids(raw)
                held.append((doc_id, ids))
                total += len(ids)
                if total >= shard_tokens:
                    shard(held)
                    held, total = [], 0
                    if rows:
                        yield flush()
        if held:
            shard(held)
        close()
        yield flush()

    return ordered.select("doc_id", "ids").mapInArrow(work, _PIECES)


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Pieces of all texts, see ``pack``.

    Null and empty texts have the end id alone; repeated rows are packed each;
    a null id stays null; other columns are ignored; no rows give no pieces.
    """
    tokens = store(token_table(docs, tokenizer_path, id_col, text_col, end_id), "tokens")
    idf, mean = token_weights(tokens)
    return pack(tokens, idf, mean, window, shard_tokens)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_tokenizer())
