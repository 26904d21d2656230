"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent byte n-grams (1 to 3 bytes
within a word, a blank at both ends). A text gets the language whose profile is
nearest by out-of-place distance: the sum, over the text's own most frequent
n-grams, of how many places each is away from its place in the profile.

Counts cover every text that may be learned from. They combine within a task
before the shuffle; a profile has ``profile_size`` rows per language, so what
the tasks receive grows with the number of languages alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import row_tag, with_fields
from .kernels import LOWERED, blocks, table_of

PROFILE_SIZE = 400
DOC_SIZE = 300
UNKNOWN = "und"
HELD_LANGS = 8  # languages whose counts a task holds before it passes them on

_LETTER = table_of(bytes([*range(0x61, 0x7B), *range(0x80, 0x100)]))
# 0 for a blank, 1..26 for letters, 27..63 for the bytes of other letters
_CODE = np.zeros(256, np.uint32)
_CODE[0x61:0x7B] = np.arange(1, 27)
_CODE[0x80:] = 27 + np.arange(128) % 37
_GRAMS = 1 << 20


def grams(text: np.ndarray) -> np.ndarray:
    """N-gram ids of a text's bytes."""
    code = _CODE[LOWERED[text]]
    code = np.concatenate([[0], code, [0]]).astype(np.uint32)
    code = code[(code > 0) | (np.concatenate([[1], code[:-1]]) > 0)]  # one blank between words
    two = (code[:-1] << 6) | code[1:]
    # a blank may stand at the ends of an n-gram only
    three = ((two[:-1] << 6) | code[2:])[code[1:-1] > 0]
    two = two[(code[:-1] > 0) | (code[1:] > 0)]
    return np.concatenate([code[code > 0] | (1 << 18), two | (1 << 19), three])


def top_grams(text: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first; ties by id."""
    found = np.sort(grams(text))
    if not len(found):
        return found
    new = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    counts = np.diff(np.append(new, len(found)))
    if len(counts) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= least
        new, counts = new[keep], counts[keep]
    order = np.argsort(-counts, kind="stable")[:size]
    return found[new[order]]


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def gram_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, gram, n) over all texts with a language; several rows per pair."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def out():
            for lang, n in held.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_pydict(
                    {"lang": pa.array([lang] * len(at), pa.string()), "gram": at.astype(np.int32), "n": n[at]})
            held.clear()

        for batch in batches:
            langs = batch.column(1).to_pylist()
            for first, buf, offsets in blocks(batch.column(0)):
                for i in range(len(offsets) - 1):
                    lang = langs[first + i]
                    if lang not in held:
                        if len(held) >= HELD_LANGS:
                            yield from out()
                        held[lang] = np.zeros(_GRAMS, np.int64)
                    found = grams(buf[offsets[i]:offsets[i + 1]])
                    if len(found) > _GRAMS // 8:
                        held[lang] += np.bincount(found, minlength=_GRAMS)
                    else:
                        np.add.at(held[lang], found, 1)
        yield from out()

    rows = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    return rows.select(F.col(text_col).cast("binary"), lang_col).mapInArrow(work, "lang string, gram int, n long")


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                   profile_size: int = PROFILE_SIZE) -> dict[str, list[int]]:
    """The most frequent n-grams of each language, most frequent first.

    Rows with a null text or language teach nothing; a language whose texts have
    no letter gets no profile; no rows give no profiles.
    """
    total = gram_counts(docs, text_col, lang_col).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    ranked = total.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))).where(F.col("rank") <= profile_size)
    found: dict[str, list[int]] = {}
    for row in sorted(ranked.select("lang", "rank", "gram").collect()):
        found.setdefault(row["lang"], []).append(row["gram"])
    return found


def identify(docs: DataFrame, profiles: dict[str, list[int]], text_col: str = "text",
             doc_size: int = DOC_SIZE) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to ``docs``, in place of columns of these names; all others stay.

    ``und`` with score 0: null texts, texts without a letter, or no profiles.
    Ties go to the language first in order. ``score`` is the gap to the second
    nearest profile as a share of its distance; with one profile, the nearness.
    """
    row_tag(docs, text_col)
    names = sorted(profiles)
    missing = max([doc_size, *(len(p) for p in profiles.values())])

    def place_table() -> np.ndarray:
        table = np.full((len(names), _GRAMS), missing, np.int16)
        for i, name in enumerate(names):
            table[i, profiles[name]] = np.arange(len(profiles[name]))
        return table

    docs = docs.drop("lang_pred", "score")
    schema = with_fields(docs, lang_pred="string", score="double")
    at = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = place_table() if names else None
        places = np.arange(doc_size)
        for batch in batches:
            preds, scores = [], []
            texts = batch.column(at)
            valid = texts.is_valid().to_pylist()
            for first, buf, offsets in blocks(texts):
                for i in range(len(offsets) - 1):
                    text = buf[offsets[i]:offsets[i + 1]]
                    top = top_grams(text, doc_size) if names and valid[first + i] else ()
                    if not len(top) or not (_LETTER[LOWERED[text]] & (text < 0x80)).any() and not _has_letter(text.tobytes()):
                        preds.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    away = np.abs(table[:, top] - places[:len(top)]).sum(1)
                    best = int(away.argmin())
                    second = min((int(a) for j, a in enumerate(away) if j != best), default=missing * len(top))
                    preds.append(names[best])
                    scores.append(1.0 - float(away[best]) / second if second else 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(preds, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(work, schema)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    profiles = learn_profiles(docs.where(~F.coalesce(held, F.lit(False))))
    # the prediction sees nothing but the text
    return identify(docs.select("doc_id", held.alias("held_out"), "text"), profiles).drop("text")
