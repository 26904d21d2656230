"""Toxicity classifier with counterfactual regularisation.

A logistic model over words and byte 5-grams within words, each counted once
per text. It is fitted on a bounded sample of labelled texts with an L1 penalty
and one more: for every labelled text that names a group, a copy is made in
which the name is swapped for another of its kind, and the squared change of
the score's logit is penalised. A mention of a group alone then moves no score.

Scoring covers every text as a whole. The model is a sorted table of at most
``MAX_FEATURES`` 64-bit feature hashes, so no other word can be taken for a
feature, however long the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, row_tag, store, with_fields
from .exchange import runs
from .kernels import LOWERED, blocks, mix, table_of, word_hashes, words

SAMPLE_ROWS = 8000      # labelled texts that a fit uses at most
MAX_FEATURES = 20_000   # features of a model at most
MIN_DOCS = 3            # sampled texts a feature must occur in
L1 = 2e-3
COUNTERFACTUAL = 1.0    # weight of the penalty on score changes
EMPTY_WEIGHT = 0.2      # share of a clean text without features
STEPS = 400
GRAM = 5
COUNTED = 1 << 20       # features that a task counts at a time

# Names of groups; those of one line may stand for each other.
IDENTITY_TERMS = [
    "women men girls boys mothers fathers",
    "black white asian latino arab african european",
    "muslim jewish christian hindu buddhist atheist",
    "gay straight lesbian bisexual transgender",
    "immigrants refugees foreigners locals natives",
    "disabled deaf blind elderly young",
    "frauen männer mädchen jungen",
    "muslime juden christen hindus buddhisten atheisten",
    "ausländer flüchtlinge einheimische",
    "femmes hommes filles garçons",
    "musulmans juifs chrétiens bouddhistes athées",
    "immigrés réfugiés étrangers",
    "mujeres hombres niñas niños",
    "musulmanes judíos cristianos budistas ateos",
    "inmigrantes refugiados extranjeros",
]

_WORD = table_of(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))


@dataclass(frozen=True)
class Model:
    keys: np.ndarray      # sorted feature hashes
    weights: np.ndarray
    bias: float


def features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature hash, document) pairs of a block, with repeats."""
    low = LOWERED[buf]
    starts, ends, counts = words(low, offsets, _WORD)
    whole = word_hashes(low, starts, ends)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(counts))
    if len(low) < GRAM:
        return whole, doc
    size = ends - starts
    n = np.maximum(size - GRAM + 1, 0)
    at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n - starts, n)
    packed = np.zeros(len(low) - GRAM + 1, np.uint64)
    for j in range(GRAM):
        packed = (packed << np.uint64(8)) | low[j:len(low) - GRAM + 1 + j]
    return np.concatenate([whole, mix(packed[at] | np.uint64(1 << 62))]), np.concatenate([doc, np.repeat(doc, n)])


def _swapped(text: str) -> str | None:
    """The text with every group name replaced by the next of its kind; None without any."""
    after = {}
    for line in IDENTITY_TERMS:
        terms = line.split()
        after.update(zip(terms, terms[1:] + terms[:1], strict=True))
    out = re.sub(r"[^\W\d_]+", lambda m: after.get(m[0].lower(), m[0]), text)
    return out if out != text else None


def sample_features(rows: DataFrame, text_col: str, label_col: str) -> DataFrame:
    """(at, label, features, features of the swapped text or null): ``at`` ascends with the rows; hashes as bytes."""

    def unique(text: bytes) -> bytes:
        buf = np.frombuffer(text, np.uint8)
        return np.unique(features(buf, np.array([0, len(buf)]))[0]).tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            other = [_swapped(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([unique(t.encode()) for t in texts], pa.binary()),
                 pa.array([None if o is None else unique(o.encode()) for o in other], pa.binary())],
                ["at", "label", "own", "swapped"])

    rows = rows.select(F.monotonically_increasing_id(), F.col(label_col).cast("int"), text_col)
    return rows.mapInArrow(work, "at long, label int, own binary, swapped binary")


def _least(n_pos: int) -> int:
    """Texts that a feature must occur in."""
    return min(MIN_DOCS, max(1, n_pos // 4))


def _constant(n: int, n_pos: int) -> Model | None:
    """The model without both labels."""
    return Model(np.zeros(0, np.uint64), np.zeros(0), -4.0 if n_pos == 0 else 4.0) if n_pos in (0, n) else None


def _counted(found: list[np.ndarray], labels: list[int]) -> pa.RecordBatch:
    keys, place = np.unique(np.concatenate(found), return_inverse=True)
    weight = np.repeat(np.array(labels, np.int64), [len(f) for f in found])
    pos = np.bincount(place, weights=weight, minlength=len(keys)).astype(np.int64)
    return pa.RecordBatch.from_pydict({"key": pa.array(keys.view(np.int64)), "n": pa.array(np.bincount(place, minlength=len(keys))), "pos": pa.array(pos)})


def choose_features(sample: DataFrame, n: int, n_pos: int) -> np.ndarray:
    """The sorted hashes of the features that a model of the stored ``sample_features`` may use.

    Those in enough texts are ranked by how far the share of toxic texts with the feature is from that of all, in
    standard errors, ties by their hash. Only the chosen ones come to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, labels, size = [], [], 0
        for batch in batches:
            for label, own in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found.append(np.frombuffer(own.as_buffer(), np.uint64))
                labels.append(label)
                size += len(found[-1])
                if size >= COUNTED:
                    yield _counted(found, labels)
                    found, labels, size = [], [], 0
        if found:
            yield _counted(found, labels)

    base = n_pos / n
    counts = sample.select("label", "own").mapInArrow(count, "key long, n long, pos long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    df = F.col("n").cast("double")
    apart = F.abs(F.col("pos") - df * base) / F.sqrt(df * base * (1 - base))
    unsigned = F.col("key").bitwiseXOR(F.lit(-(1 << 63)))
    best = counts.where(F.col("n") >= _least(n_pos)).orderBy(apart.desc(), unsigned).limit(MAX_FEATURES).select("key")
    return np.sort(best.toArrow().column(0).to_numpy().view(np.uint64))


def _places(found: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of those features that are among the sorted ``keys``."""
    at = np.searchsorted(keys, found)
    return (at[(at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == found)] if len(keys) else at[:0]).astype(np.int32)


def sample_places(sample: DataFrame, keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray | None]]:
    """(labels, places of each text's features among ``keys``, the same of the swapped text or None), in the order of ``at``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [pa.array([None if not c.is_valid else _places(np.frombuffer(c.as_buffer(), np.uint64), keys).tobytes() for c in column], pa.binary())
                     for column in batch.columns[2:]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *cells], batch.schema.names)

    found = sample.select("at", "label", "own", "swapped").mapInArrow(work, sample.schema).toArrow().sort_by("at").combine_chunks()
    own, swapped = ([None if not c.is_valid else np.frombuffer(c.as_buffer(), np.int32) for c in found.column(i)] for i in (2, 3))
    return found.column(1).to_numpy(), own, swapped


def _matrix(places: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    rows = np.repeat(np.arange(len(places), dtype=np.int32), [len(p) for p in places])
    return rows, np.concatenate([np.zeros(0, np.int32), *places])


def fit(labels: np.ndarray, own: list[np.ndarray], swapped: list[np.ndarray | None],
        counterfactual: float = COUNTERFACTUAL) -> Model:
    """Proximal gradient descent with momentum. Without both labels the model is constant."""
    y = np.asarray(labels, np.float64)
    n, n_pos = len(y), int(y.sum())
    if constant := _constant(n, n_pos):
        return constant
    every = np.concatenate(own)
    every.sort()
    begin, end = runs(every)
    keys = every[begin[end - begin >= _least(n_pos)]]
    del every
    r, c = _matrix([_places(s, keys) for s in own])
    df = np.bincount(c, minlength=len(keys))
    pos = np.bincount(c, weights=y[r], minlength=len(keys))
    base = n_pos / n
    apart = np.abs(pos - df * base) / np.sqrt(df * base * (1 - base))
    keys = keys[np.sort(np.argsort(-apart, kind="stable")[:MAX_FEATURES])]
    return fit_places(y, [_places(s, keys) for s in own], [None if s is None else _places(s, keys) for s in swapped], keys, counterfactual)


def fit_places(labels: np.ndarray, own: list[np.ndarray], swapped: list[np.ndarray | None], keys: np.ndarray,
               counterfactual: float = COUNTERFACTUAL) -> Model:
    """The same for chosen features, by the places of each text's among ``keys``."""
    y = np.asarray(labels, np.float64)
    n, n_pos = len(y), int(y.sum())
    r, c = _matrix(own)
    pairs = [i for i, s in enumerate(swapped) if s is not None]
    sr, sc = _matrix([swapped[i] for i in pairs])
    orow, ocol = _matrix([own[i] for i in pairs])
    # rows of the difference between a text and its swapped copy
    dr, dc = np.concatenate([orow, sr]), np.concatenate([ocol, sc])
    dv = np.concatenate([np.ones(len(orow)), -np.ones(len(sr))])
    weight = np.where(y == 1, n / (2 * n_pos), n / (2 * (n - n_pos)))  # both labels count alike
    k, m = len(keys), max(1, len(pairs))
    scale = 1 / np.sqrt(np.maximum(np.bincount(c, minlength=k) / n, 1 / n))  # rare features learn as fast
    scale = np.minimum(scale, 12.0)

    def grads(w, b):
        z = np.bincount(r, weights=(w * scale)[c], minlength=n) + b
        g = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / n
        gw = np.bincount(c, weights=g[r], minlength=k)
        if pairs:
            d = np.bincount(dr, weights=dv * (w * scale)[dc], minlength=len(pairs))
            gw = gw + 2 * counterfactual / m * np.bincount(dc, weights=dv * d[dr], minlength=k)
        # a text without features counts as clean
        return gw * scale, g.sum() + EMPTY_WEIGHT / (1 + np.exp(-b))

    # the step is the inverse of a bound on the curvature, found by power iteration
    v = np.ones(k)
    norm = 1.0
    for _ in range(12):
        u = np.bincount(r, weights=(v * scale)[c], minlength=n)
        out = np.bincount(c, weights=(weight * u)[r], minlength=k) * scale / (4 * n)
        if pairs:
            d = np.bincount(dr, weights=dv * (v * scale)[dc], minlength=len(pairs))
            out = out + 2 * counterfactual / m * np.bincount(dc, weights=dv * d[dr], minlength=k) * scale
        norm = float(np.linalg.norm(out)) or 1.0
        v = out / norm
    step = 0.9 / (norm + 1.0)
    w, b, pw, pb, t = np.zeros(k), 0.0, np.zeros(k), 0.0, 1.0
    for _ in range(STEPS):
        t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
        hw, hb = w + (t - 1) / t_next * (w - pw), b + (t - 1) / t_next * (b - pb)
        gw, gb = grads(hw, hb)
        pw, pb, t = w, b, t_next
        w = hw - step * gw
        w = np.sign(w) * np.maximum(np.abs(w) - step * L1, 0)
        b = hb - step * gb
    used = np.flatnonzero(w)
    return Model(keys[used], (w * scale)[used], float(b))


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``sample_rows`` labelled texts, those with the smallest hashes of their ids.

    Rows with a null label teach nothing, null texts count as empty. No labelled
    rows give a constant low score.
    """
    rows = labelled.where(F.col(label_col).isNotNull())
    sample = rows.orderBy(F.xxhash64(F.col(id_col).cast("string")), id_col).limit(sample_rows)
    # what is counted and chosen stays with the tasks; the driver gets the places of chosen features only
    found = store(sample_features(sample, text_col, label_col), "toxicity-sample")
    n, n_pos = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if constant := _constant(n, n_pos):
        return constant
    keys = choose_features(found, n, n_pos)
    labels, own, swapped = sample_places(found, keys)
    return fit_places(labels, own, swapped, keys)


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """Add ``out_col`` (0 to 1) in place of a column of this name; all others stay. Null and empty texts get the score of no feature."""
    row_tag(docs, text_col)
    docs = docs.drop(out_col)
    at = docs.columns.index(text_col)
    schema = with_fields(docs, **{out_col: "double"})
    bits = 20
    keys, weights, bias = model.keys, model.weights, model.bias

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << bits, bool)  # most features of a text are ruled out by a glance
        seen[(keys >> np.uint64(64 - bits)).astype(np.int64)] = True
        for batch in batches:
            out = np.full(batch.num_rows, bias)
            for first, buf, offsets in blocks(batch.column(at)):
                found, doc = features(buf, offsets)
                hit = np.flatnonzero(seen[(found >> np.uint64(64 - bits)).astype(np.int64)])
                found, doc = found[hit], doc[hit]
                place = np.minimum(np.searchsorted(keys, found), max(0, len(keys) - 1))
                same = keys[place] == found if len(keys) else np.zeros(0, bool)
                pair = np.unique(doc[same] * (len(keys) + 1) + place[same])
                np.add.at(out, first + pair // (len(keys) + 1), weights[pair % (len(keys) + 1)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(1 / (1 + np.exp(-np.clip(out, -40, 40))))], [*batch.schema.names, out_col])

    return docs.mapInArrow(work, schema)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn_from_tables(docs: DataFrame, labels: DataFrame) -> Model:
    """Labels of rows that are not held out, joined to their texts."""
    known = labels.where(~held_out() & F.col("toxic").isNotNull()).select("doc_id", "toxic").dropDuplicates(["doc_id"])
    # the sample is chosen from the labels, so that only its texts are looked up
    known = known.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(SAMPLE_ROWS)
    texts = docs.select("doc_id", "text")
    return learn(texts.join(F.broadcast(known), "doc_id"))  # at most SAMPLE_ROWS rows of two numbers


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without those scored at or above ``threshold``."""
    name = free_name(docs, "toxicity")
    scored = score(docs, learn_from_tables(docs, labels), out_col=name)
    return scored.where(F.col(name) < threshold).drop(name)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn_from_tables(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
