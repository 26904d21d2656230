"""BM25 of the packing index against the formula over all tokens of a seed."""

from collections import Counter
from math import log1p

import numpy as np

from wharfline.llm import packing


def test_neighbours_by_all_tokens_of_a_seed():
    rng = np.random.default_rng(4)
    docs = [rng.integers(0, 300, n).astype(np.uint32) for n in rng.integers(60, 200, 40)]
    df = Counter(t for d in docs for t in set(d.tolist()))
    idf = np.array([log1p((len(docs) - df[t] + 0.5) / (df[t] + 0.5)) for t in range(300)], np.float32)
    mean = float(np.mean([len(d) for d in docs]))
    index = packing._Index(docs, idf, mean)
    for seed in range(len(docs)):
        def score(d):
            tf, norm = Counter(d.tolist()), packing.K1 * (1 - packing.B + packing.B * len(d) / mean)
            return sum(float(idf[t]) * tf[t] * (packing.K1 + 1) / (tf[t] + norm) for t in set(docs[seed].tolist()) if tf[t])

        unused = np.ones(len(docs), bool)
        unused[seed] = False
        scores = np.array([score(d) for d in docs])
        got = list(index.neighbours(seed, unused))
        assert sorted(got) == np.flatnonzero(unused).tolist()
        assert (np.diff(scores[got]) < 1e-3).all()


def test_neighbours_in_order_of_score_and_place():
    """More texts than are put in order at first, with ties among them."""
    rng = np.random.default_rng(5)
    docs = [rng.integers(0, 40, 12).astype(np.uint32) for _ in range(150)] * 2
    idf = rng.random(40).astype(np.float32) + 1
    index = packing._Index(docs, idf, 12.0)
    unused = rng.random(len(docs)) < 0.8
    for seed in range(0, len(docs), 17):
        score = index.scores(seed)
        left = np.flatnonzero(unused)
        assert list(index.neighbours(seed, unused)) == sorted(left.tolist(), key=lambda i: (-score[i], i))
    unused[:] = False
    assert list(index.neighbours(0, unused)) == []


def test_close_texts_meet_wherever_they_are_stored(spark):
    """Twenty topics dealt to many partitions; a shard is far smaller than the corpus."""
    rng = np.random.default_rng(6)
    topic = [rng.choice(60000, 40, replace=False) for _ in range(20)]
    rows = []
    for i in range(400):
        ids = np.append(rng.permutation(topic[i % 20])[:36], 2).astype(np.uint32)
        rows.append((i, bytearray(packing.pack_ids(ids))))
    tokens = spark.createDataFrame(rows, "doc_id long, ids binary").repartition(16)
    idf, mean = packing.token_weights(tokens)
    pieces = packing.pack(tokens, idf, mean, window=256, shard_tokens=2000).collect()
    assert sum(p.length for p in pieces) == 400 * 37
    mates = Counter()
    for p in pieces:
        mates[p.sequence_id, p.doc_id % 20] += p.length
    best = Counter()
    for (sequence, _), n in mates.items():
        best[sequence] = max(best[sequence], n)
    assert sum(best.values()) > 0.7 * 400 * 37
