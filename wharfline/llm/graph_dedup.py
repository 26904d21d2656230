"""Near-duplicate vectors by a robust-pruned flat graph.

1. Equal vectors of a label become one with a weight.
2. Centroids are rows drawn by hash, about one per ``SHARD_ROWS`` vectors, so
   that dense regions get as many as their rows need. A vector belongs to the
   shard of its nearest centroid and to those hardly farther (``margin``).
3. Each shard's graph: the nearest vectors of each and some far ones, robustly
   pruned. The adjacency lists of a vector from all its shards are united.
4. Each vector is searched for in the shard of its nearest centroid: greedily
   from medoids, then on through all vectors within range.
5. Links found are verified by their cosine in double precision.
6. An audit compares the links of a bounded sample of vectors with an exact
   scan of all. Below ``MIN_RECALL`` everything is repeated with twice the
   margin, until shards that hold everything leave nothing to miss.

Link counts add up inside the shards; only a forest of links leaves them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import row_tag, store
from .components import Union, connected

THRESHOLD = 0.98
SHARD_ROWS = 400
MAX_CENTROIDS = 65_536   # centroids that tasks receive at most; beyond, shards grow
MARGIN = 0.09            # radians
DEGREE = 24              # neighbours kept by pruning
POOL = 64                # nearest vectors that pruning chooses from
FAR = 8                  # and far ones
ALPHA = 1.2
BEAM = 16
ENTRIES = 16             # medoids a search starts from
SLICE = 1 << 16          # pairs compared at a time
AUDIT_ROWS = 256         # vectors of the audit
MIN_RECALL = 0.97


def unit_vectors(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(space, vector, node, weight): one row per distinct usable vector; node is its smallest id.

    ``space`` is label and length: vectors of unequal length are not compared.
    """
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col(label_col).isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)
    own = rows.where(usable & F.col(id_col).isNotNull()).select(
        F.concat_ws("/", F.col(label_col).cast("string"), F.size(v).cast("string")).alias("space"),
        F.transform(v, lambda x: x.cast("double") + F.lit(0.0)).alias("vector"), F.col(id_col).cast("long").alias("id"))
    return own.groupBy("space", "vector").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("weight"))


def _units(column: pa.Array) -> np.ndarray:
    """Rows of unit length; scaled first, so that squares neither overflow nor vanish."""
    x = np.array(column.to_pylist(), np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def centroids(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> dict[str, tuple[np.ndarray, int]]:
    """Per space: unit centroids and the number of the first."""
    n = {r["space"]: r["n"] for r in vectors.groupBy("space").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = min(1.0, MAX_CENTROIDS / max(1, sum(math.ceil(c / shard_rows) for c in n.values())))
    out, first = {}, 0
    for space in sorted(n):
        k = max(1, int(math.ceil(n[space] / shard_rows) * share))
        drawn = vectors.where(F.col("space") == space).orderBy(F.xxhash64("node"), "node").limit(k)
        out[space] = (_units(drawn.select("vector").toArrow().column(0)), first)
        first += k
    return out


def assign(vectors: DataFrame, centres: dict[str, tuple[np.ndarray, int]], margin: float) -> DataFrame:
    """(shard, home, node, weight, unit): one row per shard of a vector."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                spaces = np.array(batch.column(0).to_pylist(), object)
                nodes, weights = batch.column(2).to_numpy(), batch.column(3).to_numpy()
                for space in set(spaces):
                    own = np.flatnonzero(spaces == space)
                    unit = _units(batch.column(1).take(pa.array(own)))
                    c, first = centres[space]
                    angle = np.arccos(np.clip(unit @ c.T, -1, 1))
                    nearest = angle.argmin(1)
                    row, shard = np.nonzero(angle <= angle.min(1, keepdims=True) + margin)
                    yield pa.RecordBatch.from_pydict({
                        "shard": pa.array(first + shard), "home": pa.array(nearest[row] == shard),
                        "node": pa.array(nodes[own][row]), "weight": pa.array(weights[own][row]),
                        "unit": pa.array([unit[i].tobytes() for i in row], pa.binary())})

    return vectors.select("space", "vector", "node", "weight").mapInArrow(
        work, "shard long, home boolean, node long, weight long, unit binary")


def build_graph(x: np.ndarray) -> np.ndarray:
    """Pruned neighbours of each row, found in blocks."""
    n, rng = len(x), np.random.default_rng(11)
    out = []
    for at in range(0, n, 512):
        sims = x[at:at + 512] @ x.T
        sims[np.arange(len(sims)), at + np.arange(len(sims))] = -2
        k = min(POOL, n - 1)
        near = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k else np.full((len(sims), 1), -1)
        out.append(np.concatenate([near, rng.integers(0, n, (len(sims), FAR))], 1))
    pool = np.concatenate(out)
    return np.concatenate([robust_prune(x, np.arange(at, min(n, at + 512)), pool[at:at + 512]) for at in range(0, n, 512)])


def robust_prune(x: np.ndarray, rows: np.ndarray, pool: np.ndarray) -> np.ndarray:
    """Up to DEGREE of each row's pool: the nearest, then the nearest not close to one already kept; -1 for none."""
    out = np.full((len(rows), DEGREE), -1, np.int64)
    safe = np.maximum(pool, 0)
    points = x[safe]
    far = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("nd,npd->np", x[rows], points)))
    far[(pool < 0) | (pool == rows[:, None])] = np.inf
    line = np.arange(len(rows))
    for k in range(DEGREE):
        best = far.argmin(1)
        some = np.isfinite(far[line, best])
        if not some.any():
            break
        kept = safe[line, best]
        out[some, k] = kept[some]
        near = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("nd,npd->np", x[kept], points)))
        far[ALPHA * near <= far] = np.inf
        far[line, best] = np.inf
    return out


def adjacency(shards: DataFrame) -> DataFrame:
    """(node, near): the neighbours of a vector from all its shards."""

    def work(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        x = np.array([np.frombuffer(u, np.float64) for u in table.column("unit").to_pylist()])
        kept = build_graph(x)
        row, col = np.nonzero(kept >= 0)
        a, b = nodes[row], nodes[kept[row, col]]
        both = np.unique(np.concatenate([np.stack([a, b], 1), np.stack([b, a], 1)]), axis=0)
        begin = np.concatenate([[0], np.flatnonzero(np.diff(both[:, 0])) + 1]) if len(both) else np.zeros(0, np.int64)
        return pa.table({"node": pa.array(both[begin, 0] if len(both) else [], pa.int64()),
                         "near": pa.array([p[:, 1].tolist() for p in np.split(both, begin[1:])] if len(both) else [],
                                          pa.list_(pa.int64()))})

    parts = shards.groupBy("shard").applyInArrow(work, "node long, near array<long>")
    return parts.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def range_search(x: np.ndarray, near: np.ndarray, queries: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, hit) row numbers, in blocks of queries. ``near``: neighbours per row, -1 for none."""
    n = len(x)
    centre = x.mean(0)
    by_centre = np.argsort(-(x @ centre), kind="stable")
    # the medoid of all, and of runs of rows from the centre outwards
    entries = np.unique(by_centre[np.linspace(0, n - 1, min(n, ENTRIES)).astype(int)])
    for at in range(0, len(queries), 256):
        q = queries[at:at + 256]
        line = np.arange(len(q))
        seen = np.zeros((len(q), n + 1), bool)
        seen[:, n] = True  # stands for no neighbour
        beam = np.broadcast_to(entries, (len(q), len(entries))).copy()
        score = x[q] @ x[entries].T
        seen[:, entries] = True
        open_ = np.ones(beam.shape, bool)
        while True:
            ranked = np.where(open_, score, -np.inf)
            best = ranked.argmax(1)
            going = np.isfinite(ranked[line, best])
            if not going.any():
                break
            node = np.where(going, beam[line, best], 0)
            open_[line, best] = False
            next_ = np.where(going[:, None], near[node], -1)
            next_ = np.where((next_ < 0) | seen[line[:, None], next_], n, next_)
            seen[line[:, None], next_] = True
            s = np.einsum("qd,qrd->qr", x[q], x[np.minimum(next_, n - 1)])
            s[next_ == n] = -np.inf
            beam, score = np.concatenate([beam, next_], 1), np.concatenate([score, s], 1)
            open_ = np.concatenate([open_, next_ < n], 1)
            if beam.shape[1] > BEAM:
                top = np.argpartition(-score, BEAM - 1, axis=1)[:, :BEAM]
                beam, score, open_ = (np.take_along_axis(m, top, 1) for m in (beam, score, open_))
        # within range: everything reachable through vectors in range, at any number
        reached = np.zeros((len(q), n + 1), bool)
        reached[:, n] = True
        row, col = np.nonzero(score >= threshold)
        query, node = line[row], beam[row, col]
        reached[query, node] = True
        reached[line, q] = True
        query, node = np.concatenate([query, line]), np.concatenate([node, q])
        tested = reached.copy()
        while len(query):
            found = []
            for i in range(0, len(query), SLICE // near.shape[1]):
                part = slice(i, i + SLICE // near.shape[1])
                a = np.repeat(query[part], near.shape[1])
                b = near[node[part]].reshape(-1)
                new = (b >= 0) & ~tested[a, b]
                pair = np.unique(a[new] * (n + 1) + b[new])
                a, b = pair // (n + 1), pair % (n + 1)
                tested[a, b] = True
                ok = np.einsum("pd,pd->p", x[q[a]], x[b]) >= threshold
                reached[a[ok], b[ok]] = True
                found.append((a[ok], b[ok]))
            query, node = (np.concatenate(m) for m in zip(*found, strict=True))
        hit_q, hit = np.nonzero(reached[:, :n])
        other = q[hit_q] != hit
        hit_q, hit = hit_q[other], hit[other]
        good = np.zeros(len(hit), bool)
        for i in range(0, len(hit), SLICE):  # the verification
            part = slice(i, i + SLICE)
            good[part] = np.einsum("pd,pd->p", x[q[hit_q[part]]], x[hit[part]]) >= threshold
        yield q[hit_q[good]], hit[good]


_FOUND = "node long, links long, a long, b long"


def search_shards(shards: DataFrame, graph: DataFrame, threshold: float) -> DataFrame:
    """(node, links, null, null) per vector and (null, null, a, b) for a forest of links."""

    def work(table: pa.Table) -> pa.Table:
        nodes, weights = table.column("node").to_numpy(), table.column("weight").to_numpy()
        home = np.flatnonzero(table.column("home").to_numpy(zero_copy_only=False))
        x = np.array([np.frombuffer(u, np.float64) for u in table.column("unit").to_pylist()])
        number = {v: i for i, v in enumerate(nodes.tolist())}
        lists = [[number[v] for v in (c or ()) if v in number] for c in table.column("near").to_pylist()]
        near = np.full((len(nodes), 2 * DEGREE), -1, np.int64)
        for i, own in enumerate(lists):
            if len(own) > near.shape[1]:  # a hub keeps its nearest; the others have it in their own lists
                own = np.array(own)[np.argsort(-(x[own] @ x[i]), kind="stable")[:near.shape[1]]]
            near[i, :len(own)] = own
        links, union, edges = np.zeros(len(nodes), np.int64), Union(len(nodes)), []
        for q, hit in range_search(x, near, home, threshold):
            np.add.at(links, q, weights[hit])
            for a, b in zip(q.tolist(), hit.tolist(), strict=True):
                if union.join(a, b):
                    edges.append((nodes[a], nodes[b]))
        none = [None] * len(edges)
        return pa.table({
            "node": pa.array(nodes[home].tolist() + none, pa.int64()), "links": pa.array(links[home].tolist() + none, pa.int64()),
            "a": pa.array([None] * len(home) + [a for a, _ in edges], pa.int64()),
            "b": pa.array([None] * len(home) + [b for _, b in edges], pa.int64())})

    return shards.join(graph, "node", "left").groupBy("shard").applyInArrow(work, _FOUND)


def audit(vectors: DataFrame, found: DataFrame, threshold: float, rows: int = AUDIT_ROWS) -> float:
    """Links found as a share of those of an exact scan, over the vectors with the smallest hashes."""
    drawn = vectors.orderBy(F.xxhash64(F.lit(1), "node"), "node").limit(rows).toArrow()
    if not drawn.num_rows:
        return 1.0
    spaces = drawn.column("space").to_pylist()
    nodes = drawn.column("node").to_pylist()
    by_space = {}
    for space in set(spaces):
        own = [i for i, s in enumerate(spaces) if s == space]
        by_space[space] = ([nodes[i] for i in own], _units(drawn.column("vector").take(pa.array(own))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = np.array(batch.column(0).to_pylist(), object)
            for space, (own, unit) in by_space.items():
                here = np.flatnonzero(seen == space)
                if len(here):
                    near = unit @ _units(batch.column(1).take(pa.array(here))).T >= threshold
                    weight = batch.column(3).to_numpy()[here]
                    yield pa.RecordBatch.from_pydict({
                        "node": pa.array(own, pa.int64()), "exact": pa.array(near @ weight, pa.int64())})

    exact = vectors.select("space", "vector", "node", "weight").mapInArrow(work, "node long, exact long") \
        .groupBy("node").agg(F.sum("exact").alias("exact"))
    # the scan counts a vector and its copies themselves
    both = exact.join(vectors.select("node", "weight"), "node").join(found.where("node is not null").select("node", "links"), "node")
    total = both.agg(F.sum(F.col("exact") - F.col("weight")).alias("e"), F.sum(F.least("links", F.col("exact") - F.col("weight"))).alias("f")).first()
    return 1.0 if not total["e"] else total["f"] / total["e"]


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 threshold: float = THRESHOLD, margin: float = MARGIN, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per row: the id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components, and
    those without a label or id, link with nothing; their component is their id.
    Repeated rows are links of each other; other columns are ignored.
    """
    row_tag(rows, id_col, vector_col, label_col)
    vectors = store(unit_vectors(rows, id_col, vector_col, label_col), "vectors")
    centres = centroids(vectors, shard_rows)
    while True:
        shards = store(assign(vectors, centres, margin), "shards")
        found = store(search_shards(shards, adjacency(shards), threshold), "found")
        if margin >= math.pi or audit(vectors, found, threshold) >= MIN_RECALL:
            break
        margin *= 2
    parts = connected(found.where("a is not null").select("a", "b"))
    links = found.where("node is not null").select("node", "links")
    joined = vectors.join(links, "node").join(parts, "node", "left").select(
        "space", "vector", F.coalesce("component", "node").alias("component"),
        (F.col("links") + F.col("weight") - 1).alias("n_links"))
    v = F.col(vector_col)
    keyed = rows.select(
        F.col(id_col).alias("id"),
        F.concat_ws("/", F.col(label_col).cast("string"), F.size(v).cast("string")).alias("space"),
        F.transform(v, lambda x: x.cast("double") + F.lit(0.0)).alias("vector"),
        (F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).alias("usable"))
    # rows that can't link meet no vector; a null vector makes a null key
    key = (keyed["space"] == joined["space"]) & (keyed["vector"] == joined["vector"]) & keyed["usable"]
    out = keyed.join(joined, key, "left").select(
        keyed["id"].alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component", keyed["id"].cast("long")).alias("component_id"))
    return out.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))


def op1_graph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def oracle() -> str:
    """All pairs of a label."""
    return f"""WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL),
    u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM v),
    l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE a.n > 0 AND b.n > 0 AND list_dot_product(a.e, b.e) / (a.n * b.n) >= {THRESHOLD}),
    r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
    m AS (SELECT a, min(b) AS m FROM r GROUP BY a), c AS (SELECT a, count(*) AS c FROM l GROUP BY a)
    SELECT vec_id, coalesce(c, 0) AS n_links, least(vec_id, m.m) AS component_id, vec_id = least(vec_id, m.m) AS kept
    FROM embeddings LEFT JOIN m ON m.a = vec_id LEFT JOIN c ON c.a = vec_id"""
