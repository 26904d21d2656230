"""Hard negatives by inner product: cover trees over norm-augmented candidates.

A candidate x becomes (x, sqrt(M^2 - |x|^2)), M the largest norm of its shard,
and an anchor q becomes (q, 0). Then |q - x|^2 = |q|^2 + M^2 - 2 q.x, so the
distance to a tree node and the node's covering radius bound the inner products
of all below it from both sides.

1. Candidates are dealt to cells by their nearest centre (a bounded sample of
   at most ``CELLS`` rows) and, within a cell and label, to shards of about
   ``SHARD_ROWS`` rows. Every row is in one shard; a hot label, cell or vector
   has more shards, not larger ones.
2. A shard becomes a cover tree: children cover what lies within half the radius
   of their parent, and each node keeps the exact radius of what it holds. Where
   the rows lie so far apart that children would hold less than ``SPLIT`` rows
   on average, the node is a leaf.
3. Anchors travel in blocks of one cell and label. Blocks meet the roots of all
   trees, both in groups of bounded size; where a root's bounds reach into a
   window of the block, block and tree meet. A task has some blocks and some
   trees, takes for each block the most promising tree first, descends
   best-first, leaves out nodes beyond the windows or below the best scores
   found so far, and computes leaves exactly.
4. This runs three times: at home (the anchor's own shard) for a first bound on
   its positives, over shards of its label for the positives, and over the
   others for negatives in the windows of the positives.

Results are exact: bounds are widened by more than their rounding, scores are
integers computed exactly. In high dimensions bounds are loose, and the search
then approaches the comparison of all anchors with all rows, in blocks.

Components are floor(256 * x), at most ``LIMIT`` in size (larger ones are set to
it, so that scores fit 64 bits for vectors of up to 8192 components). Rows with a
null vec_id take no part, nor do those with a null label or vector or a component
that is null or not finite. Of rows with the same vec_id the least by label and
vector counts. Vectors of another length than the anchor's have no score with
it. A positive score below zero has an empty window. Empty tables give no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import row_tag, store

# Fixed values of the contract.
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH, OF = 30, 90, 100
SCALE, ANCHORS, MOVED, LABELS = 256, 100, 7, 10

CELLS = 256            # most centres of cells, a bounded sample of rows
CELL_SHARDS = 4        # full shards that a cell has on average, below that bound
SHARD_ROWS = 2048
BLOCK_ROWS = 128       # anchors that travel together
LEAF_ROWS = 32
SPLIT = 8              # least rows a child holds on average
GROUP_BLOCKS = 16      # blocks that meet the trees, or the roots, of a group in one task
GROUP_TREES = 64
GROUP_ROOTS = 4096
LIMIT = 1 << 25
EXACT = float(1 << 53)
NO_BOUND = np.iinfo(np.int64).max

_TREE = ("shard long, label long, dim int, n int, norm double, radius double, center binary, "
         "ids binary, vectors binary, nodes binary, radii binary")


def take_part(rows: DataFrame) -> DataFrame:
    """vec_id, label, dim, vector (array<bigint>) of the rows that take part, once per vec_id."""
    row_tag(rows, "vec_id", "embedding", "label")
    x = F.col("embedding")
    finite = F.forall(x, lambda v: F.coalesce(~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")), F.lit(False)))
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % MOVED == 0, (label + 1) % LABELS).otherwise(label)
    whole = F.transform(x, lambda v: F.floor(F.least(F.greatest(v.cast("double") * SCALE, F.lit(-float(LIMIT))), F.lit(float(LIMIT)))))
    good = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite)
    one = good.select("vec_id", F.struct(moved.alias("label"), whole.alias("vector")).alias("row")).groupBy("vec_id").agg(
        F.min("row").alias("row"))
    return one.select("vec_id", "row.label", F.size("row.vector").alias("dim"), "row.vector")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of equal length as a matrix of float64; components are whole and small, so exact."""
    start, end = column.offsets[0].as_py(), column.offsets[-1].as_py()
    return column.values.slice(start, end - start).to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products as int64, exact."""
    if not a.shape[1]:
        return np.zeros((len(a), len(b)), np.int64)   # of empty vectors
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < EXACT:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class CoverTree:
    """Nodes of a cover tree over rows of one shard, in arrays.

    ``nodes``: for each node its centre's row, first child, number of children,
    first place and number of places in ``order``; ``radii``: the exact largest
    distance from the centre to what the node holds.
    """

    def __init__(self, vectors: np.ndarray):
        norms = (vectors * vectors).sum(1)
        self.norm = float(np.sqrt(norms.max(initial=0.0)))
        self.points = np.concatenate([vectors, np.sqrt(np.maximum(self.norm ** 2 - norms, 0.0))[:, None]], 1)
        self.order: list[int] = []
        self.nodes: list[list[int]] = []
        self.radii: list[float] = []
        middle = self.points.mean(0)
        root = int(((self.points - middle) ** 2).sum(1).argmin())
        self._grow(root, np.arange(len(vectors)))

    def _distances(self, center: int, rows: np.ndarray) -> np.ndarray:
        gap = self.points[rows] - self.points[center]
        return np.sqrt((gap * gap).sum(1))

    def _add(self, center: int, radius: float) -> int:
        self.nodes.append([center, 0, 0, 0, 0])
        self.radii.append(radius)
        return len(self.nodes) - 1

    def _cover(self, center: int, rows: np.ndarray, radius: float) -> list[tuple[int, np.ndarray, float]] | None:
        """(centre, rows, largest distance) of children, ``center`` first, then always the farthest row left; None for too many."""
        children, most = [], len(rows) // SPLIT
        while len(rows):
            if len(children) >= most:
                return None
            d = self._distances(center, rows)
            near = d <= radius
            children.append((center, rows[near], float(d[near].max())))
            rows, d = rows[~near], d[~near]
            if len(rows):
                center = int(rows[d.argmax()])
        return children

    def _grow(self, root: int, rows: np.ndarray) -> None:
        far = self._distances(root, rows)
        waiting = [(self._add(root, float(far.max())), rows)]
        while waiting:
            node, rows = waiting.pop()
            radius = self.radii[node]
            if len(rows) <= LEAF_ROWS or radius == 0.0:
                self.nodes[node][3:] = [len(self.order), len(rows)]
                self.order.extend(rows.tolist())
                continue
            children = self._cover(self.nodes[node][0], rows, radius / 2)
            if children is None:
                self.nodes[node][3:] = [len(self.order), len(rows)]
                self.order.extend(rows.tolist())
                continue
            first = len(self.nodes)
            self.nodes[node][1:3] = [first, len(children)]
            for center, own, reach in children:
                waiting.append((self._add(center, reach), own))


def _build(table: pa.Table) -> pa.Table:
    """The tree of one shard."""
    table = table.combine_chunks().sort_by("vec_id")
    dim = table.column("dim")[0].as_py()
    vectors = _matrix(table.column("vector").chunk(0), dim)
    tree = CoverTree(vectors)
    order = np.array(tree.order, np.int64)
    inverse = np.empty(len(order), np.int64)
    inverse[order] = np.arange(len(order))
    nodes = np.array(tree.nodes, np.int64)
    nodes[:, 0] = inverse[nodes[:, 0]]
    return pa.table({
        "shard": pa.array([table.column("shard")[0].as_py()], pa.int64()),
        "label": pa.array([table.column("label")[0].as_py()], pa.int64()), "dim": pa.array([dim], pa.int32()),
        "n": pa.array([len(order)], pa.int32()), "norm": [tree.norm], "radius": [tree.radii[0]],
        "center": [tree.points[tree.nodes[0][0]].tobytes()],
        "ids": [table.column("vec_id").to_numpy()[order].astype(np.int64).tobytes()],
        "vectors": [vectors[order].astype(np.int32).tobytes()], "nodes": [nodes.tobytes()],
        "radii": [np.array(tree.radii).tobytes()]})


def _centres(rows: DataFrame) -> list[tuple[int, np.ndarray]]:
    """Sampled (dim, vector), at most CELLS: those of the rows with the least hashes of their ids."""
    n = min(CELLS, -(-rows.count() // (CELL_SHARDS * SHARD_ROWS)))
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n).select("dim", "vector").collect()
    return [(r["dim"], np.array(r["vector"], np.float64)) for r in picked]


def place(rows: DataFrame) -> DataFrame:
    """Adds ``cell`` (nearest sampled centre of the same length; -1 where there is none) and ``shard``."""
    centres = _centres(rows)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cells = np.full(len(batch), -1, np.int32)
            for dim in np.unique(dims):
                known = [c for c, (d, _) in enumerate(centres) if d == dim]
                if known and dim:
                    at = np.flatnonzero(dims == dim)
                    x = _matrix(batch.column("vector").take(pa.array(at)), int(dim))
                    middle = np.array([centres[c][1] for c in known])
                    gap = (middle * middle).sum(1)[None] - 2 * (x @ middle.T)
                    cells[at] = np.array(known, np.int32)[gap.argmin(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], names=[*batch.schema.names, "cell"])

    placed = store(rows.mapInArrow(nearest, "vec_id long, label long, dim int, vector array<bigint>, cell int"), "cells")
    # a shard is a part of one cell, label and length
    sizes = placed.groupBy("cell", "label", "dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(SHARD_ROWS)).alias("parts"))
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts"))
    return placed.join(sizes, ["cell", "label", "dim"]).withColumn(
        "shard", F.xxhash64("cell", "label", "dim", part)).drop("parts")


def _open(row: dict) -> dict:
    dim = row["dim"]
    return {
        "ids": np.frombuffer(row["ids"], np.int64), "vectors": np.frombuffer(row["vectors"], np.int32).astype(np.float64).reshape(row["n"], dim),
        "nodes": np.frombuffer(row["nodes"], np.int64).reshape(-1, 5), "radii": np.frombuffer(row["radii"], np.float64), "norm": row["norm"]}


def bounds(square: np.ndarray, inner: np.ndarray, norm: float, centre_square: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) inner product of anchors with anything within ``radii`` of augmented centres.

    ``square``: the anchors' squared norms, ``inner``: their products with the
    centres, ``centre_square``: the centres' squared augmented norms.
    """
    whole = square[:, None] + norm * norm
    gap = np.sqrt(np.maximum(square[:, None] + centre_square[None] - 2 * inner, 0.0))
    slack = 1.0 + 1e-6 * (whole + centre_square[None])   # far more than the rounding of a root of a small difference
    near, far = np.maximum(gap - radii[None], 0.0), gap + radii[None]
    return (whole - far * far) / 2 - slack, (whole - near * near) / 2 + slack


NOTHING = np.zeros(0, np.int64)


def search(tree: dict, anchors: np.ndarray, ids: np.ndarray, windows: list[np.ndarray], k: int, found: list[list]) -> None:
    """Add a tree's rows to ``found``: for each anchor and each of its windows (name, low, high) the best ``k`` (scores, ids) so far, ties by smaller id.

    Best-first over the nodes: a window drops a node whose bounds lie outside
    of it or below its k-th score so far.
    """
    nodes, radii, vectors = tree["nodes"], tree["radii"], tree["vectors"]
    # an augmented candidate's norm is the shard's largest
    least, most = bounds((anchors * anchors).sum(1), anchors @ vectors[nodes[:, 0]].T, tree["norm"], np.full(len(nodes), tree["norm"] ** 2), radii)
    for i in range(len(anchors)):
        highs = windows[i][:, 2].tolist()
        floor = [max(low, int(f[0][-1])) if len(f[0]) == k else low for low, f in zip(windows[i][:, 1].tolist(), found[i], strict=True)]
        heap = [(-most[i, 0], 0)]
        while heap:
            top, node = heapq.heappop(heap)
            if -top < min(floor, default=NO_BOUND):
                break
            wanted = [w for w, (lo, hi) in enumerate(zip(floor, highs, strict=True)) if most[i, node] >= lo and least[i, node] <= hi]
            if not wanted:
                continue
            _, child, n_children, at, n = nodes[node]
            if n_children:
                for c in range(child, child + n_children):
                    heapq.heappush(heap, (-most[i, c], c))
                continue
            got, own = scores(anchors[i:i + 1], vectors[at:at + n])[0], tree["ids"][at:at + n]
            for w in wanted:
                fits = (got >= floor[w]) & (got <= highs[w]) & (own != ids[i])
                if fits.any():
                    s, who = np.concatenate([found[i][w][0], got[fits]]), np.concatenate([found[i][w][1], own[fits]])
                    best_ = np.lexsort([who, -s])[:k]
                    found[i][w] = (s[best_], who[best_])
                    if len(best_) == k:
                        floor[w] = max(floor[w], int(s[best_[-1]]))


_BLOCK = "block long, label long, dim int, anchor_ids binary, anchor_vectors binary, counts binary, windows binary"
_HIT = "anchor_id long, window long, score long, vec_id long"


def blocks(anchors: DataFrame) -> DataFrame:
    """Anchors with their windows, packed. ``anchors``: vec_id, label, dim, cell, vector and ``windows``, an array of (window, low, high)."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        dim = table.column("dim")[0].as_py()
        windows = table.column("windows").to_pylist()
        flat = np.array([[w["window"], w["low"], w["high"]] for some in windows for w in some], np.int64)
        return pa.table({
            "block": pa.array([table.column("block")[0].as_py()], pa.int64()), "label": pa.array([table.column("label")[0].as_py()], pa.int64()),
            "dim": pa.array([dim], pa.int32()), "anchor_ids": [table.column("vec_id").to_numpy().astype(np.int64).tobytes()],
            "anchor_vectors": [_matrix(table.column("vector").chunk(0), dim).astype(np.int32).tobytes()],
            "counts": [np.array([len(some) for some in windows], np.int64).tobytes()], "windows": [flat.tobytes()]})

    sizes = anchors.groupBy("cell", "label", "dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_ROWS)).alias("parts"))
    part = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("parts"))
    dealt = anchors.join(sizes, ["cell", "label", "dim"]).withColumn("block", F.xxhash64("cell", "label", "dim", part))
    return dealt.select("block", "vec_id", "label", "dim", "vector", "windows").groupBy("block").applyInArrow(pack, _BLOCK)


def _open_block(row: dict) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(ids, vectors, and for each anchor its windows as rows of name, low, high)."""
    ids = np.frombuffer(row["anchor_ids"], np.int64)
    vectors = np.frombuffer(row["anchor_vectors"], np.int32).astype(np.float64).reshape(len(ids), row["dim"])
    cuts = np.cumsum(np.frombuffer(row["counts"], np.int64))[:-1]
    return ids, vectors, np.split(np.frombuffer(row["windows"], np.int64).reshape(-1, 3), cuts)


def _reaching(block: dict, roots: dict, same: bool) -> np.ndarray:
    """The shards whose root's bounds reach into a window of the block."""
    fits = (roots["dim"] == block["dim"]) & ((roots["label"] == block["label"]) == same)
    at = np.flatnonzero(fits)
    if not len(at):
        return at
    _, vectors, windows = _open_block(block)
    centers = np.array([np.frombuffer(roots["center"][j], np.float64) for j in at])
    least, most = bounds((vectors * vectors).sum(1), vectors @ centers[:, :-1].T, roots["norm"][at], (centers * centers).sum(1), roots["radius"][at])
    hit = np.zeros(len(at), bool)
    for i, own in enumerate(windows):
        for _, low, high in own:
            hit |= (most[i] >= low) & (least[i] <= high)
    return roots["shard"][at[hit]]


def _every(n: int) -> F.Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def meet(anchors: DataFrame, trees: DataFrame, k: int, same: bool) -> DataFrame:
    """anchor_id, window, score, vec_id: for each window the best ``k`` of each group of trees, of the anchor's label or of the others."""
    packed = store(blocks(anchors), "blocks")
    lanes = max(1, -(-packed.count() // GROUP_BLOCKS))
    shards = max(1, -(-trees.count() // GROUP_ROOTS))
    lane = F.pmod(F.xxhash64("block"), F.lit(lanes)).cast("int").alias("lane")
    roots = trees.select("shard", "label", "dim", "norm", "radius", "center")

    def prune(own: pa.Table, heads: pa.Table) -> pa.Table:
        known = {c: heads.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "label", "dim", "norm", "radius", "center")}
        at, what = [], []
        for block in own.to_pylist():
            hit = _reaching(block, known, same).astype(np.int64)
            at.append(np.full(len(hit), block["block"], np.int64))
            what.append(hit)
        return pa.table({"block": np.concatenate([np.zeros(0, np.int64), *at]), "shard": np.concatenate([np.zeros(0, np.int64), *what])})

    grid = packed.select("*", lane).select("*", _every(shards).alias("part")).groupBy("lane", "part").cogroup(
        roots.withColumn("part", F.pmod(F.xxhash64("shard"), F.lit(shards)).cast("int")).select("*", _every(lanes).alias("lane"))
        .groupBy("lane", "part"))
    bundles = max(1, -(-trees.count() // GROUP_TREES))
    bundle = F.pmod(F.xxhash64("shard"), F.lit(bundles)).cast("int").alias("bundle")
    wanted = store(grid.applyInArrow(prune, "block long, shard long").select("*", lane, bundle), "pairs")

    def descend(own: pa.Table, forest: pa.Table) -> pa.Table:
        opened = {t["shard"]: _open(t) for t in forest.to_pylist()}
        results = []
        for block in own.to_pylist():
            ids, vectors, windows = _open_block(block)
            found = [[(NOTHING, NOTHING)] * len(w) for w in windows]
            for shard in _promising(vectors, [(s, opened[s]) for s in block["shards"]]):
                search(opened[shard], vectors, ids, windows, k, found)
            results.append((ids, windows, found))
        return _hits(results)

    per_block = wanted.groupBy("block", "lane", "bundle").agg(F.collect_list("shard").alias("shards"))
    visited = wanted.select(F.col("shard").alias("there"), F.col("lane").alias("by"), F.col("bundle").alias("of")).distinct()
    there = visited.join(trees, F.col("there") == F.col("shard")).groupBy("by", "of")
    return per_block.join(packed, "block").groupBy("lane", "bundle").cogroup(there).applyInArrow(descend, _HIT)


def _promising(vectors: np.ndarray, trees: list[tuple[int, dict]]) -> list[int]:
    """Shards by the greatest inner product that their roots allow, the greatest first."""
    square = (vectors * vectors).sum(1)

    def most(tree: dict) -> float:
        center = tree["vectors"][tree["nodes"][0, 0]]
        return float(bounds(square, vectors @ center[:, None], tree["norm"], np.array([tree["norm"] ** 2]), tree["radii"][:1])[1].max())

    return [shard for shard, _ in sorted(trees, key=lambda t: -most(t[1]))]


def _hits(found: list) -> pa.Table:
    columns: list[list] = [[np.zeros(0, np.int64)] for _ in range(4)]
    for ids, windows, results in found:
        for anchor, own, per in zip(ids, windows, results, strict=True):
            for (name, _, _), (s, who) in zip(own, per, strict=True):
                for column, values in zip(columns, (np.full(len(s), anchor), np.full(len(s), name), s, who), strict=True):
                    column.append(values)
    return pa.table({n: np.concatenate(c) for n, c in zip(("anchor_id", "window", "score", "vec_id"), columns, strict=True)})


def best(hits: DataFrame, k: int) -> DataFrame:
    """Adds ``rank`` from 1 among the hits of an anchor's window, and keeps the first ``k``."""
    order = W.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    placed = store(place(store(take_part(rows), "vectors")), "shards")
    trees = store(placed.groupBy("shard").applyInArrow(_build, _TREE), "trees")
    anchors = placed.where(F.col("vec_id") % ANCHORS == 0)

    # at home: the fifth best there is a bound on the fifth best anywhere
    def window(name, low, high):
        return F.struct(name.cast("long").alias("window"), low.cast("long").alias("low"), high.cast("long").alias("high"))

    def at_home(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        picked = np.flatnonzero(table.column("vec_id").to_numpy() % ANCHORS == 0)
        x = _matrix(table.column("vector").chunk(0), table.column("dim")[0].as_py())
        floor = []
        for i in picked:
            others = np.delete(scores(x[i:i + 1], x)[0], i)
            floor.append(int(np.sort(others)[-POSITIVES]) if len(others) >= POSITIVES else -NO_BOUND)
        return pa.table({"vec_id": table.column("vec_id").take(pa.array(picked)), "floor": pa.array(floor, pa.int64())})

    floors = placed.select("shard", "vec_id", "dim", "vector").groupBy("shard").applyInArrow(at_home, "vec_id long, floor long")
    first = anchors.join(floors, "vec_id").withColumn("windows", F.array(window(F.lit(0), F.col("floor"), F.lit(NO_BOUND)))).drop("floor")
    positives = store(best(meet(first, trees, POSITIVES, same=True), POSITIVES).select(
        "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # whole scores between 30 and 90 of 100 parts of the positive's
    exact = F.col("positive_score").cast("decimal(20,0)")
    low, high = F.ceil(exact * LOW / F.lit(OF)), F.floor(exact * HIGH / F.lit(OF))
    windows = positives.where("positive_score >= 0").groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(window(F.col("positive_id"), low, high)).alias("windows"))
    negatives = best(meet(anchors.join(windows, "vec_id"), trees, NEGATIVES, same=False), NEGATIVES)
    return negatives.withColumnRenamed("window", "positive_id").join(positives, ["anchor_id", "positive_id"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives of every anchor and positive of ``embeddings``."""
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def oracle() -> str:
    return f"""
WITH good AS (
  SELECT vec_id, CASE WHEN vec_id % {MOVED} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::double)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_inner_product(a.v, b.v)::bigint AS score
  FROM good a JOIN good b ON a.vec_id % {ANCHORS} = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {POSITIVES}),
ranked AS (
  SELECT p.anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
    AND {LOW} * positive_score <= {OF} * score AND {OF} * score <= {HIGH} * positive_score)
SELECT anchor_id, positive_id, rank::int AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= {NEGATIVES}
"""
