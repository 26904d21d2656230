"""Jaccard join of word n-gram sets by prefix trees.

1. Texts become packs; each text's n-grams are hashed to 64 bits. Texts with
   equal sets are one set from here on, named by a hash of the set.
2. A set with a similar one shares most of its members, so about half of the
   few smallest hashes that each of the two sends. Sets of which fewer occur
   elsewhere than any similar set is sure to send too are done.
3. Document frequencies of all n-grams of the remaining sets give the global
   order, rare ones first. N-grams that occur once match nothing and only count.
4. Sets that share an n-gram of their rare prefixes are candidates if bounds on
   length and on the difference (from 512-bit parity sketches, which never
   underrate) allow it. Candidate sets form clusters.
5. Each cluster stores its sets, globally ordered with frequent n-grams first,
   in a prefix tree and is joined by walking it: a path's overlap is shared by
   all sets below, and a subtree is left when what remains can't reach the
   bound. Large clusters are joined in blocks.

Within a group of copies a set that has been linked isn't compared again, so
that n similar sets cost about n comparisons, and no link is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, row_tag, store
from .components import Union, connected
from .exchange import (
    bucket_count, bucket_of, codes, expand, members, open_pack, runs, shared_codes, shared_keys, squeeze, text_packs)
from .kernels import BLOCK_BYTES, LOWERED, NOT_SPACE, shingle_hashes, word_hashes, words

BLOCK_TOKENS = 4 << 20     # n-grams that one task of the tree join holds of a cluster
SKETCH_WORDS = 8           # 64-bit words of a parity sketch


def sets_of(ids: np.ndarray, offsets: np.ndarray, data: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ascending distinct n-gram hashes) of the texts of a pack."""
    n, first = len(ids), 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, "right")) - 1
        last = min(n, max(first + 1, last))
        low = LOWERED[data[offsets[first]:offsets[last]]]
        own = offsets[first:last + 1] - offsets[first]
        starts, ends, counts = words(low, own, NOT_SPACE)
        grams, at = shingle_hashes(word_hashes(low, starts, ends), counts, k)
        for i in range(last - first):
            yield first + i, np.unique(grams[at[i]:at[i + 1]])
        first = last


def prefix_size(n, num: int, den: int):
    """How many members of a set of n, in any one order, every similar set shares at least one of."""
    return n - -(-num * n // den) + 1


def overlap_needed(total, num: int, den: int):
    """Least intersection of two similar sets whose sizes sum to ``total``."""
    return -(-num * total // (num + den))


def _set_id(grams: np.ndarray) -> int:
    return int.from_bytes(hashlib.md5(grams.tobytes()).digest()[:8], "little", signed=True)


def set_table(packs: DataFrame, k: int) -> DataFrame:
    """(pack, row, doc, n, sid) of every text; sid is null for an empty set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, offsets, data = open_pack(row)
                found = [(len(g), _set_id(g) if len(g) else None) for _, g in sets_of(ids, offsets, data, k)]
                n = len(ids)
                yield pa.RecordBatch.from_pydict({
                    "pack": pa.array([row["pack"]] * n, pa.int64()), "row": pa.array(range(n), pa.int32()),
                    "doc": pa.array(ids), "n": pa.array([x for x, _ in found], pa.int64()),
                    "sid": pa.array([s for _, s in found], pa.int64())})

    return packs.mapInArrow(work, "pack long, row int, doc long, n long, sid long")


def _with_parts(packs: DataFrame, shared: DataFrame, work, schema: str) -> DataFrame:
    return packs.groupBy("pack").cogroup(shared.groupBy("pack")).applyInArrow(work, schema)


def probe_size(n, num: int, den: int):
    """How many of its smallest members a set of n sends."""
    return np.minimum(n, 2 * (n - -(-num * n // den)) + 1)


@lru_cache(maxsize=1 << 16)
def probes_shared(n: int, num: int, den: int) -> int:
    """How many of the members that a set of n sends any similar set sends too, at least.

    The r smallest members that two sets have in common are among the r + d
    smallest of a set with d members that the other one lacks.
    """
    other = np.arange(-(-num * n // den), den * n // num + 1)
    common = np.minimum(overlap_needed(n + other, num, den), np.minimum(n, other))
    both = np.minimum(probe_size(n, num, den) - (n - common), probe_size(other, num, den) - (other - common))
    return int(both.min())


def candidate_sets(packs: DataFrame, rows: DataFrame, k: int, num: int, den: int, buckets: int) -> DataFrame:
    """(pack, sids, sizes, grams): sets of the chosen ``rows`` that share enough of their smallest hashes with others.

    Each sends about twice as many as a similar set may lack, so that about half of them occur elsewhere.
    """

    def probe_keys(row):
        parts = [g[:probe_size(len(g), num, den)] for _, g in sets_of(*open_pack(row), k)]
        return np.unique(np.concatenate(parts or [np.zeros(0, np.uint64)]), return_counts=True)

    def keep(left: pa.Table, right: pa.Table) -> pa.Table:
        kept = []
        if left.num_rows:
            shared, _ = shared_codes(right)
            row = left.to_pylist()[0]
            own = set(row["rows"])
            for i, g in sets_of(*open_pack(row), k):
                if i in own and len(g):
                    probed = g[:probe_size(len(g), num, den)]
                    if members(codes(probed, buckets), shared)[0].sum() >= probes_shared(len(g), num, den):
                        kept.append(g)
        return pa.table({
            "pack": pa.array([row["pack"]] if kept else [], pa.int64()),
            "sids": pa.array([squeeze(np.array([_set_id(g) for g in kept], np.int64))] if kept else [], pa.binary()),
            "sizes": pa.array([squeeze(np.array([len(g) for g in kept], np.int64))] if kept else [], pa.binary()),
            "grams": pa.array([squeeze(np.concatenate(kept))] if kept else [], pa.binary())})

    shared = shared_keys(packs, probe_keys, buckets)
    return _with_parts(packs.join(rows, "pack"), shared, keep, "pack long, sids binary, sizes binary, grams binary")


def _open_sets(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return expand(row["sids"], np.int64), expand(row["sizes"], np.int64), expand(row["grams"], np.uint64)


def ordered_sets(packs: DataFrame, num: int, den: int, buckets: int) -> DataFrame:
    """(sid, n, n_grams, n_prefix, grams): shared n-grams, frequent first; the last ``n_prefix`` are the rare prefix.

    Sets whose whole prefix is unshared are left out.
    """

    def all_keys(row):
        return np.unique(_open_sets(row)[2], return_counts=True)

    def order(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows:
            shared, counts = shared_codes(right)
            sids, sizes, grams = _open_sets(left.to_pylist()[0])
            found, at = members(codes(grams, buckets), shared)
            for sid, n, begin in zip(sids.tolist(), sizes.tolist(), (np.cumsum(sizes) - sizes).tolist(), strict=True):
                mine = found[begin:begin + n]
                own, df = grams[begin:begin + n][mine], counts[at[begin:begin + n][mine]]
                prefix = prefix_size(n, num, den) - (n - len(own))
                if prefix > 0:
                    own = own[np.lexsort((own, -df.astype(np.int64)))]
                    out.append((sid, n, len(own), min(prefix, len(own)), own.tobytes()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        columns = list(zip(*out, strict=True)) or [[]] * 5
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                        names=["sid", "n", "n_grams", "n_prefix", "grams"])

    return _with_parts(packs, shared_keys(packs, all_keys, buckets), order,
                       "sid long, n long, n_grams long, n_prefix long, grams binary")


def sketch(grams: np.ndarray) -> np.ndarray:
    """Parity of the members per bit; two sketches differ in at most as many bits as the sets do in members."""
    bits = np.bincount((grams >> np.uint64(13)).astype(np.int64) % (64 * SKETCH_WORDS), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.uint64)


def _group_edges(n, unique, sketches, num, den, union: Union, members_: np.ndarray) -> list[tuple[int, int]]:
    """Joins the sets of one posting list that may be similar; a set that has been reached is not compared again."""
    edges = []
    left = members_
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            total = n[x] + n[left]
            most = total - 2 * overlap_needed(total, num, den)
            apart = np.bitwise_count(sketches[left] ^ sketches[x]).sum(1).astype(np.int64) + unique[x] + unique[left]
            near = (apart <= most) & (np.minimum(n[x], n[left]) * den >= np.maximum(n[x], n[left]) * num)
            for y in left[near].tolist():
                if union.join(x, y):
                    edges.append((x, y))
                queue.append(y)
            left = left[~near]
    return edges


def candidate_edges(ordered: DataFrame, num: int, den: int, buckets: int) -> DataFrame:
    """(a, b) of sids: a forest per bucket over sets that may be similar."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, owner, sids, ns, unique, sketches = [], [], [], [], [], []
            for i, row in enumerate(batch.to_pylist()):
                grams = np.frombuffer(row["grams"], np.uint64)
                mine = grams[len(grams) - row["n_prefix"]:]
                keys.append(mine)
                owner.append(np.full(len(mine), i))
                sids.append(row["sid"])
                ns.append(row["n"])
                unique.append(row["n"] - row["n_grams"])
                sketches.append(sketch(grams))
            if not keys:
                continue
            key, own = np.concatenate(keys), np.concatenate(owner)
            where = bucket_of(key, buckets)
            sort = np.argsort(where, kind="stable")
            key, own, where = key[sort], own[sort], where[sort]
            sids, ns, unique, sketches = np.array(sids), np.array(ns), np.array(unique), np.array(sketches)
            cells = []
            for a, b in zip(*runs(where), strict=True):
                sets, place = np.unique(own[a:b], return_inverse=True)
                cells.append((int(where[a]), squeeze(key[a:b]), squeeze(place.astype(np.int64)), squeeze(sids[sets]),
                              squeeze(ns[sets]), squeeze(unique[sets]), squeeze(sketches[sets])))
            kinds = (pa.int64(), *[pa.binary()] * 6)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*cells, strict=True), kinds, strict=True)],
                ["bucket", "keys", "place", "sids", "n", "unique", "sketches"])

    def meet(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        sizes = [len(expand(r["sids"], np.int64)) for r in rows]
        begin = np.cumsum(sizes) - sizes
        keys = np.concatenate([expand(r["keys"], np.uint64) for r in rows])
        place = np.concatenate([expand(r["place"], np.int64) + b for r, b in zip(rows, begin, strict=True)])
        sids, n, unique = (np.concatenate([expand(r[c], np.int64) for r in rows]) for c in ("sids", "n", "unique"))
        sketches = np.concatenate([expand(r["sketches"], np.uint64).reshape(-1, SKETCH_WORDS) for r in rows])
        sort = np.argsort(keys, kind="stable")
        keys, place = keys[sort], place[sort]
        union, edges = Union(len(sids)), []
        for a, b in zip(*runs(keys), strict=True):
            if b - a > 1:
                group = place[a:b]
                roots = {union.find(x) for x in group.tolist()}
                if len(roots) > 1:  # else they hang together already
                    edges += _group_edges(n, unique, sketches, num, den, union, group)
        pairs = np.array(edges, np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(sids[pairs[:, 0]], pa.int64()), "b": pa.array(sids[pairs[:, 1]], pa.int64())})

    sent = ordered.mapInArrow(
        send, "bucket long, keys binary, place binary, sids binary, n binary, unique binary, sketches binary")
    return sent.groupBy("bucket").applyInArrow(meet, "a long, b long")


class Tree:
    """Prefix tree of ordered sets; a node is a run of members that all sets below it have in common.

    Nodes are arrays, level by level, so that a search moves through all open
    nodes of a level at once.
    """

    def __init__(self, sets: list[np.ndarray]):
        every = np.concatenate(sets)
        values, inverse, n = np.unique(every, return_inverse=True, return_counts=True)
        # members that most sets have come first, so that beginnings are shared
        rank = np.empty(len(values), np.int64)
        rank[np.lexsort((values, -n))] = np.arange(len(values))
        self.n_ranks = len(values)
        self.sets = [np.sort(r) for r in np.split(rank[inverse], np.cumsum([len(s) for s in sets])[:-1])]
        order = sorted(range(len(sets)), key=lambda i: self.sets[i].tolist())
        parent, begin, end, longest, holder = [-1], [0], [0], [0], [order[0]]
        self.node_of = np.zeros(len(sets), np.int64)
        path, last = [0], None  # nodes from the root to the set before
        for i in order:
            own, shared = self.sets[i], 0
            if last is not None:
                m = min(len(own), len(last))
                apart = np.flatnonzero(own[:m] != last[:m])
                shared = int(apart[0]) if len(apart) else m
            while begin[path[-1]] >= shared and len(path) > 1:
                path.pop()
            top = path[-1]
            if end[top] > shared:  # the run is cut: its first part becomes a node above it
                parent.append(parent[top])
                begin.append(begin[top])
                end.append(shared)
                longest.append(longest[top])
                holder.append(holder[top])
                path[-1] = parent[top] = len(parent) - 1
                begin[top] = shared
            if len(own) > shared:
                parent.append(path[-1])
                begin.append(shared)
                end.append(len(own))
                longest.append(len(own))
                holder.append(i)
                path.append(len(parent) - 1)
            for node in path:
                longest[node] = max(longest[node], len(own))
            self.node_of[i] = path[-1]
            last = own
        self.end, self.longest = np.array(end), np.array(longest)
        up, size = np.array(parent), self.end - np.array(begin)
        self.parts = [self.sets[h][a:b] for h, a, b in zip(holder, begin, end, strict=True)]
        self.last = np.array([int(r[-1]) if len(r) else -1 for r in self.parts])
        # children by level, each with the members of its run
        self.levels, level = [], np.array([0])
        children: dict[int, list[int]] = {}
        for node, above in enumerate(up.tolist()):
            if above >= 0:
                children.setdefault(above, []).append(node)
        while True:
            next_ = [c for node in level.tolist() for c in children.get(node, ())]
            if not next_:
                break
            level = np.array(next_)
            first = np.cumsum(size[level]) - size[level]
            self.levels.append((level, up[level], np.concatenate([self.parts[c] for c in next_]), first))
        self.n_nodes = len(up)

    def search(self, x: np.ndarray, size: int, sizes: np.ndarray, alive: np.ndarray, num: int, den: int) -> np.ndarray:
        """Sets alive with a large enough overlap with x.

        ``x``: ascending ranks; ``size``, ``sizes``: whole set sizes.
        """
        inside = np.zeros(self.n_ranks, np.int64)
        inside[x] = 1
        above = len(x) - np.cumsum(inside)      # members of x behind each rank
        least = overlap_needed(size + -(-num * size // den), num, den)
        overlap = np.full(self.n_nodes, -1, np.int64)
        overlap[0] = 0
        for level, up, members_, first in self.levels:
            base = overlap[up]
            open_ = base >= 0
            if not open_.any():
                break
            # what the path to the parent overlaps is shared by all its children
            reached = base + np.add.reduceat(inside[members_], first)
            # left where neither x nor the sets below have enough members behind the path
            rest = np.minimum(above[self.last[level]], self.longest[level] - self.end[level])
            overlap[level] = np.where(open_ & (reached + rest >= least), reached, -1)
        found = overlap[self.node_of]
        return np.flatnonzero(alive & (found >= 0) & (found >= overlap_needed(size + sizes, num, den)))


def join_block(sets: list[np.ndarray], sizes: np.ndarray, num: int, den: int, union: Union) -> None:
    """Join all similar sets of a block in ``union``."""
    todo = np.arange(len(sets))                 # sets that no link has reached yet
    queue: list[int] = []
    while len(todo) or queue:
        tree = Tree([sets[i] for i in todo] + [sets[i] for i in queue])
        at = {int(i): k for k, i in enumerate(todo.tolist() + queue)}
        alive = np.zeros(len(at), bool)
        alive[:len(todo)] = True
        own = np.array([sizes[i] for i in at])
        names = list(at)
        # a tree of which most sets are reached is replaced by a smaller one
        while (queue or alive.any()) and (2 * alive.sum() >= len(todo) or len(todo) < 16):
            if not queue:
                first = int(alive.argmax())
                alive[first] = False
                queue.append(names[first])
            i = queue.pop()
            hits = tree.search(tree.sets[at[i]], int(sizes[i]), own, alive, num, den)
            alive[hits] = False
            for j in hits.tolist():
                union.join(i, names[j])
                queue.append(names[j])
            if not alive.any():
                queue.clear()                   # nothing is left to find
        todo = todo[alive[:len(todo)]]


def join_pairs(sets: list[np.ndarray], sizes: np.ndarray, split: int, num: int, den: int, union: Union) -> None:
    """Join the similar pairs of a set before ``split`` and one from it on."""
    tree = Tree(sets)
    roots = union.roots()
    second = np.arange(len(sets)) >= split
    for i in range(split):
        apart = second & (roots != roots[i])
        if apart.any():
            hits = tree.search(tree.sets[i], int(sizes[i]), sizes, apart, num, den).tolist()
            for j in hits:
                union.join(i, j)
            if hits:
                roots = union.roots()


def _block_links(num: int, den: int):
    def work(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["side"], r["sid"]))
        sets = [np.frombuffer(r["grams"], np.uint64) for r in rows]
        sizes, union = np.array([r["n"] for r in rows], np.int64), Union(len(rows))
        split = sum(r["side"] == 0 for r in rows)
        if 0 < split < len(rows):
            known: dict[int, int] = {}
            for i, r in enumerate(rows):  # what earlier rounds have joined
                union.join(known.setdefault(r["class"], i), i)
            start = union.roots()
            join_pairs(sets, sizes, split, num, den, union)
        else:
            start = np.arange(len(rows))
            join_block(sets, sizes, num, den, union)
        a, b = [], []
        for i, root in enumerate(union.roots().tolist()):
            if root != start[i]:
                a.append(rows[i]["sid"])
                b.append(rows[root]["sid"])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return work


def links(ordered: DataFrame, clusters: DataFrame, num: int, den: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(a, b): links that connect all similar sets.

    Clusters of at most ``block_tokens`` n-grams are one task each. Larger ones
    are dealt into blocks. The blocks are joined by themselves; then the sets
    outside the largest class that came of it are compared, block by block, with
    all sets of the cluster they are not joined with yet.
    """
    sized = ordered.join(clusters.withColumnRenamed("node", "sid"), "sid")
    weight = sized.groupBy("component").agg(F.sum("n_grams").alias("w"))
    n_blocks = F.ceil(F.col("w") / block_tokens).cast("int")
    placed = store(
        sized.join(weight.select("component", n_blocks.alias("n_blocks")), "component")
        .withColumn("block", F.pmod(F.xxhash64("sid"), "n_blocks").cast("int")), "clusters")
    work = _block_links(num, den)
    cells = placed.select("component", "block", F.lit(0).alias("side"), F.lit(None).cast("long").alias("class"), "sid", "n", "grams")
    inner = store(cells.groupBy("component", "block").applyInArrow(work, "a long, b long"), "links")
    if placed.where("n_blocks > 1").isEmpty():
        return inner
    large = placed.where("n_blocks > 1")
    known = connected(inner)
    classed = large.join(known.select(F.col("node").alias("sid"), F.col("component").alias("class")), "sid", "left") \
        .withColumn("class", F.coalesce("class", "sid"))
    # one set of every class and block meets those of the other blocks first
    firsts = classed.groupBy("component", "class").agg(F.min_by(F.struct("sid", "n", "grams"), "sid").alias("s"))
    per = firsts.select("component", F.pmod(F.xxhash64("class"), F.lit(64)).cast("int").alias("block"), F.lit(0).alias("side"),
                        F.lit(None).cast("long").alias("class"), "s.*")
    between = store(per.groupBy("component", "block").applyInArrow(work, "a long, b long"), "links")
    known = connected(inner.unionByName(between))
    classed = store(
        large.join(known.select(F.col("node").alias("sid"), F.col("component").alias("class")), "sid", "left")
        .withColumn("class", F.coalesce("class", "sid")), "clusters")
    count = classed.groupBy("component", "class").count()
    main = count.groupBy("component").agg(F.max_by("class", "count").alias("main"))
    classed = classed.join(main, "component")
    cols = ["component", "class", "sid", "n", "grams"]
    outside = classed.where("class <> main").select(*cols, F.col("block").alias("from_"), F.explode(
        F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block"), F.lit(0).alias("side"))
    todo = outside.select("component", "from_", "block").distinct()
    inside = classed.select(*cols, "block", F.lit(1).alias("side")).join(todo, ["component", "block"])
    pairs = outside.unionByName(inside)
    last = pairs.groupBy("component", "from_", "block").applyInArrow(work, "a long, b long")
    return inner.unionByName(between).unionByName(last)


def classes(docs: DataFrame, id_col: str, text_col: str, k: int, num: int, den: int) -> DataFrame:
    """(doc, n_shingles, component_id) of every text; see ``join_documents``."""
    spark = docs.sparkSession
    buckets = bucket_count(spark)
    packs = store(text_packs(docs, id_col, text_col), "packs")
    table = store(set_table(packs, k), "sets")
    named = table.where("sid is not null")
    reps = named.groupBy("sid").agg(F.min(F.struct("doc", "pack", "row")).alias("r"))
    rows = reps.groupBy("r.pack").agg(F.sort_array(F.collect_list("r.row")).alias("rows"))
    some = store(candidate_sets(packs, rows, k, num, den, buckets), "candidates")
    ordered = store(ordered_sets(some, num, den, buckets), "ordered")
    clusters = store(connected(candidate_edges(ordered, num, den, buckets)), "nodes")
    linked = connected(links(ordered, clusters, num, den))
    group = reps.select("sid", F.col("r.doc").alias("doc"))
    joined = group.join(linked.select(F.col("node").alias("sid"), "component"), "sid", "left") \
        .withColumn("component", F.coalesce("component", "sid"))
    least = joined.groupBy("component").agg(F.min("doc").alias("component_id"))
    by_set = joined.join(least, "component").select("sid", "component_id")
    null_id = F.when(F.col("x") != np.iinfo(np.int64).max, F.col("x"))
    return (
        table.join(by_set, "sid", "left")
        .select("doc", "n", F.coalesce("component_id", "doc").alias("component_id"), "pack", "row")
        .withColumn("x", F.col("doc")).withColumn("doc", null_id)
        .withColumn("x", F.col("component_id")).withColumn("component_id", null_id)
        .select("doc", F.col("n").alias("n_shingles"), "component_id", "pack", "row")
    )


def join_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3,
                   num: int = 90, den: int = 100) -> DataFrame:
    """One row per row of ``docs``: the id, n_shingles, component_id.

    Texts are similar when den * intersection >= num * union. Null and empty
    texts have no n-grams and are linked with nothing; a text of fewer than k
    words is one n-gram; repeated rows are linked with each other; a null id
    comes after all others and is null in ``component_id`` too; other columns
    are ignored.
    """
    row_tag(docs, id_col, text_col)
    return classes(docs, id_col, text_col, k, num, den).select(F.col("doc").alias(id_col), "n_shingles", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                     num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with the document of the smallest id of each group of similar ones.

    Rows without words all stay, and so do all rows that have a kept id.
    """
    found = classes(docs, id_col, text_col, k, num, den)
    gone = free_name(docs, "gone")
    drop = found.where("n_shingles > 0 and component_id <> doc").select(F.col("doc").alias(gone)).distinct()
    return docs.join(drop, F.col(id_col) == F.col(gone), "left_anti")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def oracle() -> str:
    """All pairs that share a shingle, and their transitive closure."""
    return r"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w FROM documents WHERE text IS NOT NULL),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)] END) AS t FROM d),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL),
    e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
    r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
    SELECT documents.doc_id, coalesce(n.n, 0) AS n_shingles, least(documents.doc_id, m.m) AS component_id
    FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM r GROUP BY a) m USING (doc_id)"""
