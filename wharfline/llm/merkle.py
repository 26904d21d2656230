"""Merkle manifest of a data set: one tree per source, one over the sources, a proof per row.

Level by level, conditional aggregates spread the children of each parent into
``FANOUT`` columns; concatenated they are hashed to the parent. Leaving a
child's own column out of the same row gives the child's siblings, so proofs
need no second grouping: on the way down each parent row is exploded into its
children, which take the parent's path with them.

No task holds a source. Leaves are numbered by range partitions, and a parent's
children are neighbours in them, so aggregates combine before they are
shuffled. Levels are stored tables, the next a third of the last; a lost
executor repeats one level.

A digest is lower-case hex of sha256. A leaf hashes the row's columns, each as
``-`` for null, else its length in bytes, ``:`` and its text. Null sources are
one source, before all others. Within a source leaves ascend by doc_id, nulls
first; rows with the same doc_id by their digest, so that repeated rows get one
place each. An empty table has no rows and no root. Columns that are not named
are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import row_tag, store

FANOUT = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "struct<left:string,right:string>"


def encoded(value: Column) -> Column:
    """A value as the manifest hashes it."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def number_leaves(leaves: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with ``pos`` from 0 within each group, in ``order``; groups with ``n``).

    Range partitions are sorted and stored; a count for each partition and group
    then gives the places. Joined on both, no key has more rows than a partition.
    """
    keys = [F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    placed = store(
        leaves.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumns({"part": F.spark_partition_id(), "row": F.monotonically_increasing_id()}), "leaves")
    runs = placed.groupBy("part", group).agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    before = W.partitionBy(group).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = runs.select(F.col("part").alias("part_"), F.col(group).alias("group_"), "first",
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    on = (F.col("part") == F.col("part_")) & F.col(group).eqNullSafe(F.col("group_"))
    rows = placed.join(starts, on).withColumn("pos", F.col("row") - F.col("first") + F.col("before"))
    return rows.drop("part", "row", "part_", "group_", "first", "before"), runs.groupBy(group).agg(F.sum("n").alias("n"))


def _slots(row: Column) -> list[Column]:
    """The fanout columns of a parent: its children by place."""
    return [F.max(F.when(F.col("pos") % FANOUT == j, row)).alias(f"c{j}") for j in range(FANOUT)]


def _digest_of(slots: list[str]) -> Column:
    return F.sha2(F.concat(*[F.coalesce(F.col(c)["h"], F.lit("")) for c in slots]), 256)


NAMES = [f"c{j}" for j in range(FANOUT)]


def fold_up(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(levels of parents with their fanout columns, from below; g, h, height of each group's root).

    ``nodes``: g, pos from 0, n of the group, and ``row``, a struct with the digest
    ``h``. A group of one node has that node as root, at height 0.
    """
    widest = nodes.agg(F.max("n")).first()[0] or 0
    levels, roots, height = [], [], 0
    while True:
        roots.append(nodes.where("n = 1").select("g", F.col("row")["h"].alias("h"), F.lit(height).alias("height")))
        if widest <= 1:
            break
        parents = nodes.where("n > 1").groupBy("g", F.expr(f"pos div {FANOUT}").alias("pos")).agg(
            F.max("n").alias("n"), *_slots(F.col("row")))
        level = store(parents.withColumn("h", _digest_of(NAMES)), f"merkle-{height}")
        levels.append(level)
        widest, height = -(-widest // FANOUT), height + 1
        nodes = level.select("g", "pos", F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n"), F.struct("h").alias("row"))
    table = roots[0]
    for more in roots[1:]:
        table = table.unionByName(more)
    return levels, table


def _children(parents: DataFrame) -> DataFrame:
    """g, pos, row, path of the children: the parent's path with the siblings in front."""
    own = []
    for j in range(FANOUT):
        def side(names):
            return F.concat(F.lit(""), *[F.coalesce(F.col(c)["h"], F.lit("")) for c in names])

        step = F.struct(side(NAMES[:j]).alias("left"), side(NAMES[j + 1:]).alias("right"))
        own.append(F.when(F.col(NAMES[j]).isNotNull(), F.struct(
            (F.col("pos") * FANOUT + j).alias("pos"), F.col(NAMES[j]).alias("row"), F.concat(F.array(step), "path").alias("path"))))
    return parents.select("g", F.explode(F.array_compact(F.array(*own))).alias("own")).select("g", "own.*")


def unfold(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """g, pos, row, path of all nodes at the bottom whose group has more than one node.

    ``tops``: g, height and path of the group's root. ``path`` lists the siblings
    (those to the left and those to the right, each concatenated) from a node up.
    """
    down = None
    for height in range(len(levels), 0, -1):
        at_root = tops.where(F.col("height") == height).select("g", F.lit(0).cast("long").alias("pos"), "path")
        known = at_root if down is None else down.select("g", "pos", "path").unionByName(at_root)
        down = _children(levels[height - 1].join(known, ["g", "pos"]))
        if height > 1:
            down = down.drop("row")
    return down


def folded(path: Column, leaf: Column) -> Column:
    """The root that a leaf leads to along a path."""
    return F.aggregate(path, leaf, lambda h, step: F.sha2(F.concat(step["left"], h, step["right"]), 256))


def manifest(leaves: DataFrame, group: str, payload: list[str]) -> DataFrame:
    """``payload`` columns, leaf, subroot, root, path for rows with ``leaf``, their digest.

    Rows of a group are ordered by ``payload``, then ``leaf``; groups by their
    value, null first. Two trees: within groups, then over the groups' roots.
    """
    row = F.struct(F.col("leaf").alias("h"), *payload)
    numbered, groups = number_leaves(leaves, group, [*payload[:1], "leaf", *payload[1:]])
    # groups by number, so that a null is a key like others
    placed, count = number_leaves(groups.withColumn("all", F.lit(0)), "all", [group])
    known = store(placed.select(F.col(group).alias("group_"), F.col("pos").alias("g"), "n"), "groups")
    bottom = store(
        numbered.join(known, F.col(group).eqNullSafe(F.col("group_"))).select("g", "pos", "n", row.alias("row")), "bottom")
    levels, roots = fold_up(bottom)
    roots = store(roots, "subroots")
    total = count.agg(F.max("n").alias("n")).scalar()
    over = store(roots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("pos"), total.alias("n"),
                              F.struct("h", F.col("g").alias("group"), "height").alias("row")), "sources")
    upper, top = fold_up(over)
    root = store(top.select("h"), "root").agg(F.max("h")).scalar()
    empty = F.array().cast(f"array<{_STEP}>")
    above = unfold(upper, top.select("g", "height", empty.alias("path"))) if upper else over.select("g", "pos", "row", empty.alias("path"))
    tops = store(above.select(F.col("row")["group"].alias("g"), F.col("row")["height"].alias("height"),
                              F.col("row")["h"].alias("subroot"), "path"), "tops")
    alone = bottom.where("n = 1").join(tops.where("height = 0").select("g", "path"), "g").select("g", "pos", "row", "path")
    down = unfold(levels, tops) if levels else None
    all_rows = alone if down is None else down.unionByName(alone)
    return all_rows.join(tops.select("g", "subroot"), "g").select(
        *[F.col("row")[c].alias(c) for c in payload], F.col("row")["h"].alias("leaf"), "subroot", root.alias("root"), "path")


def tampered_text(doc_id: Column, text: Column) -> Column:
    """The text without line feeds where 2 divides the crc32 of the decimal doc_id."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    return F.when(hit, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def document_manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, tampered_leaf, subroot, root, path of every document."""
    row_tag(docs, *COLUMNS)
    cols = [F.col(c) for c in COLUMNS]
    changed = leaf_digest(*cols[:-1], tampered_text(F.col("doc_id"), F.col("text")))
    leaves = store(docs.select("source", F.col("doc_id").cast("long"), leaf_digest(*cols).alias("leaf"),
                               changed.alias("tampered_leaf")), "digests")
    return manifest(leaves, "source", ["doc_id", "tampered_leaf"])


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests, proof and verification of every document, some of them tampered with."""
    rows = document_manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    again = folded(F.col("path"), F.col("tampered_leaf"))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"), again.alias("folded_root")
                       ).withColumn("verified", F.col("folded_root") == F.col("root"))


def oracle() -> str:
    cells = " || ".join(f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')" for c in COLUMNS)
    changed = cells.replace("text::varchar", "changed::varchar")
    return f"""
WITH RECURSIVE
table256 AS (
  SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY n) AS t
  FROM (SELECT unnest(range(256)) AS n)),
crc AS (
  SELECT doc_id, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS c
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), table256),
leaves AS (
  SELECT doc_id, source, sha256({cells}) AS leaf, sha256({changed}) AS tampered
  FROM (SELECT d.*, CASE WHEN c % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed
        FROM documents d LEFT JOIN crc USING (doc_id))),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n
  FROM leaves),
up AS (
  SELECT g, pos, n, leaf AS h, 0 AS height FROM placed
  UNION ALL
  SELECT g, pos // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' ORDER BY pos)), any_value(height) + 1
  FROM up WHERE n > 1 GROUP BY g, pos // 3),
subroots AS (SELECT g, h, height FROM up WHERE n = 1),
top_up AS (
  SELECT g AS pos, count(*) OVER () AS n, h, 0 AS height FROM subroots
  UNION ALL
  SELECT pos // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' ORDER BY pos)), any_value(height) + 1
  FROM top_up WHERE n > 1 GROUP BY pos // 3),
whole AS (SELECT h AS root FROM top_up WHERE n = 1),
steps AS (
  SELECT g, pos, height, sum(1) OVER () AS n_steps,
    coalesce(string_agg(h, '' ORDER BY pos) FILTER (WHERE true) OVER before, '') AS lefts,
    coalesce(string_agg(h, '' ORDER BY pos) OVER after, '') AS rights
  FROM up WHERE n > 1
  WINDOW before AS (PARTITION BY g, height, pos // 3 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    after AS (PARTITION BY g, height, pos // 3 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
top_steps AS (
  SELECT pos, height,
    coalesce(string_agg(h, '' ORDER BY pos) OVER before, '') AS lefts,
    coalesce(string_agg(h, '' ORDER BY pos) OVER after, '') AS rights
  FROM top_up WHERE n > 1
  WINDOW before AS (PARTITION BY height, pos // 3 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    after AS (PARTITION BY height, pos // 3 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
walk AS (
  SELECT g, pos AS leaf_pos, pos, 0 AS height, tampered AS h, '' AS proof FROM placed
  UNION ALL
  SELECT w.g, leaf_pos, w.pos // 3, w.height + 1, sha256(lefts || w.h || rights), proof || lefts || rights
  FROM walk w JOIN steps s ON s.g = w.g AND s.pos = w.pos AND s.height = w.height),
at_subroot AS (
  SELECT w.g, leaf_pos, w.h, proof FROM walk w JOIN subroots r ON r.g = w.g AND r.height = w.height),
top_walk AS (
  SELECT g, leaf_pos, g AS pos, 0 AS height, h, proof FROM at_subroot
  UNION ALL
  SELECT w.g, leaf_pos, w.pos // 3, w.height + 1, sha256(lefts || w.h || rights), proof || lefts || rights
  FROM top_walk w JOIN top_steps s ON s.pos = w.pos AND s.height = w.height),
done AS (
  SELECT g, leaf_pos, h, proof FROM top_walk WHERE height = (SELECT max(height) FROM top_up))
SELECT p.doc_id, p.leaf, r.h AS subroot, root, sha256(proof) AS proof_sha256, d.h AS folded_root, d.h = root AS verified
FROM placed p JOIN done d ON d.g = p.g AND d.leaf_pos = p.pos JOIN subroots r ON r.g = p.g, whole
"""
