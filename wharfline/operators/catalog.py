"""Which columns of many tables hold the same keys.

Two ways, both without a join. Sketches, one pass per table, tell for all pairs
of columns about how many keys they share; they merge, so new rows of a table
cost a sketch of their own. Exact counts stack the columns and shuffle every
distinct key once, whatever the number of pairs.

``tables`` maps a label to a DataFrame and the key columns in it; a column is then
called ``label.column``. Keys are compared as text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Tables = dict[str, tuple[DataFrame, list[str]]]

SKETCH_BITS = 14  # a sketch keeps 2**14 hashes; smaller sets are exact
_WORD = 62        # columns in one bit mask


def _names(tables: Tables) -> list[str]:
    return [f"{label}.{c}" for label, (_, columns) in tables.items() for c in columns]


def column_sketches(tables: Tables, bits: int = SKETCH_BITS) -> DataFrame:
    """col, sketch: a set sketch of each column's keys, all of a table in one pass. Nulls are no keys."""

    def of(label: str, df: DataFrame, columns: list[str]) -> DataFrame:
        made = df.agg(*[F.theta_sketch_agg(F.col(c).cast("string"), F.lit(bits)).alias(f"s{i}") for i, c in enumerate(columns)])
        named = [F.struct(F.lit(f"{label}.{c}").alias("col"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(columns)]
        return made.select(F.inline(F.array(*named)))

    return reduce(DataFrame.unionByName, [of(label, df, columns) for label, (df, columns) in tables.items()])


def merge_sketches(*sketches: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """Sketches of the same columns over different rows, put together."""
    stacked = reduce(DataFrame.unionByName, sketches)
    return stacked.groupBy("col").agg(F.theta_union_agg("sketch", F.lit(bits)).alias("sketch"))


def estimate_pairs(sketches: DataFrame) -> DataFrame:
    """left_col, right_col, n_left, n_right, n_common, about, for all pairs of columns in the order of their names.

    One row holds all sketches: they are as many as the columns, not the keys.
    """
    rows = sketches.agg(F.array_sort(F.collect_list(F.struct("col", "sketch"))).alias("all"))
    left = rows.select("all", F.posexplode("all").alias("at", "l"))
    both = left.select("l", F.explode(F.slice("all", F.col("at") + 2, F.size("all"))).alias("r"))

    def size(sketch: Column) -> Column:
        return F.theta_sketch_estimate(sketch)

    return both.select(
        F.col("l.col").alias("left_col"),
        F.col("r.col").alias("right_col"),
        size(F.col("l.sketch")).alias("n_left"),
        size(F.col("r.sketch")).alias("n_right"),
        size(F.theta_intersection(F.col("l.sketch"), F.col("r.sketch"))).alias("n_common"),
    )


def exact_pairs(tables: Tables, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """left_col, right_col, n_left, n_right, n_common of the named pairs, or of all in the order of their names.

    Keys are combined with the set of columns that hold them before and after one
    shuffle, then counted per set, so a key that fills a column is one row.
    """
    names = _names(tables)
    number = {name: i for i, name in enumerate(names)}
    wanted = pairs if pairs is not None else [(a, b) for a in sorted(names) for b in sorted(names) if a < b]
    missing = {c for pair in wanted for c in pair} - set(names)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    words = range(0, max(len(names), 1), _WORD)

    def keys_of(label: str, df: DataFrame, columns: list[str]) -> DataFrame:
        cells = [F.struct(F.lit(number[f"{label}.{c}"]).alias("n"), F.col(c).cast("string").alias("k")) for c in columns]
        return df.select(F.inline(F.array(*cells))).filter(F.col("k").isNotNull())

    stacked = reduce(DataFrame.unionByName, [keys_of(label, df, columns) for label, (df, columns) in tables.items()])
    bit = F.expr("shiftleft(1L, n % 62)")
    held = [F.bit_or(F.when(F.expr(f"n div {_WORD}") == w // _WORD, bit).otherwise(F.lit(0).cast("bigint"))).alias(f"w{w // _WORD}") for w in words]
    masks = [f"w{w // _WORD}" for w in words]
    sets = stacked.groupBy("k").agg(*held).groupBy(*masks).agg(F.count(F.lit(1)).alias("n"))

    def has(i: Column) -> Column:
        word = F.get(F.array(*masks), F.expr("0") + (i / _WORD).cast("int"))
        return F.getbit(word, i % _WORD) == 1

    asked = F.inline(F.array(*[F.struct(F.lit(a).alias("left_col"), F.lit(b).alias("right_col"), F.lit(number[a]).alias("i"), F.lit(number[b]).alias("j"))
                               for a, b in wanted]))
    n, zero = F.col("n"), F.lit(0)
    return sets.select("*", asked).groupBy("left_col", "right_col").agg(
        F.coalesce(F.sum(F.when(has(F.col("i")), n)), zero).alias("n_left"),
        F.coalesce(F.sum(F.when(has(F.col("j")), n)), zero).alias("n_right"),
        F.coalesce(F.sum(F.when(has(F.col("i")) & has(F.col("j")), n)), zero).alias("n_common"),
    )
