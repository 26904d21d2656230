"""URL filter: a tree of path templates per host, judged by labelled purity.

Everything is DataFrame work. The steps:

1. ``parse_urls``: host and path.
2. ``match_rules``: explicit rules; the longest that fits wins. Their verdicts
   are the labels that the templates learn from.
3. ``templates``: per host a tree over path segments, grown level by level.
   Digit runs become ``#``; a branch that is rare under its node becomes ``*``.
   Then branches of one node whose block rate can't be told from the rate of
   the whole node (two-proportion test) are merged into ``*``.
4. ``judge_urls``: a template is rejected when its smoothed block rate reaches
   a threshold. The prior of a host's template is the rate of the same template
   over all hosts, whose prior is the rate of all labels.

A hot host is no hot task: all counts combine before they are shuffled, and the
only joins on a host are plain equi-joins, which AQE can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import row_tag, store

# The rules of the contract.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

MAX_DEPTH = 4         # levels of the tree; what lies deeper is one '**' segment
MIN_SUPPORT = 3       # urls a literal branch needs
MIN_SHARE = 0.01      # and its share of the urls of its node
MERGE_Z = 1.96        # branches closer than this many standard errors merge
ALPHA = 4.0           # weight of the prior in labels
REJECT_RATE = 0.5     # smoothed block rate from which a template is rejected
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parse_urls(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty for a null or a text without ``://``."""
    tail = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(tail, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(tail, r"(?s)^[^/?#]*([^?#]*)", 1)
    # a text without the marker has an empty tail, and so has no host or path
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(
        [(h, p, h + p, v) for h, p, v in rules],
        "rule_host string, rule_path string, rule string, rule_verdict string")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``rule`` and ``rule_verdict`` (null where none fits) to rows with host and path.

    Each distinct host is looked up once with all its parent domains; what it
    finds is a short list, from which every url takes the longest that fits.
    """
    hosts = urls.select("host").distinct()
    labels = F.split("host", "\\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    found = (
        hosts.select("host", F.explode(parents).alias("rule_host"))
        .join(rules, "rule_host")
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(F.struct(
            F.length("rule").alias("n"), "rule_path", "rule", "rule_verdict")), asc=False).alias("rules_"))
    )
    fits = F.filter("rules_", lambda r: F.col("path").startswith(r["rule_path"]))
    best = F.try_element_at(fits, F.lit(1))
    return (
        urls.join(found, "host", "left")
        .withColumn("best_", best)
        .withColumn("rule", F.col("best_.rule"))
        .withColumn("rule_verdict", F.col("best_.rule_verdict"))
        .drop("rules_", "best_")
    )


def _segment(level: int) -> Column:
    """The segment of a level with digit runs as ``#``; null below the path's end."""
    parts = F.split(F.col("path"), "/")
    n = F.size(parts)
    own = F.when(n > level + 1, F.regexp_replace(F.get(parts, F.lit(level + 1)), "[0-9]+", "#"))
    if level < MAX_DEPTH:
        return own
    return F.when(n > level + 1, F.lit("**"))


def templates(counts: DataFrame) -> DataFrame:
    """Template of each distinct (host, path).

    ``counts``: host, path, n, n_block, n_label (all rows with them). Returns
    these with ``template``.
    """
    rows = counts.withColumn("template", F.lit(""))
    for level in range(MAX_DEPTH + 1):
        rows = rows.withColumn("seg", _segment(level))
        # at most as many rows as distinct shapes below the nodes
        child = rows.where("seg is not null").groupBy("host", "template", "seg").agg(
            F.sum("n").alias("c_n"), F.sum("n_block").alias("c_b"), F.sum("n_label").alias("c_l"))
        node = child.groupBy("host", "template").agg(
            F.sum("c_n").alias("p_n"), F.sum("c_b").alias("p_b"), F.sum("c_l").alias("p_l"))
        literal = (F.col("c_n") >= MIN_SUPPORT) & (F.col("c_n") >= F.col("p_n") * MIN_SHARE)
        rate = F.try_divide("p_b", "p_l")
        gap = F.try_divide("c_b", "c_l") - rate
        error2 = rate * (1 - rate) * (F.try_divide(F.lit(1), "c_l") + F.try_divide(F.lit(1), "p_l"))
        # an unlabelled branch can't be told from its node
        apart = F.coalesce(
            (F.col("c_l") > 0) & (F.col("p_l") > 0) & (gap * gap > error2 * (MERGE_Z * MERGE_Z)), F.lit(False))
        child = child.join(node, ["host", "template"]).select(
            "host", "template", "seg",
            F.when(F.col("seg").isin("#", "**") | (literal & apart), F.col("seg")).otherwise("*").alias("step"))
        rows = (
            rows.join(child, ["host", "template", "seg"], "left")
            .withColumn("template", F.when(F.col("seg").isNull(), F.col("template"))
                        .otherwise(F.concat("template", F.lit("/"), "step")))
            .drop("seg", "step")
        )
        # the next level reads it twice; without a table plans double at each level
        rows = store(rows, "templates")
    return rows


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, verdict, template, block_rate.

    Null urls and urls without ``://`` have an empty host and path and are
    judged like any other; repeated rows are kept; other columns are dropped.
    An empty table gives an empty result. Without any label the rate is 0.
    """
    row_tag(pages, id_col, url_col)
    host, path = parse_urls(F.col(url_col))
    urls = match_rules(pages.select(F.col(id_col), host.alias("host"), path.alias("path")), rules)
    urls = store(urls, "urls")
    counts = urls.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("rule_verdict") == "block", 1)).alias("n_block"),
        F.count("rule_verdict").alias("n_label"))
    tree = templates(store(counts, "paths"))
    by_host = tree.groupBy("host", "template").agg(F.sum("n_block").alias("b"), F.sum("n_label").alias("l"))
    shape = by_host.groupBy("template").agg(F.sum("b").alias("tb"), F.sum("l").alias("tl"))
    rate = shape.agg(F.coalesce(F.try_divide(F.sum("tb"), F.sum("tl")), F.lit(0.0)).alias("g")).first()["g"]
    shape = shape.select("template", ((F.col("tb") + ALPHA * rate) / (F.col("tl") + ALPHA)).alias("prior"))
    rates = by_host.join(shape, "template").select(
        "host", "template", ((F.col("b") + ALPHA * F.col("prior")) / (F.col("l") + ALPHA)).alias("block_rate"))
    judged = tree.select("host", "path", "template").join(rates, ["host", "template"])
    learned = F.when(F.col("block_rate") >= REJECT_RATE, "block").otherwise("allow")
    return urls.join(judged, ["host", "path"]).select(
        id_col, "host", "path", "rule",
        F.coalesce("rule_verdict", learned).alias("verdict"), "template", "block_rate")


def op2_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    out = judge_urls(pages, rule_table(spark))
    return out.select("page_id", "host", "path", "rule", "verdict", "template",
                      F.round("block_rate", 6).alias("block_rate"))


def oracle() -> str:
    """The same for DuckDB, the levels of the tree written out."""
    rules = ", ".join(f"('{h}', '{p}', '{h}{p}', '{v}')" for h, p, v in RULES)
    ctes = [f"""u AS (
      SELECT page_id,
        CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') ELSE '' END AS host,
        CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
      FROM pages)""",
            f"r(rule_host, rule_path, rule, rule_verdict) AS (VALUES {rules})",
            """m AS (SELECT h.host, h.path, arg_max(rule, length(rule)) AS rule, arg_max(rule_verdict, length(rule)) AS rule_verdict
      FROM (SELECT DISTINCT host, path FROM u) h JOIN r
        ON (h.host = rule_host OR ends_with(h.host, '.' || rule_host)) AND starts_with(h.path, rule_path)
      GROUP BY ALL)""",
            """j AS (SELECT u.*, m.rule, m.rule_verdict FROM u LEFT JOIN m USING (host, path))""",
            """t0 AS (SELECT host, path, '' AS template, count(*) AS n, count(*) FILTER (rule_verdict = 'block') AS n_block,
      count(rule_verdict) AS n_label FROM j GROUP BY host, path)"""]
    for level in range(MAX_DEPTH + 1):
        own = "regexp_replace(parts[{0}], '[0-9]+', '#', 'g')".format(level + 2) if level < MAX_DEPTH else "'**'"
        ctes += [
            f"s{level} AS (SELECT *, CASE WHEN len(parts) > {level + 1} THEN {own} END AS seg FROM "
            f"(SELECT *, string_split(path, '/') AS parts FROM t{level}))",
            f"c{level} AS (SELECT host, template, seg, sum(n) AS c_n, sum(n_block) AS c_b, sum(n_label) AS c_l "
            f"FROM s{level} WHERE seg IS NOT NULL GROUP BY ALL)",
            f"d{level} AS (SELECT *, sum(c_n) OVER w AS p_n, sum(c_b) OVER w AS p_b, sum(c_l) OVER w AS p_l "
            f"FROM c{level} WINDOW w AS (PARTITION BY host, template))",
            f"e{level} AS (SELECT host, template, seg, CASE WHEN seg IN ('#', '**') OR (c_n >= {MIN_SUPPORT} AND "
            f"c_n >= p_n * {MIN_SHARE}::DOUBLE AND coalesce(c_l > 0 AND p_l > 0 AND "
            f"pow(c_b / c_l::DOUBLE - p_b / p_l::DOUBLE, 2) > (p_b / p_l::DOUBLE) * (1 - p_b / p_l::DOUBLE) * "
            f"(1 / c_l::DOUBLE + 1 / p_l::DOUBLE) * {MERGE_Z}::DOUBLE * {MERGE_Z}::DOUBLE, false)) THEN seg ELSE '*' END AS step FROM d{level})",
            f"t{level + 1} AS (SELECT s.host, s.path, CASE WHEN s.seg IS NULL THEN s.template ELSE s.template || '/' || step END "
            f"AS template, n, n_block, n_label FROM s{level} s LEFT JOIN e{level} e "
            f"ON s.host = e.host AND s.template = e.template AND s.seg = e.seg)"]
    ctes += [
        f"bh AS (SELECT host, template, sum(n_block) AS b, sum(n_label) AS l FROM t{MAX_DEPTH + 1} GROUP BY ALL)",
        "g AS (SELECT coalesce(sum(b) / sum(l)::DOUBLE, 0) AS g FROM bh)",
        f"sh AS (SELECT template, (sum(b) + {ALPHA}::DOUBLE * any_value(g)) / (sum(l) + {ALPHA}::DOUBLE) AS prior FROM bh, g GROUP BY template)",
        f"rt AS (SELECT host, template, (b + {ALPHA}::DOUBLE * prior) / (l + {ALPHA}::DOUBLE) AS block_rate FROM bh JOIN sh USING (template))"]
    return "WITH " + ",\n".join(ctes) + f"""
    SELECT page_id, j.host, j.path, rule, coalesce(rule_verdict, CASE WHEN block_rate >= {REJECT_RATE} THEN 'block' ELSE 'allow' END) AS verdict,
      t.template, round(block_rate, 6) AS block_rate
    FROM j JOIN t{MAX_DEPTH + 1} t ON j.host = t.host AND j.path = t.path
      JOIN rt ON rt.host = j.host AND rt.template = t.template"""
