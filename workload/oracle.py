"""SQL for the registered queries, over the same tables."""

from __future__ import annotations

_WS = (
    "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)"
    "||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||chr(8199)"
    "||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)"
)

# Views as common table expressions; each query names the ones it needs.
_KEY_COLUMNS = [
    ("customer", "c_custkey"), ("customer", "c_nationkey"), ("orders", "o_orderkey"), ("orders", "o_custkey"),
    ("lineitem", "l_orderkey"), ("lineitem", "l_partkey"), ("lineitem", "l_suppkey"), ("lineitem", "l_returnflag"),
    ("part", "p_partkey"), ("supplier", "s_suppkey"), ("supplier", "s_nationkey"), ("nation", "n_nationkey"),
    ("nation", "n_regionkey"), ("region", "r_regionkey"),
]
_ALL_KEYS = " UNION ALL ".join(
    f"SELECT DISTINCT '{t}.{c}' AS col, {c}::varchar AS k FROM {t} WHERE {c} IS NOT NULL" for t, c in _KEY_COLUMNS)

_VIEWS = {
    "column_pairs": f"""
        SELECT l.col AS left_col, r.col AS right_col, l.n AS n_left, r.n AS n_right,
               (SELECT count(*) FROM ({_ALL_KEYS}) a JOIN ({_ALL_KEYS}) b USING (k) WHERE a.col = l.col AND b.col = r.col) AS n_common
        FROM (SELECT col, count(*) AS n FROM ({_ALL_KEYS}) GROUP BY col) l
        JOIN (SELECT col, count(*) AS n FROM ({_ALL_KEYS}) GROUP BY col) r ON l.col < r.col""",
    "order_lines": """
        SELECT o_orderkey AS pos,
               concat_ws(',', o_custkey::varchar, o_orderkey::varchar, o_orderstatus, o_orderpriority) AS value
        FROM orders""",
    "probe": f"""
        SELECT pos, value, trim(split_part(value, ',', 1), {_WS}) AS k FROM order_lines""",
    "segment_keys": """
        SELECT DISTINCT c_custkey::varchar AS k FROM customer WHERE c_mktsegment = 'BUILDING'""",
    "document_lines": f"""
        SELECT doc_id, line_no, trim(raw, {_WS}) AS value FROM (
            SELECT doc_id, unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS raw,
                   generate_subscripts(string_split_regex(text, '\\r\\n|\\r|\\n'), 1) - 1 AS line_no
            FROM documents)
        WHERE trim(raw, {_WS}) <> ''""",
    "benchmark_lines": f"""
        SELECT DISTINCT trim(raw, {_WS}) AS k FROM (
            SELECT unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS raw FROM benchmark)
        WHERE trim(raw, {_WS}) <> ''""",
    "page_paths": """
        SELECT page_id, regexp_replace(url, '^https?://', '') AS key, length(html) AS size FROM pages""",
    "host_folders": """
        SELECT split_part(key, '/', 1) AS source,
               array_to_string(string_split(key, '/')[2:-2], '/') AS folder
        FROM page_paths""",
    "inventory": """
        SELECT doc_id, source, lang, n_chars AS size,
               'in/' || source || '/' || lang || '/' || doc_id || CASE WHEN doc_id % 3 = 0 THEN '.csv.gz' ELSE '.csv' END AS key
        FROM documents""",
    "destination": """
        SELECT regexp_replace(key, '\\.gz$', '') AS key, size + CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END AS size
        FROM inventory WHERE doc_id % 7 <> 0""",
    "sources": """
        SELECT * FROM (VALUES (1, 's3://wharf/in/src1', 'in/src1'), (2, 's3://wharf/in/src1/en', 'in/src1/en'),
                              (3, 's3://wharf/in/src2/', 'in/src2'), (4, 's3://wharf/in/', 'in'))
        AS t(source_no, source, prefix)""",
    "sourced": """
        SELECT s.source_no, s.source, s.prefix, key, size FROM sources s JOIN inventory ON starts_with(key, s.prefix || '/')""",
    "files": """
        SELECT size, CASE WHEN doc_id % 11 = 0 THEN folder || '/.' || name
                    WHEN doc_id % 13 = 0 THEN '.old/' || folder || '/' || name
                    WHEN doc_id % 17 = 0 THEN folder || '/_' || name
                    ELSE folder || '/' || name END AS path
        FROM (SELECT doc_id, size, source || '/' || lang AS folder,
                     doc_id || CASE WHEN doc_id % 3 = 0 THEN '.csv.gz' ELSE '.csv' END AS name FROM inventory)""",
    "with_twins": """
        SELECT path, size FROM files UNION ALL
        SELECT regexp_replace(path, '\\.gz$', ''), size * 4 FROM files WHERE path LIKE '%.gz' AND size * 4 % 8 = 0""",
    "plan": """
        SELECT i.key AS path, i.size, regexp_replace(i.key, '\\.gz$', '') AS dst,
               CASE WHEN d.key IS NOT NULL AND (i.key LIKE '%.gz' OR d.size = i.size) THEN 'skipped' ELSE 'uploaded' END AS action
        FROM inventory i LEFT JOIN destination d ON d.key = regexp_replace(i.key, '\\.gz$', '')""",
    "outcomes": """
        SELECT path, dst, size, CASE WHEN size % 50 = 0 THEN 'error' ELSE action END AS status FROM plan""",
    "key_columns": """
        SELECT 'customer.c_custkey' AS col, c_custkey::varchar AS k FROM customer UNION
        SELECT 'orders.o_custkey', o_custkey::varchar FROM orders UNION
        SELECT 'orders.o_orderkey', o_orderkey::varchar FROM orders UNION
        SELECT 'lineitem.l_orderkey', l_orderkey::varchar FROM lineitem UNION
        SELECT 'lineitem.l_returnflag', l_returnflag FROM lineitem UNION
        SELECT 'customer.c_mktsegment', c_mktsegment FROM customer""",
    "overlap": """
        SELECT left_col, right_col,
               (SELECT count(*) FROM key_columns WHERE col = left_col) AS n_left,
               (SELECT count(*) FROM key_columns WHERE col = right_col) AS n_right,
               (SELECT count(*) FROM key_columns a JOIN key_columns b ON a.k = b.k
                WHERE a.col = left_col AND b.col = right_col) AS n_common
        FROM (VALUES ('customer.c_custkey', 'orders.o_custkey'), ('orders.o_orderkey', 'lineitem.l_orderkey'),
                     ('lineitem.l_returnflag', 'customer.c_mktsegment')) AS p(left_col, right_col)""",
    "written_keys": """
        SELECT id, CASE id % 5 WHEN 0 THEN p WHEN 1 THEN p[1:3] || ' ' || p[4:] WHEN 2 THEN p[1:3] || '-' || p[4:]
                          WHEN 3 THEN '(' || p[1:3] || ')' || p[4:] ELSE '+' || p END AS k, p
        FROM (SELECT c_custkey AS id, (c_custkey + 5550000000)::varchar AS p FROM customer)""",
    "tried": """
        SELECT k, unnest([0, 1, 2, 3, 4]) AS rule,
               unnest([k, replace(k, ' ', ''), replace(k, '-', ''), replace(replace(k, '(', ''), ')', ''), replace(k, '+', '')]) AS v
        FROM written_keys""",
    "hits": """
        SELECT k, min(rule) AS rule FROM tried
        WHERE v IN (SELECT p FROM written_keys WHERE id % 2 = 0) GROUP BY k""",
}

_NEEDS = {
    "probe": ["order_lines"],
    "host_folders": ["page_paths"],
    "destination": ["inventory"],
    "sourced": ["sources", "inventory"],
    "files": ["inventory"],
    "with_twins": ["files"],
    "plan": ["destination"],
    "outcomes": ["plan"],
    "overlap": ["key_columns"],
    "tried": ["written_keys"],
    "hits": ["tried"],
}


def _with(names: list[str], body: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({_VIEWS[n]})" for n in ordered)
    return f"WITH {ctes}\n{body.strip()}"


_MATCHED = "SELECT pos, value FROM probe WHERE k IN (SELECT k FROM segment_keys)"
_BUCKETS = """
    SELECT pos % 16 AS bucket, count(*) AS n_lines, sum(strlen(value) + 1)::bigint AS n_bytes,
           count(DISTINCT value) AS n_distinct, max(value) AS last_line"""

_ORACLE: dict[str, tuple[list[str], str]] = {
    "match_lines": (["probe", "segment_keys"], _MATCHED),
    "match_lines_shuffled": (["probe", "segment_keys"], _MATCHED),
    "match_key_store": (["probe", "segment_keys"], _MATCHED),
    "match_counts": (
        ["probe", "segment_keys"],
        """
        SELECT (SELECT count(*) FROM probe WHERE pos % 97 <> 0) AS n_processed,
               (SELECT count(*) FROM probe WHERE pos % 97 <> 0 AND k IN (SELECT k FROM segment_keys)) AS n_matches,
               (SELECT count(*) FROM probe WHERE pos % 97 = 0) AS n_errors,
               (SELECT count(*) FROM segment_keys) AS n_keys""",
    ),
    "split_lines": (["document_lines"], "SELECT doc_id, line_no, value FROM document_lines"),
    "match_document_lines": (
        ["document_lines", "benchmark_lines"],
        f"""
        SELECT doc_id, line_no, value FROM document_lines
        WHERE trim(split_part(value, ',', 1), {_WS}) IN (SELECT k FROM benchmark_lines)""",
    ),
    "match_whole_lines": (
        ["document_lines", "benchmark_lines"],
        "SELECT doc_id, line_no, value FROM document_lines WHERE value IN (SELECT k FROM benchmark_lines)",
    ),
    "sample_lines": (
        ["probe", "segment_keys"],
        """
        SELECT pos, value[1:150] AS shown, k, CASE WHEN k <> '' THEN k IN (SELECT k FROM segment_keys) END AS in_list
        FROM (SELECT * FROM probe ORDER BY pos LIMIT 5)""",
    ),
    "sample_keys": (
        ["probe", "segment_keys"],
        """
        SELECT row_number() OVER (ORDER BY first_pos) AS ord, k, k IN (SELECT k FROM segment_keys) AS in_list
        FROM (SELECT k, min(pos) AS first_pos FROM probe WHERE k <> '' GROUP BY k ORDER BY first_pos LIMIT 10)""",
    ),
    "head_keys": (
        ["probe", "segment_keys"],
        """
        SELECT row_number() OVER (ORDER BY first_pos) AS ord, k, k IN (SELECT k FROM segment_keys) AS in_list
        FROM (SELECT k, min(pos) AS first_pos FROM probe WHERE k <> '' GROUP BY k ORDER BY first_pos LIMIT 10)""",
    ),
    "sample_members": (["segment_keys"], "SELECT k FROM segment_keys ORDER BY k LIMIT 3"),
    "first_matches": (["probe", "segment_keys"], f"{_MATCHED} ORDER BY pos LIMIT 10"),
    "undecodable_lines": (
        ["order_lines"],
        "SELECT pos, strlen(value) + 1 AS n_bytes FROM order_lines WHERE pos % 97 = 0",
    ),
    "first_rejects": (
        ["order_lines"],
        """
        SELECT pos, value || chr(65533) AS shown, strlen(value) + 1 AS n_bytes
        FROM order_lines WHERE pos % 97 = 0 ORDER BY pos LIMIT 10""",
    ),
    "key_variants": (
        ["written_keys", "hits"],
        """
        SELECT w.k, h.rule::bigint AS rule, CASE WHEN h.rule IS NOT NULL THEN w.p END AS found_as
        FROM written_keys w LEFT JOIN hits h ON h.k = w.k""",
    ),
    "key_pairs": (["column_pairs"], "SELECT left_col, right_col, n_left, n_right, n_common FROM column_pairs"),
    "key_estimates": (["column_pairs"], "SELECT left_col, right_col, true AS near FROM column_pairs"),
    "key_overlap": (["overlap"], "SELECT left_col, right_col, n_left, n_right, n_common FROM overlap"),
    "key_catalog": (
        ["overlap"],
        """
        SELECT left_col, right_col, CASE WHEN n_common > 0 THEN 'match' ELSE 'no match' END AS note,
               round(n_common * 100.0::double / least(n_left, n_right), 1) AS pct_common
        FROM overlap""",
    ),
    "parquet_to_lines": (
        [],
        """
        SELECT concat_ws(',', coalesce(l_orderkey::varchar, ''), coalesce(l_partkey::varchar, ''), coalesce(l_suppkey::varchar, ''),
                         coalesce(l_linenumber::varchar, ''), coalesce(l_quantity::varchar, ''), coalesce(l_extendedprice::varchar, ''),
                         coalesce(l_discount::varchar, ''), coalesce(l_tax::varchar, ''), coalesce(l_returnflag, ''),
                         coalesce(l_linestatus, ''), coalesce(l_shipdate::varchar, '')) AS value
        FROM lineitem""",
    ),
    "line_numbers": ([], "SELECT count(*) AS n_lines, true AS complete FROM orders"),
    "gz_roundtrip": (["order_lines"], "SELECT value FROM order_lines"),
    "match_files": (
        ["probe", "segment_keys"],
        """
        SELECT row_number() OVER (ORDER BY pos) AS line_no, value
        FROM probe WHERE pos % 97 <> 0 AND k IN (SELECT k FROM segment_keys)""",
    ),
    "run_statuses": (
        ["probe", "segment_keys"],
        """
        SELECT * FROM (WITH n AS (SELECT count(*) FILTER (pos % 97 <> 0) AS good, count(*) FILTER (pos % 97 = 0) AS bad,
                          count(*) FILTER (pos % 97 <> 0 AND k IN (SELECT k FROM segment_keys)) AS hits FROM probe)
        SELECT 'data' AS data, 'keys' AS keys, 'matched' AS status, good AS n_processed, hits AS n_matches, bad AS n_errors, true AS written FROM n
        UNION ALL SELECT 'data', 'others', 'no matches', good, 0, bad, false FROM n
        UNION ALL SELECT 'blank', 'keys', 'no rows', 0, 0, 0, false
        UNION ALL SELECT 'data', 'none', 'empty key list', NULL, NULL, NULL, false)""",
    ),
    "match_one_file": (
        ["probe", "segment_keys"],
        """
        SELECT row_number() OVER (ORDER BY pos) AS line_no, value
        FROM probe WHERE pos % 97 <> 0 AND k IN (SELECT k FROM segment_keys)""",
    ),
    "gz_ranges": (["order_lines"], "SELECT row_number() OVER (ORDER BY pos) AS line_no, value FROM order_lines"),
    "stream_match": (
        ["probe", "segment_keys"],
        "SELECT value FROM probe WHERE k IN (SELECT k FROM segment_keys)",
    ),
    "stream_progress": (
        ["probe", "segment_keys"],
        """
        SELECT count(*) + count(*) FILTER (pos % 89 = 0) AS n_lines, count(*) FILTER (pos % 97 <> 0) AS n_processed,
               count(*) FILTER (pos % 97 = 0) AS n_errors,
               count(*) FILTER (pos % 97 <> 0 AND k IN (SELECT k FROM segment_keys)) AS n_matches
        FROM probe""",
    ),
    "union_buckets": (
        ["inventory", "sourced"],
        "SELECT source_no, s.source, s.key, s.size FROM sourced s JOIN inventory i ON i.key = s.key WHERE i.doc_id % 3 <> 0",
    ),
    "parse_paths": (
        ["page_paths"],
        """
        SELECT page_id, host AS plain_bucket, rest AS plain_key, host AS uri_bucket,
               ltrim(replace(rest, '/', '//'), '/') AS uri_key, host AS arg_bucket,
               CASE WHEN rest = '' OR ends_with(rest, '/') THEN rest ELSE rest || '/' END AS arg_prefix,
               'given' AS given_prefix
        FROM (SELECT page_id, split_part(key, '/', 1) AS host,
                     CASE WHEN contains(key, '/') THEN key[strpos(key, '/') + 1:] ELSE '' END AS rest
              FROM page_paths)""",
    ),
    "folder_tree": (
        ["page_paths"],
        """
        SELECT path, length(path) - length(replace(path, '/', '')) AS depth,
               repeat('    ', (length(path) - length(replace(path, '/', '')))::int) || '|-- ' || string_split(path, '/')[-1] AS label
        FROM (SELECT DISTINCT unnest(list_transform(range(1, len(a)), lambda i: array_to_string(a[1:i], '/'))) AS path
              FROM (SELECT string_split(rtrim(key, '/'), '/') AS a FROM page_paths))""",
    ),
    "folder_rollup": (
        ["host_folders"],
        """
        SELECT source, count(*) AS n_objects, count(DISTINCT nullif(folder, '')) AS n_folders
        FROM host_folders GROUP BY source""",
    ),
    "folder_list": (["host_folders"], "SELECT DISTINCT source, folder FROM host_folders WHERE folder <> ''"),
    "folder_cap": (
        ["host_folders"],
        """
        SELECT source, folder, rn, greatest(n - 2, 0) AS n_more FROM (
            SELECT source, folder, row_number() OVER (PARTITION BY source ORDER BY folder) AS rn,
                   count(*) OVER (PARTITION BY source) AS n
            FROM (SELECT DISTINCT source, folder FROM host_folders WHERE folder <> ''))
        WHERE rn <= 2""",
    ),
    "strip_suffix": (
        ["inventory"],
        """
        SELECT doc_id, regexp_replace('a.gz.d/' || key, '\\.gz$', '') AS at_end,
               replace('a.gz.d/' || key, '.gz', '') AS everywhere
        FROM inventory""",
    ),
    "union_sources": (["sourced"], "SELECT source_no, source, key, size FROM sourced"),
    "many_sources": (
        [],
        """
        SELECT source_no, source, rtrim(source[12:], '/') || CASE WHEN ends_with(source, '/') THEN '/' ELSE '' END AS prefix,
               count(*) AS n_files, sum(floor(o_totalprice)::bigint)::bigint AS n_bytes
        FROM (SELECT c_custkey * 2 AS source_no, 's3://wharf/in/' || c_custkey AS source, c_custkey AS k, NULL AS s FROM customer
              UNION ALL
              SELECT c_custkey * 2 + 1, 's3://wharf/in/' || c_custkey || '/F/', c_custkey, 'F' FROM customer WHERE c_custkey % 3 = 0)
        JOIN orders ON o_custkey = k AND (s IS NULL OR o_orderstatus = s)
        GROUP BY ALL""",
    ),
    "rebase_paths": (
        ["sourced"],
        """
        SELECT row_number() OVER (ORDER BY source_no, key) AS task_no, source_no, key AS src,
               'out/' || key[4:] AS dst
        FROM sourced""",
    ),
    "duplicate_targets": (
        ["inventory"],
        "SELECT 'out/' || key[4:] AS dst, 2::bigint AS n FROM inventory WHERE ends_with(key, '0.csv')",
    ),
    "visible_files": (
        ["files"],
        "SELECT path, size FROM files WHERE NOT (path LIKE '.%' OR path LIKE '%/.%')",
    ),
    "gz_twins": (
        ["with_twins"],
        """
        SELECT path, size FROM with_twins w
        WHERE NOT (path LIKE '.%' OR path LIKE '%/.%')
          AND (path LIKE '%.gz' OR NOT EXISTS (SELECT 1 FROM with_twins g WHERE g.path = w.path || '.gz'))""",
    ),
    "sync_plan": (
        ["plan"],
        """
        SELECT path, size, dst, action, CASE WHEN path LIKE '%.gz' THEN 'yes' END AS compressed_source,
               string_split(path, '/')[-1][1:30] AS shown
        FROM plan""",
    ),
    "ledger_pending": (
        [],
        """
        SELECT doc_id::varchar AS key FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
    ),
    "reconcile_sizes": (
        ["destination"],
        """
        SELECT i.key AS src, regexp_replace(i.key, '\\.gz$', '') AS dst, i.size, d.size AS dst_size,
               CASE WHEN d.key IS NULL THEN 'missing' WHEN d.size = i.size THEN 'verified' ELSE 'mismatch' END AS "check"
        FROM inventory i LEFT JOIN destination d ON d.key = regexp_replace(i.key, '\\.gz$', '')""",
    ),
    "outcome_summary": (
        ["outcomes"],
        """
        SELECT count(*) AS n_total, count(*) FILTER (status NOT IN ('skipped', 'error')) AS n_uploaded,
               count(*) FILTER (status = 'skipped') AS n_skipped, count(*) FILTER (status = 'error') AS n_errors
        FROM outcomes""",
    ),
    "completed": (
        ["outcomes"],
        "SELECT count(*) FILTER (status <> 'error') AS n_done, count(*) AS n_total FROM outcomes",
    ),
    "copy_volume": (
        ["inventory"],
        """
        SELECT source, count(*) AS n_files, sum(size)::bigint AS n_bytes,
               round(sum(size) * 100.0::double / (SELECT sum(size) FROM inventory), 1) AS pct
        FROM inventory GROUP BY source""",
    ),
    "decompress_job": (["order_lines"], f"{_BUCKETS}, 0::bigint AS n_again FROM order_lines GROUP BY 1"),
    "resumed_unpack": (
        ["order_lines"],
        """
        SELECT unnest(range(count(DISTINCT pos % 16) // 4)) AS batch, 4::bigint AS n_files, 4::bigint AS n_uploaded,
               0::bigint AS n_errors, 4::bigint AS n_marks, count(*) AS n_lines, sum(strlen(value) + 1)::bigint AS n_line_bytes
        FROM order_lines""",
    ),
    "copy_job": (["order_lines"], f"{_BUCKETS} FROM order_lines GROUP BY 1"),
    "transfer_rate": (
        ["order_lines"],
        """
        SELECT sum(strlen(value) + 1)::bigint AS n_bytes, format('{:,}', sum(strlen(value) + 1)::bigint) AS n_bytes_text, true AS has_rate
        FROM order_lines""",
    ),
    "copy_log": (
        ["inventory"],
        """
        SELECT * FROM (WITH named AS (SELECT * FROM (VALUES ('s3://wharf/in/src1/', 'in/src1/'), ('s3://wharf/in/src1/en/', 'in/src1/en/'),
                                             ('s3://wharf/in/src2/', 'in/src2/')) AS t(source, prefix)),
        hit AS (SELECT named.source, key[length(prefix) + 1:] AS rest FROM named JOIN inventory ON starts_with(key, prefix)),
        folder AS (SELECT source, folder, row_number() OVER (PARTITION BY source ORDER BY folder) AS rn, count(*) OVER (PARTITION BY source) AS n
                   FROM (SELECT DISTINCT source, regexp_replace(rest, '/[^/]*$', '') AS folder FROM hit WHERE contains(rest, '/'))),
        lines AS (
            SELECT 0 AS kind, source, 0 AS place, '  ' || source || ': ' || count(*) || ' objects, '
                   || (SELECT count(*) FROM folder f WHERE f.source = hit.source) || ' nested folder(s):' AS line FROM hit GROUP BY source
            UNION ALL SELECT 0, source, rn, '    ' || folder FROM folder WHERE rn <= 2
            UNION ALL SELECT DISTINCT 0, source, 3, '    ... and ' || (n - 2) || ' more' FROM folder WHERE n > 2
            UNION ALL SELECT 1, '', 0, '  Total: ' || count(*) || ' objects. Starting copy.' FROM hit)
        SELECT row_number() OVER (ORDER BY kind, source, place) AS line_no, line FROM lines)""",
    ),
    "upload_job": (["order_lines"], f"{_BUCKETS}, 0::bigint AS n_left FROM order_lines GROUP BY 1"),
    "scan_inventory": (
        ["order_lines"],
        "SELECT 'verified' AS \"check\", sum(strlen(value) + 1)::bigint AS n_bytes FROM order_lines",
    ),
    "run_log": (
        ["outcomes"],
        """
        SELECT count(*) AS n_lines, count(*) AS n_stamped, count(*) FILTER (status = 'uploaded') AS n_done
        FROM outcomes""",
    ),
}

ORACLE_SQL: dict[str, str] = {name: _with(views, body) for name, (views, body) in _ORACLE.items()}
