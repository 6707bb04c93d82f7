"""The same results in SQL, over the driver's tables."""

from __future__ import annotations

# --- the event feed --------------------------------------------------------

EVENT_FEED = """
e0 AS (
  SELECT CASE WHEN hour(ts) < 6 THEN 'PRIOR' ELSE 'TODAY' END AS role,
         event_type AS table_name,
         CAST(ts AS DATE) AS file_date,
         CAST(hour(ts) + 1 AS INTEGER) AS sequence,
         event_id + 1 AS line_no,
         CASE WHEN value < 1 THEN replace(props, '}', '')
              WHEN value < 2 THEN '  ' ELSE props END AS raw_line
  FROM events),
e1 AS (
  SELECT *, table_name || '-' || strftime(file_date, '%Y-%m-%d') || '-' || sequence || '.json' AS file_name,
         CASE role WHEN 'PRIOR' THEN 0 ELSE 1 END AS role_rank,
         CASE WHEN trim(raw_line) = '' THEN 'blank'
              WHEN NOT json_valid(raw_line) THEN 'reject' ELSE 'record' END AS line_kind
  FROM e0),
e AS (
  SELECT *, lower(role) || '/' || table_name || '/' || file_name AS file_path,
         CASE WHEN line_kind = 'record' THEN
           sha256(table_name || chr(31) || 'k' || chr(31)
                  || coalesce(json_extract_string(raw_line, '$.k'), '<null>') || chr(31)) END AS dedup_key
  FROM e1),
ranked AS (
  SELECT *,
         row_number() OVER first_of_key AS place,
         first_value(role_rank) OVER first_of_key AS first_rank,
         first_value(file_path) OVER first_of_key AS first_path,
         first_value(line_no) OVER first_of_key AS first_line_no
  FROM e WHERE line_kind = 'record'
  WINDOW first_of_key AS (PARTITION BY table_name, file_date, dedup_key
                          ORDER BY role_rank, sequence, file_path, line_no)),
dups AS (SELECT * FROM ranked WHERE role_rank = 1 AND place > 1),
per_file AS (
  SELECT e.role, e.table_name, e.file_date, e.sequence, e.file_path,
         count(*) FILTER (e.line_kind = 'record') AS read_count,
         count(*) FILTER (e.line_kind = 'reject') AS skipped_count,
         count(*) FILTER (e.line_kind = 'blank') AS blank_count,
         count(*) FILTER (e.line_kind = 'record' AND (e.role_rank = 0 OR r.place = 1)) AS written_count
  FROM e LEFT JOIN ranked r ON r.line_no = e.line_no
  GROUP BY ALL),
per_table AS (
  SELECT table_name, file_date,
         CAST(sum(read_count) AS BIGINT) AS total_processed,
         CAST(sum(read_count - written_count) AS BIGINT) AS total_duplicates,
         CAST(sum(skipped_count) AS BIGINT) AS total_rejected
  FROM per_file WHERE role = 'TODAY' GROUP BY ALL),
left_over AS (
  SELECT table_name, file_date,
         CAST(coalesce(sum(written_count) FILTER (role = 'TODAY'), 0) AS BIGINT) AS new,
         CAST(coalesce(sum(read_count + skipped_count + blank_count) FILTER (role = 'PRIOR'), 0) AS BIGINT) AS old
  FROM per_file GROUP BY ALL)
"""


def _events(select: str) -> str:
    return f"WITH {EVENT_FEED} {select}"


# --- the change feed, as written files -------------------------------------

CHANGE_FEED = """
c0 AS (
  SELECT CASE WHEN hour(ts) < 6 THEN 'PRIOR' ELSE 'TODAY' END AS role,
         event_type AS table_name,
         CAST(date_trunc('week', ts) AS DATE) AS file_date,
         CAST(event_id // 1000 + 1 AS INTEGER) AS chunk,
         event_id, value,
         '{"Source":{"Table":"' || event_type || '","System":"CORE"},"ChangeData":{"id":"'
           || lpad(CAST(user_id AS VARCHAR), 12, '0') || '","ChangeDateTime":"'
           || strftime(ts, '%Y-%m-%d') || 'T00:00:00.00Z","Operation":"UPSERT"},"Data":{"_creationdate":"'
           || strftime(ts, '%Y-%m-%d') || 'T00:00:00.00Z","detail":' || props || '}' AS body
  FROM events),
c1 AS (
  SELECT *, CASE WHEN value < 1 THEN body WHEN value < 2 THEN '  ' ELSE body || '}' END AS raw_line,
         CASE WHEN value < 1 THEN 'reject' WHEN value < 2 THEN 'blank' ELSE 'record' END AS line_kind,
         strftime(file_date, '%Y-%m-%d') AS day,
         CASE role WHEN 'PRIOR' THEN 1 ELSE chunk END AS sequence,
         CASE role WHEN 'PRIOR' THEN 0 ELSE 1 END AS role_rank,
         row_number() OVER (PARTITION BY role, table_name, file_date, chunk ORDER BY event_id) AS line_no
  FROM c0),
c AS (
  SELECT *, CASE role
      WHEN 'PRIOR' THEN 'published/' || table_name || '/' || day || '/MERGED=' || table_name || '-' || day
                        || '.part' || lpad(CAST(chunk AS VARCHAR), 6, '0') || '.json'
      ELSE 'feed/' || day || '/' || table_name || '/' || table_name || '-' || day || '-' || chunk || '.json'
    END AS file_path
  FROM c1),
kept AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
             PARTITION BY table_name, file_date,
               json_extract_string(raw_line, '$.ChangeData.id'),
               json_extract_string(raw_line, '$.ChangeData.ChangeDateTime'),
               json_extract_string(raw_line, '$.Data._creationdate')
             ORDER BY role_rank, sequence, file_path, line_no) AS place
    FROM c WHERE line_kind = 'record')
  WHERE place = 1 AND role = 'TODAY')
"""


def _changes(select: str) -> str:
    return f"WITH {CHANGE_FEED} {select}"


# --- customers -------------------------------------------------------------

CUSTOMER_FEED = """
cents AS (
  SELECT *, CAST(round(abs(c_acctbal) * 100) AS BIGINT) AS cents FROM customer),
cust AS (
  SELECT c_custkey AS custkey, 'customer' AS table_name,
         '{' || CASE WHEN c_acctbal < 0 THEN '"Source":{"Table":null},'
                     WHEN c_nationkey < 5 THEN ''
                     ELSE '"Source":{"Table":"' || c_mktsegment || '"},' END
         || '"Data":{"name":"' || c_name || '","balance":' || (cents // 100) || '.'
         || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') || ',"nation":'
         || CASE WHEN c_nationkey > 20 THEN 'null'
                 ELSE '{"key": ' || c_nationkey || ', "tags":["n", ' || c_nationkey || ']}' END
         || '}}' AS raw_line
  FROM cents),
eff AS (
  SELECT *, coalesce(json_extract_string(raw_line, '$.Source.Table'), table_name) AS effective_table,
         coalesce(json_extract_string(raw_line, '$.Source.Table'), '<null>') AS part_table,
         coalesce(json_extract_string(raw_line, '$.Data.name'), '<null>') AS part_name,
         coalesce(json_extract_string(raw_line, '$.Data.balance'), '<null>') AS part_balance,
         coalesce(replace(replace(json_extract_string(raw_line, '$.Data.nation'), ': ', ':'), ', ', ','),
                  '<null>') AS part_nation
  FROM cust)
"""


def _customers(select: str) -> str:
    return f"WITH {CUSTOMER_FEED} {select}"


# --- generated records -----------------------------------------------------


def _generated(earlier: str) -> str:
    return f"""
WITH specs AS (
  SELECT event_type AS table_name, CAST(date_trunc('month', ts) AS DATE) AS file_date, count(*) AS total
  FROM events GROUP BY ALL),
g AS (SELECT table_name, file_date, unnest(range(1, total + 1)) AS i FROM specs),
s AS (SELECT *, CASE WHEN i % 20 = 0 THEN {earlier} ELSE i END AS src FROM g),
t AS (SELECT *, strftime(file_date, '%Y-%m-%d') || 'T' || printf('%02d:%02d:%02d.00Z',
             src % 24, (src // 24) % 60, (src // 1440) % 60) AS made FROM s)
SELECT table_name, file_date, CAST((i - 1) // 500 + 1 AS INTEGER) AS sequence,
       CAST((i - 1) % 500 + 1 AS BIGINT) AS line_no,
       printf('{{"Source":{{"Table":"%s","System":"CORE"}},"ChangeData":{{"id":"%012d","ChangeDateTime":"%s","Operation":"UPSERT"}},"Data":{{"_creationdate":"%s","accountId":"A%03d","status":"OPEN","balanceBand":"HIGH"}}}}',
              table_name, src, made, made, src % 900 + 100) AS raw_line
FROM t"""


MESSY = "('click', 'purchase', 'view')"

_SUMMARY_ROWS = """
  SELECT p.*, old + new AS output_count,
         'MERGED=' || p.table_name || '-' || strftime(p.file_date, '%Y-%m-%d') || '.json' AS output_file
  FROM per_table p JOIN left_over USING (table_name, file_date)"""

ORACLES: dict[str, str] = {
    "ndjson_scan": _changes(
        "SELECT table_name, file_date, sequence, file_path, line_no, raw_line FROM c WHERE role = 'TODAY'"
    ),
    "file_name_parse": """
WITH n AS (
  SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderstatus AS st, o_orderpriority AS pr FROM orders),
named AS (
  SELECT o_orderkey, CASE pr
      WHEN '1-URGENT' THEN st || '-' || day || '-' || o_orderkey || '.csv'
      WHEN '2-HIGH' THEN st || '-' || substr(day, 1, 4) || '-13-' || substr(day, 9, 2) || '-' || o_orderkey || '.json'
      WHEN '3-MEDIUM' THEN 'Sub_' || st || '-' || day || '-' || o_orderkey || '.json'
      WHEN '5-LOW' THEN st || '-' || day || '-' || o_orderkey || '000000.json'
      ELSE st || '-' || day || '.json' END AS file_name
  FROM n),
parts AS (
  SELECT *, regexp_extract(file_name, '^([A-Za-z0-9_]+)-([0-9]{4}-[0-9]{2}-[0-9]{2})-([0-9]+)\\.json$', 1) AS t,
         try_cast(regexp_extract(file_name, '^([A-Za-z0-9_]+)-([0-9]{4}-[0-9]{2}-[0-9]{2})-([0-9]+)\\.json$', 2) AS DATE) AS d,
         try_cast(regexp_extract(file_name, '^([A-Za-z0-9_]+)-([0-9]{4}-[0-9]{2}-[0-9]{2})-([0-9]+)\\.json$', 3) AS INTEGER) AS s
  FROM named),
good AS (SELECT *, coalesce(d IS NOT NULL AND s >= 1, false) AS is_input FROM parts)
SELECT o_orderkey, file_name, CASE WHEN is_input THEN t END AS table_name, CASE WHEN is_input THEN d END AS file_date,
       CASE WHEN is_input THEN CAST(s AS BIGINT) END AS sequence, is_input
FROM good""",
    "today_files": _changes(f"""
SELECT role, table_name, file_date, sequence, file_path, regexp_extract(file_path, '[^/]+$') AS file_name,
       CAST(sum(strlen(raw_line) + 1) AS BIGINT) AS file_bytes
FROM c WHERE role = 'TODAY' AND table_name IN {MESSY} GROUP BY ALL"""),
    "baseline_scan": _changes(
        "SELECT role, table_name, file_date, sequence, file_path, line_no, raw_line FROM c WHERE role = 'PRIOR'"
    ),
    "allowed_tables": """
WITH l AS (
  SELECT c_custkey + 1 AS line_no, CASE WHEN c_nationkey < 3 THEN ' ' || chr(9) || ' '
      WHEN c_nationkey < 8 THEN chr(9) || '# ' || c_mktsegment
      WHEN c_acctbal < 0 THEN chr(9) || ' ' || lower(c_mktsegment) || ' ' || chr(9)
      ELSE c_mktsegment || '_' || c_nationkey END AS value
  FROM customer), t AS (SELECT line_no, trim(value, ' ' || chr(9)) AS value FROM l)
SELECT lower(value) AS table_name, min(line_no) AS position FROM t
WHERE value <> '' AND value NOT LIKE '#%' GROUP BY 1""",
    "allowed_rows": _events(
        f"SELECT table_name, file_date, count(*) AS line_count FROM e WHERE table_name IN {MESSY} GROUP BY ALL"
    ),
    "generate_feed": _generated("i - 1"),
    "generate_feed_across_files": _generated("(i - 1) % 500 + 1"),
    "blank_filter": """
WITH s AS (SELECT doc_id, regexp_split_to_array(text, '\\r\\n|\\r|\\n') AS parts FROM documents),
l AS (SELECT doc_id, unnest(range(1, len(parts) + 1)) AS line_no, unnest(parts) AS raw_line FROM s)
SELECT doc_id, line_no, raw_line FROM l WHERE NOT regexp_full_match(raw_line, '\\s*')""",
    "json_rejects": _events("""
SELECT role, table_name, file_path, line_no, raw_line, 'invalid data/format' AS reason
FROM e WHERE line_kind = 'reject'"""),
    "json_path_extract": _customers("""
SELECT custkey, nullif(part_table, '<null>') AS source_table, nullif(part_name, '<null>') AS name,
       json_extract_string(raw_line, '$.Data.nation.key') AS nation_key,
       nullif(part_nation, '<null>') AS nation, CAST(NULL AS VARCHAR) AS absent FROM eff"""),
    "key_part_text": _customers("""
SELECT custkey, part_table AS source_table, part_balance AS balance, part_nation AS nation,
       coalesce(json_extract_string(raw_line, '$.Data.nation.key'), '<null>') AS nation_key FROM eff"""),
    "effective_table": _customers("SELECT custkey, effective_table FROM eff"),
    "key_fields_by_table": _customers("""
SELECT custkey, effective_table,
       CASE WHEN effective_table IN ('BUILDING', 'MACHINERY') THEN 'Data.balance'
            WHEN effective_table = 'furniture' THEN 'Data.nation' ELSE 'Source.Table,Data.name' END AS fields,
       CASE WHEN lower(effective_table) IN ('building', 'machinery') THEN 'Data.balance'
            WHEN lower(effective_table) = 'furniture' THEN 'Data.nation'
            ELSE 'Source.Table,Data.name' END AS fields_any_case
FROM eff"""),
    "dedup_key": _customers("""
SELECT custkey, effective_table, sha256(effective_table || chr(31) || CASE
    WHEN effective_table IN ('BUILDING', 'MACHINERY') THEN 'Data.balance' || chr(31) || part_balance || chr(31)
    WHEN effective_table = 'furniture' THEN 'Data.nation' || chr(31) || part_nation || chr(31)
    ELSE 'Source.Table' || chr(31) || part_table || chr(31) || 'Data.name' || chr(31) || part_name || chr(31)
  END) AS dedup_key FROM eff"""),
    "output_names": _events("""
SELECT DISTINCT file_name, role, 'MERGED=' || table_name || '-' || strftime(file_date, '%Y-%m-%d') || '.json' AS merged_name,
       lower(role) || '-' || table_name || '-' || sequence AS partition_name,
       lpad(CAST(sequence AS VARCHAR), 2, '0') || '-' || file_name || '.part' AS part_name,
       regexp_replace(role || ' / ' || file_name, '[^A-Za-z0-9._-]', '_', 'g') AS run_id
FROM e"""),
    "duration_text": """
WITH m AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS millis FROM orders)
SELECT o_orderkey, millis, CASE
    WHEN millis >= 3600000 THEN printf('%dh %dm %d.%03ds', millis // 3600000, millis % 3600000 // 60000, millis % 60000 // 1000, millis % 1000)
    WHEN millis >= 60000 THEN printf('%dm %d.%03ds', millis // 60000, millis % 60000 // 1000, millis % 1000)
    ELSE printf('%d.%03ds', millis // 1000, millis % 1000) END AS duration
FROM m""",
    "throughput": _events("""
SELECT file_path, round(CAST(read_count AS DOUBLE) / greatest(1, sequence), 6) AS per_second
FROM per_file WHERE role = 'TODAY'"""),
    "repeated_fields": """
SELECT c_custkey AS custkey, true AS is_json, CAST(c_custkey AS VARCHAR) AS n,
       CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) AS VARCHAR) || '.5' AS balance,
       '{"key":' || c_nationkey || '}' AS nation, CAST(c_nationkey AS VARCHAR) AS nation_key
FROM customer""",
    "run_date_files": _changes("""
SELECT role, file_date, CAST(row_number() OVER (PARTITION BY role, file_date
         ORDER BY table_name, sequence, file_path) AS INTEGER) AS place, file_path
FROM (SELECT DISTINCT role, file_date, table_name, sequence, file_path FROM c WHERE day(file_date) <= 15)"""),
    "run_date_lines": _changes("""
SELECT role, table_name, file_date, file_path, line_no, raw_line FROM c WHERE day(file_date) <= 15"""),
    "publish_single_merge": _changes("""
SELECT table_name, file_date, 'MERGED=' || table_name || '-' || day || '.json' AS file_name,
       row_number() OVER (PARTITION BY table_name, file_date
         ORDER BY role_rank, sequence, file_path, line_no) AS merge_position, raw_line
FROM (SELECT table_name, file_date, day, role_rank, sequence, file_path, line_no, raw_line FROM kept
      UNION ALL
      SELECT table_name, file_date, day, role_rank, sequence, file_path, line_no, raw_line FROM c WHERE role = 'PRIOR')"""),
    "baseline_index": _events("""
SELECT table_name AS scope_table, file_date, dedup_key, file_path AS first_path, line_no AS first_line_no
FROM (SELECT *, row_number() OVER (PARTITION BY table_name, file_date, dedup_key
                                   ORDER BY sequence, file_path, line_no) AS n
      FROM e WHERE line_kind = 'record' AND role = 'PRIOR')
WHERE n = 1"""),
    "baseline_anti_join": _events("""
SELECT table_name, file_date, file_path, line_no, raw_line FROM e t
WHERE line_kind = 'record' AND role = 'TODAY' AND NOT EXISTS (
  SELECT 1 FROM e p WHERE p.role = 'PRIOR' AND p.line_kind = 'record' AND p.table_name = t.table_name
    AND p.file_date = t.file_date AND p.dedup_key = t.dedup_key)"""),
    "kept_baseline_anti_join": _changes("""
SELECT table_name, file_date, file_path, line_no, raw_line FROM c t
WHERE line_kind = 'record' AND role = 'TODAY' AND NOT EXISTS (
  SELECT 1 FROM c p WHERE p.role = 'PRIOR' AND p.line_kind = 'record' AND p.table_name = t.table_name
    AND p.file_date = t.file_date
    AND json_extract_string(p.raw_line, '$.ChangeData.id') = json_extract_string(t.raw_line, '$.ChangeData.id')
    AND json_extract_string(p.raw_line, '$.ChangeData.ChangeDateTime') = json_extract_string(t.raw_line, '$.ChangeData.ChangeDateTime'))"""),
    "key_membership": _events("""
SELECT table_name, file_date, file_path, line_no, first_rank = 0 AS is_known,
       CASE WHEN first_rank = 0 THEN first_path END AS first_path,
       CASE WHEN first_rank = 0 THEN first_line_no END AS first_line_no
FROM ranked WHERE role = 'TODAY'"""),
    "within_batch_dedup": _events("""
SELECT table_name, file_date, file_path, line_no, raw_line
FROM (SELECT *, row_number() OVER (PARTITION BY table_name, file_date, dedup_key
                                   ORDER BY sequence, file_path, line_no) AS n
      FROM e WHERE line_kind = 'record' AND role = 'TODAY')
WHERE n = 1"""),
    "full_dedup": _events("""
SELECT table_name, file_date, file_path, line_no, sequence, raw_line
FROM ranked WHERE place = 1 AND role = 'TODAY'"""),
    "full_dedup_lineitem": """
WITH l AS (
  SELECT l_returnflag AS table_name, DATE '2024-01-01' AS file_date, CAST(l_linenumber AS INTEGER) AS sequence,
         l_orderkey AS line_no, CASE WHEN l_linenumber <= 2 THEN 'prior' ELSE 'today' END AS role,
         printf('{"Data":{"p":%d,"s":%d}}', l_partkey, l_suppkey) AS raw_line, l_partkey, l_suppkey
  FROM lineitem),
p AS (SELECT *, role || '/' || table_name || '/' || table_name || '-2024-01-01-' || sequence || '.json' AS file_path FROM l)
SELECT table_name, file_date, file_path, line_no, sequence, raw_line
FROM (SELECT *, row_number() OVER (PARTITION BY table_name, l_partkey, l_suppkey
                                   ORDER BY role, sequence, file_path, line_no) AS n FROM p)
WHERE n = 1 AND role = 'today'""",
    "duplicate_provenance": _events("""
SELECT table_name, file_date, file_path, line_no, dedup_key, first_path, first_line_no FROM dups"""),
    "duplicate_kinds": _events("""
SELECT table_name, file_date, CASE WHEN first_rank = 0 THEN 'baseline' WHEN first_path = file_path THEN 'same_file'
       ELSE 'cross_file' END AS dup_kind, count(*) AS duplicate_count
FROM dups GROUP BY ALL"""),
    "hot_key_provenance": _events("""
SELECT table_name, file_date, file_path, line_no, first_path, first_line_no,
       CASE WHEN first_rank = 0 THEN 'baseline' WHEN first_path = file_path THEN 'same_file'
            ELSE 'cross_file' END AS dup_kind
FROM (SELECT table_name, file_date, file_path, line_no, role_rank,
             row_number() OVER w AS place, first_value(role_rank) OVER w AS first_rank,
             first_value(file_path) OVER w AS first_path, first_value(line_no) OVER w AS first_line_no
      FROM e WHERE line_kind = 'record'
      WINDOW w AS (PARTITION BY table_name, file_date ORDER BY role_rank, sequence, file_path, line_no))
WHERE role_rank = 1 AND place > 1"""),
    "file_summary": _events("""
SELECT table_name, file_date, sequence, file_path, read_count, written_count,
       read_count - written_count AS filtered_count, skipped_count
FROM per_file WHERE role = 'TODAY'"""),
    "table_summary": _events("SELECT * FROM per_table"),
    "job_totals": _events(f"""
SELECT count(*) AS table_count, CAST(sum(total_processed) AS BIGINT) AS total_processed,
       CAST(sum(total_duplicates) AS BIGINT) AS total_duplicates,
       CAST(sum(total_rejected) AS BIGINT) AS total_rejected,
       CAST(sum(output_count) AS BIGINT) AS output_count
FROM ({_SUMMARY_ROWS})"""),
    "output_counts": _events("""
SELECT table_name AS scope_table, file_date, old + new AS merge_count,
       CASE WHEN new > 0 THEN new ELSE old END AS replace_count
FROM left_over"""),
    "input_volume": _changes("""
SELECT file_date, table_name, count(*) AS line_count FROM c WHERE role = 'TODAY'
GROUP BY ROLLUP (file_date, table_name)"""),
    "reject_threshold": _events("""
SELECT table_name, file_date, file_path, skipped_count FROM per_file
WHERE role = 'PRIOR' AND skipped_count > 0"""),
    "merged_output": _changes("""
SELECT table_name, file_date, row_number() OVER (PARTITION BY table_name, file_date
         ORDER BY sequence, file_path, line_no) AS merge_position, raw_line
FROM kept"""),
    "even_parts": _events("""
, sized AS (
  SELECT table_name, file_date, role, file_path, line_no, strlen(raw_line) + 1 AS size,
         coalesce(sum(strlen(raw_line) + 1) OVER (ORDER BY table_name, file_date, role, file_path, line_no
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead,
         sum(strlen(raw_line) + 1) OVER () AS total
  FROM e)
SELECT CAST(ahead // ((total + 15) // 16) AS INTEGER) AS part, count(*) AS line_count,
       CAST(sum(size) AS BIGINT) AS byte_count,
       arg_min(file_path, ahead) AS file_path, arg_min(line_no, ahead) AS line_no
FROM sized GROUP BY ALL"""),
    "publish_replace": _changes("SELECT table_name, file_date, raw_line FROM kept"),
    "publish_merge": _changes("""
SELECT table_name, file_date, raw_line FROM kept
UNION ALL SELECT table_name, file_date, raw_line FROM c WHERE role = 'PRIOR'"""),
    "mixed_case_run": _changes(f"""
SELECT table_name AS scope_table, file_date, raw_line FROM kept WHERE table_name IN {MESSY}
UNION ALL SELECT table_name, file_date, raw_line FROM c WHERE role = 'PRIOR' AND table_name IN {MESSY}"""),
    "completion_manifest": _changes("""
SELECT day || '.trg' AS file_name, row_number() OVER (PARTITION BY day ORDER BY table_name) AS line_no,
       table_name || ',MERGED=' || table_name || '-' || day || '.json,' || count(*) AS line
FROM (SELECT table_name, day FROM kept UNION ALL SELECT table_name, day FROM c WHERE role = 'PRIOR')
GROUP BY table_name, day"""),
    "detail_report": _events("""
SELECT 'duplicate' AS section, 'Line ' || line_no || ' in ' || file_path || ' is a duplicate of line '
       || first_line_no || ' in ' || first_path AS line FROM dups
UNION ALL
SELECT 'reject', 'Line ' || line_no || ' in ' || file_path || ' has been rejected due to invalid data/format'
FROM e WHERE line_kind = 'reject'"""),
    "summary_report": _events(f"""
SELECT table_name, file_date, unnest(range(0, 5)) AS line_no, unnest([
    table_name || ':',
    chr(9) || 'Total Records processed: ' || total_processed,
    chr(9) || 'Total Rejected: ' || total_rejected,
    chr(9) || 'Total Duplicates: ' || total_duplicates,
    chr(9) || 'Files: output/' || table_name || '/' || strftime(file_date, '%Y-%m-%d') || '/' || output_file]) AS line
FROM ({_SUMMARY_ROWS})"""),
    "stream_dedup": _changes(
        "SELECT table_name, file_date, sequence, file_path, line_no, raw_line FROM kept"
    ),
}
# The same results by other routes.
ORACLES["prefiltered_anti_join"] = ORACLES["baseline_anti_join"]
ORACLES["kept_baseline_run"] = ORACLES["publish_merge"]
ORACLES["stream_publish"] = ORACLES["publish_merge"]
ORACLES["snapshot_read"] = ORACLES["publish_merge"]
