"""What each query has to return, as SQL over the base tables."""

from __future__ import annotations

from dropweave.plans.queries import LOOKUP_KEY, PARENTS_PER_CHUNK, ROWS_PER_BUCKET, ROWS_PER_SEGMENT, STREETS_PER_CHUNK

# The drop, rebuilt from the tables: f is the file number, k the key, s the serial.
_DROP = """
WITH data AS (
  SELECT CAST(c_custkey % 8 AS BIGINT) AS f, '21' AS t, CAST(c_custkey AS BIGINT) AS k,
         CAST(c_custkey AS BIGINT) AS s FROM customer
  UNION ALL SELECT o_custkey % 8, '24', o_custkey, o_orderkey FROM orders
  UNION ALL SELECT user_id % 8, '28', user_id, event_id FROM events
  UNION ALL SELECT n_nationkey % 8, '11', n_nationkey, n_nationkey FROM nation
  UNION ALL SELECT s_nationkey % 8, '15', s_nationkey, s_suppkey FROM supplier),
body AS (
  SELECT f, t, k, s, row_number() OVER (PARTITION BY f ORDER BY t, k, s) AS line_no FROM data),
sizes AS (
  SELECT r.f, count(b.f) AS n FROM range(8) AS r(f) LEFT JOIN body b ON b.f = r.f GROUP BY r.f),
lines AS (
  SELECT 'drop_' || f || '.csv' AS source_file, t AS record_type, k, s, line_no FROM body
  UNION ALL SELECT 'drop_' || f || '.csv', '10', NULL, NULL, 0 FROM sizes
  UNION ALL SELECT 'drop_' || f || '.csv', '29', NULL, NULL, n + 1 FROM sizes
  UNION ALL SELECT 'drop_' || f || '.csv', '99', NULL, NULL, n + 2 FROM sizes),
counts AS (
  SELECT source_file, record_type, count(*) AS n FROM lines GROUP BY ALL)
"""


def _drop(select: str) -> str:
    return _DROP + select


def _grouped(parent: str, children: dict[str, int]) -> str:
    """Rows of the groups: parents, and the children that have one."""
    ranks = " ".join(f"WHEN '{t}' THEN {rank}" for t, rank in {parent: 0, **children}.items())
    types = ", ".join(f"'{t}'" for t in (parent, *children))
    return f"""(
  SELECT k, CASE record_type {ranks} END AS type_rank, source_file, line_no, record_type, s
  FROM lines WHERE record_type IN ({types})
    AND k IN (SELECT k FROM lines WHERE record_type = '{parent}')) AS g"""


_UPRN = _grouped("21", {"24": 1, "28": 2})
_USRN = _grouped("11", {"15": 1})
_GAPPED = _grouped("11", {"24": 1, "28": 2})
_GROUP_COLUMNS = "k AS key, type_rank, source_file, line_no, record_type, s AS serial"
_BY_FILE_AND_TYPE = _drop("SELECT * FROM counts")
_MANIFEST = """
SELECT source_file, string_agg(record_type || ':' || n, ',' ORDER BY record_type) AS counts
FROM counts GROUP BY source_file"""


def _chunked(rows: str, parent: str, size: int) -> str:
    return f"""
, parents AS (
  SELECT k, min(i) AS i FROM (
    SELECT k, row_number() OVER (ORDER BY k, source_file, line_no) - 1 AS i
    FROM lines WHERE record_type = '{parent}') GROUP BY k),
chunks AS (
  SELECT g.*, 'part-' || lpad(CAST(i // {size} AS VARCHAR), 4, '0') || '.csv' AS part_file
  FROM {rows} JOIN parents USING (k))"""


def _ranked(record_type: str) -> str:
    return f"""
SELECT row_number() OVER (ORDER BY k, source_file, line_no) - 1 AS rank, record_type, k AS key, s AS serial
FROM lines WHERE record_type = '{record_type}'"""


_CHUNK_LINES = """
SELECT part_file, row_number() OVER (
         PARTITION BY part_file ORDER BY k, type_rank, source_file, line_no) - 1 AS line_no,
       record_type, k AS key, s AS serial
FROM chunks"""

ALL: dict[str, str] = {
    "q_raw_scan": _drop("SELECT source_file, count(*) AS n_lines, CAST(0 AS BIGINT) AS n_blank FROM lines GROUP BY ALL"),
    "q_line_numbers": _drop("SELECT source_file, line_no, record_type, k AS key FROM lines"),
    "q_gz_scan": _BY_FILE_AND_TYPE,
    "q_zip_scan": _BY_FILE_AND_TYPE,
    "q_file_list": _drop("SELECT DISTINCT source_file FROM lines"),
    "q_registry": _drop("""
SELECT t.id AS record_type, t.name, t.n_fields, count(l.record_type) AS n_lines, CAST(0 AS BIGINT) AS n_bad
FROM (VALUES ('10', 'Header', 4), ('11', 'Street', 6), ('15', 'StreetDescriptor', 6), ('21', 'BPLU', 7),
             ('24', 'LPI', 8), ('28', 'DeliveryPointAddress', 8), ('29', 'Metadata', 4),
             ('31', 'Organisation', 6), ('99', 'Trailer', 3)) AS t(id, name, n_fields)
LEFT JOIN lines l ON l.record_type = t.id GROUP BY ALL"""),
    "q_typed_scan": """
SELECT 28 AS RECORD_IDENTIFIER, 'I' AS CHANGE_TYPE, event_id AS PRO_ORDER, user_id AS UPRN, event_type AS EVENT,
       value AS VALUE, props AS PROPS, CAST(ts AS DATE) AS ENTRY_DATE FROM events""",
    "q_record_scan": "SELECT doc_id, md5(text) AS text_md5, CAST(length(text) AS INTEGER) AS n_chars, lang FROM documents",
    "q_sorted_scan": _drop(_ranked("28")),
    "q_count_records": _BY_FILE_AND_TYPE,
    "q_manifest": _drop(_MANIFEST),
    "q_mixed_files": _drop("""
SELECT source_file, count(*) AS n_types, count(*) > 1 AS mixed
FROM counts WHERE record_type NOT IN ('10', '29', '99') GROUP BY source_file"""),
    "q_files_for_type": _drop("SELECT source_file, n FROM counts WHERE record_type = '11'"),
    "q_pending_files": _drop("SELECT DISTINCT source_file FROM lines WHERE source_file >= 'drop_4.csv'"),
    "q_manifest_refresh": _drop(_MANIFEST),
    "q_type_filter": _drop("""
SELECT record_type, count(*) AS n FROM lines
WHERE record_type IN ('11', '15', '21', '24', '28', '31', '32') GROUP BY record_type"""),
    "q_drop_control": _drop("""
SELECT source_file, count(*) AS n FROM lines WHERE record_type NOT IN ('10', '29', '99') GROUP BY source_file"""),
    "q_positional_trim": _drop("""
SELECT source_file, count(*) AS n, min(line_no) AS first_line, max(line_no) AS last_line
FROM lines WHERE record_type NOT IN ('10', '29', '99') GROUP BY source_file"""),
    "q_key_extract": _drop("SELECT record_type, k AS key, s AS serial FROM lines WHERE k IS NOT NULL"),
    "q_key_cast": """
SELECT o_orderkey,
       CASE WHEN o_orderpriority = '1-URGENT' OR o_orderstatus = 'F' THEN NULL ELSE o_custkey END AS key
FROM orders""",
    "q_csv_parse": "SELECT user_id, event_id, event_type, value, props, CAST(ts AS DATE) AS day FROM events",
    "q_csv_format": """
SELECT event_id, event_id || ',' || user_id || ',' || event_type || ',"' || replace(props, '"', '""') || '"' AS line
FROM events""",
    "q_split": _drop("""
SELECT replace(source_file, '.csv', '_r' || record_type || '.csv') AS split_file, count(*) AS n,
       CAST(sum(k) AS BIGINT) AS key_sum
FROM lines WHERE k IS NOT NULL GROUP BY ALL"""),
    "q_merge_type": """
SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate
FROM orders""",
    "q_merge_all": _drop("""
SELECT 'Records_' || CASE record_type WHEN '11' THEN 'Street' WHEN '15' THEN 'StreetDescriptor' WHEN '21' THEN 'BPLU'
         WHEN '24' THEN 'LPI' ELSE 'DeliveryPointAddress' END || '.csv' AS merged_file,
       count(*) AS n, CAST(sum(k) AS BIGINT) AS key_sum
FROM lines WHERE k IS NOT NULL GROUP BY record_type"""),
    "q_header_sink": "SELECT CAST(s_nationkey AS BIGINT) AS s_nationkey, s_suppkey, s_name, s_acctbal FROM supplier",
    "q_null_sink": """
SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus, nullif(o_orderpriority, '1-URGENT') AS o_orderpriority
FROM orders""",
    "q_sort_uprn": _drop(_ranked("24")),
    "q_sort_usrn": _drop(_ranked("15")),
    "q_sort_multi": _drop(" UNION ALL ".join(_ranked(t) for t in ("21", "24", "28"))),
    "q_colocated": _drop(f"""
SELECT k AS key, CAST((sum(n) OVER (ORDER BY k) - n) // {ROWS_PER_BUCKET} AS BIGINT) AS bucket, n
FROM (SELECT k, count(*) AS n FROM lines WHERE record_type IN ('24', '28') GROUP BY k)"""),
    "q_global_index": _drop("""
SELECT row_number() OVER (ORDER BY k, source_file, line_no) - 1 AS row_index, k AS key, record_type, s AS serial
FROM lines WHERE record_type IN ('24', '28')"""),
    "q_group_uprn": _drop(f"SELECT {_GROUP_COLUMNS} FROM {_UPRN}"),
    "q_group_usrn": _drop(f"SELECT {_GROUP_COLUMNS} FROM {_USRN}"),
    "q_group_usrn_first": _drop(f"""
SELECT {_GROUP_COLUMNS} FROM {_USRN}
QUALIFY type_rank = 0 OR row_number() OVER (PARTITION BY type_rank, k ORDER BY source_file, line_no) = 1"""),
    "q_group_gapped": _drop(f"SELECT {_GROUP_COLUMNS} FROM {_GAPPED}"),
    "q_group_uprn_chunks": _drop(_chunked(_UPRN, "21", PARENTS_PER_CHUNK) + _CHUNK_LINES),
    "q_group_usrn_chunks": _drop(_chunked(_USRN, "11", STREETS_PER_CHUNK) + _CHUNK_LINES),
    "q_part_names": _drop(_chunked(_UPRN, "21", PARENTS_PER_CHUNK) + """
SELECT part_file, count(*) FILTER (type_rank = 0) AS n_parents, count(*) AS n_lines FROM chunks GROUP BY part_file"""),
    "q_group_uprn_nested": _drop(f"""
SELECT k AS key, CAST(0 AS BIGINT) AS segment, CAST(count(*) FILTER (type_rank = 0) AS INTEGER) AS n_parents,
       CAST(count(*) FILTER (type_rank = 1) AS INTEGER) AS n_24,
       CAST(count(*) FILTER (type_rank = 2) AS INTEGER) AS n_28,
       coalesce(string_agg(s, ',' ORDER BY source_file, line_no) FILTER (type_rank = 1), '') AS serials_24
FROM {_UPRN} GROUP BY k"""),
    "q_lookup_key": _drop(f"""
SELECT record_type, k AS key, s AS serial FROM lines
WHERE record_type IN ('21', '24', '28') AND k = {LOOKUP_KEY}"""),
    "q_lookup_colocated": _drop(f"""
SELECT record_type, k AS key, s AS serial FROM lines WHERE record_type IN ('24', '28') AND k = {LOOKUP_KEY}"""),
    "q_lookup_stored": _drop(f"""
SELECT record_type, k AS key, s AS serial FROM lines WHERE record_type IN ('24', '28') AND k = {LOOKUP_KEY}"""),
    "q_zones": _drop(f"""
SELECT bucket, min(k) AS first_key, max(k) AS last_key, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT k, n, CAST((sum(n) OVER (ORDER BY k) - n) // {ROWS_PER_BUCKET} AS BIGINT) AS bucket
  FROM (SELECT k, count(*) AS n FROM lines WHERE record_type IN ('24', '28') GROUP BY k)) GROUP BY bucket"""),
    "q_land_by_manifest": _drop("""
SELECT source_file, line_no, record_type, k AS key FROM lines
WHERE source_file IN (SELECT source_file FROM lines WHERE record_type = '15')"""),
    "q_split_lines": _drop("""
SELECT replace(source_file, '.csv', '_r' || record_type || '.csv') AS split_file,
       row_number() OVER (PARTITION BY source_file, record_type ORDER BY line_no) - 1 AS line_no, record_type, k AS key, s AS serial
FROM lines WHERE k IS NOT NULL"""),
    "q_merged_lines": _drop("""
, names AS (SELECT * FROM (VALUES
    ('15', 'Records_StreetDescriptor.csv', 'RECORD_IDENTIFIER,CHANGE_TYPE,PRO_ORDER,USRN,NAME,BALANCE'),
    ('24', 'Records_LPI.csv', 'RECORD_IDENTIFIER,CHANGE_TYPE,PRO_ORDER,UPRN,STATUS,PRIORITY,TOTAL,ENTRY_DATE')) AS v(t, name, header))
SELECT name AS merged_file, CAST(0 AS BIGINT) AS line_no, CAST(NULL AS BIGINT) AS key, CAST(NULL AS BIGINT) AS serial, header
FROM names WHERE t IN (SELECT record_type FROM lines)
UNION ALL SELECT name, row_number() OVER (PARTITION BY name ORDER BY source_file, line_no), k, s, NULL
FROM lines JOIN names ON t = record_type"""),
    "q_rejects_odd": """
WITH o AS (SELECT o_orderstatus AS s, o_orderpriority AS p, o_custkey AS k FROM orders)
SELECT reason, record_type, count(*) AS n FROM (
  SELECT 'bad_key' AS reason, '24' AS record_type FROM o WHERE s = 'F'
  UNION ALL SELECT 'unknown_type', '77' FROM o WHERE s = 'P'
  UNION ALL SELECT 'corrupt', '24' FROM o WHERE s NOT IN ('F', 'P') AND p = '1-URGENT'
  UNION ALL SELECT 'orphan', '24' FROM o WHERE s NOT IN ('F', 'P') AND k NOT IN (SELECT c_custkey FROM customer))
GROUP BY ALL""",
    "q_file_names": """
SELECT DISTINCT c_custkey % 25 || CASE WHEN c_custkey % 3 = 0 THEN '/x.zip!x.csv' ELSE '/x.csv' END AS source_file,
       'x.csv' AS base, 'x' AS stem
FROM customer""",
    "q_lookup_batch": """
SELECT o_custkey AS key, o_orderkey AS serial FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
    "q_orphans": _drop("""
SELECT k AS key, record_type, source_file, line_no, s AS serial FROM lines
WHERE record_type IN ('24', '28') AND k NOT IN (SELECT n_nationkey FROM nation)"""),
    "q_rejects": _drop("""
SELECT CASE WHEN record_type IN ('10', '29', '99') THEN 'control' WHEN record_type IN ('15', '21') THEN 'not_requested'
            ELSE 'orphan' END AS reason, record_type, count(*) AS n
FROM lines
WHERE record_type <> '11' AND (record_type NOT IN ('24', '28') OR k NOT IN (SELECT n_nationkey FROM nation))
GROUP BY record_type"""),
    "q_open_quotes": """
SELECT 'drop_' || f || '.csv' AS source_file, t AS record_type, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT doc_id % 8 AS f, '31' AS t, count(*) AS n FROM documents GROUP BY ALL
  UNION ALL SELECT f, '31', 1 FROM range(8) AS r(f)
  UNION ALL SELECT user_id % 8, '28', count(*) FROM events GROUP BY ALL) GROUP BY ALL""",
    "q_same_names": """
SELECT c_custkey % 25 || CASE WHEN c_custkey % 3 = 0 THEN '/x.zip!x.csv' ELSE '/x.csv' END AS source_file,
       '21' AS record_type, count(*) AS n
FROM customer GROUP BY ALL""",
    "q_accounted": _drop("""
SELECT CASE WHEN record_type IN ('10', '29', '99') THEN 'control' WHEN record_type IN ('15', '21') THEN 'not_requested'
            WHEN record_type = '11' OR k IN (SELECT n_nationkey FROM nation) THEN 'grouped' ELSE 'orphan' END AS reason,
       count(*) AS n
FROM lines GROUP BY ALL"""),
    "q_group_uprn_segments": _drop(f"""
SELECT k AS key, i // {ROWS_PER_SEGMENT} AS segment, CAST(count(*) FILTER (type_rank = 0) AS INTEGER) AS n_parents,
       CAST(count(*) FILTER (type_rank = 1) AS INTEGER) AS n_24, CAST(count(*) FILTER (type_rank = 2) AS INTEGER) AS n_28
FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY type_rank, source_file, line_no) - 1 AS i FROM {_UPRN})
GROUP BY ALL"""),
}
