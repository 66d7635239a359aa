"""DuckDB SQL of the stand-in tables, put before the SQL of a query."""


def _hashed(key: str) -> str:
    return f"CASE WHEN substr(md5({key}), 1, 1) IN ('0', '1') THEN 'malicious' WHEN substr(md5({key}), 1, 1) IN ('2', '3', '4') THEN 'benign' WHEN substr(md5({key}), 1, 1) = '5' THEN 'unknown' END"


SHELL = f"""
shell0 AS (
  SELECT d.doc_id, d.text AS shell_input, d.source AS dataset, CAST(d.doc_id AS VARCHAR) AS record_id,
    CASE WHEN l.toxic = 1 THEN 'malicious' WHEN l.quality = 1 THEN 'benign' WHEN l.quality IS NOT NULL THEN 'malicious-group' ELSE 'unknown' END AS dataset_label,
    CASE WHEN d.doc_id % 7 <> 0 THEN d.source || '-' || CAST(d.doc_id // 10 AS VARCHAR) ELSE d.source || ':record:' || CAST(d.doc_id AS VARCHAR) END AS session_id,
    CASE WHEN d.lang = 'en' THEN 'linux' ELSE 'windows' END AS os,
    {_hashed("'ai' || CAST(d.doc_id AS VARCHAR)")} AS ai_label,
    CASE WHEN d.doc_id % 11 = 0 THEN {_hashed("'override' || CAST(d.doc_id AS VARCHAR)")} END AS override_label
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
shell AS (
  SELECT *, CASE WHEN dataset_label = 'malicious-group' THEN dataset END AS group_id,
    coalesce(override_label, nullif(ai_label, 'unknown'), nullif(dataset_label, 'malicious-group'), 'unknown') AS label FROM shell0)"""
LAUNCHES = (
    SHELL
    + r""",
lines AS (
  SELECT * EXCLUDE (parts), unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM (SELECT *, string_split(shell_input, chr(10)) AS parts FROM shell)),
launches AS (
  SELECT * EXCLUDE (w, line, shell_input, record_id), record_id || ':' || CAST(pos AS VARCHAR) AS record_id, w[1] AS pgm, w[2:] AS args,
    CASE WHEN os = 'windows' THEN regexp_extract(w[1], '([^/\\]*)$', 1) ELSE regexp_extract(w[1], '([^/]*)$', 1) END AS pgm_base
  FROM (SELECT *, string_split_regex(trim(line), ' +') AS w FROM lines WHERE trim(line) <> ''))"""
)
TELEMETRY = """
telemetry AS (
  SELECT event_id, user_id AS host, epoch_us(ts) AS t, event_type AS kind, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"""
