"""DuckDB statements giving the same rows as the registered queries, from the base tables alone."""

from __future__ import annotations

_CLEAN = """
clean AS (
  SELECT event_id, ts, event_type, event_id AS "offset", event_id % 4 AS "partition", 'shop_' || (event_id % 3) AS topic,
    '{"id":' || event_id || ',"timestamp":' || (epoch_us(ts) // 1000) || ',"eventType":"' || event_type || '","version":"1","user_id":'
      || user_id || ',"value":' || value || ',"props":{"k":' || json_extract_string(props, '$.k') || '}}' AS json
  FROM events)"""

_LANDED = _CLEAN + """,
landed AS (
  SELECT upper(event_type) || '-' || CAST(floor(epoch(ts)) AS BIGINT) || '-' || event_id AS rowkey, json, event_type, ts FROM clean)"""

_DIRTY = """
numbered AS (SELECT *, event_id % 50 AS c FROM events),
texts AS (
  SELECT event_id, ts, c, event_type AS et,
    CASE WHEN c = 9 THEN NULL WHEN c = 11 THEN '#' || md5(event_id::VARCHAR) || '-not-json' WHEN c = 12 THEN ''
      WHEN c = 13 THEN '[' || event_id || ']'
      ELSE '{"id":' || event_id
        || CASE WHEN c = 0 THEN '' WHEN c = 3 THEN ',"timestamp":' || CAST(floor(epoch(ts)) AS BIGINT) ELSE ',"timestamp":' || (epoch_us(ts) // 1000) END
        || CASE WHEN c = 1 THEN '' WHEN c = 10 THEN ',"eventType":null' ELSE ',"eventType":"' || event_type || '"' END
        || CASE WHEN c = 5 THEN '' ELSE ',"version":"1"' END
        || ',"value":' || value || ',"props":' || props || CASE WHEN c = 2 THEN '' ELSE '}' END
    END AS value,
    json_extract_string(props, '$.k')::BIGINT AS k
  FROM numbered),
copies AS (
  SELECT *, 0 AS copy, CASE WHEN c = 6 THEN '_offsets' WHEN c = 7 THEN 'avro_schema' ELSE 'shop_' || (event_id % 3) END AS topic FROM texts
  UNION ALL SELECT *, 1, 'shop_' || (event_id % 3) FROM texts WHERE c = 4
  UNION ALL SELECT *, 1, 'shop_' || ((event_id + 1) % 3) FROM texts WHERE c = 8),
dirty AS (
  SELECT topic, event_id % 4 AS "partition", event_id + copy * 1000000000 AS "offset", value, c, ts, k, event_id,
    CASE WHEN c = 9 THEN 'null message' WHEN c = 11 THEN 'unknown schema' WHEN c IN (2, 12) THEN 'unparsable message' END AS broken_reason,
    CASE WHEN c IN (1, 13) THEN 'no eventType' WHEN c = 0 THEN 'no timestamp' END AS invalid_reason,
    CASE WHEN c IN (0, 1, 2, 9, 11, 12, 13) THEN NULL WHEN c = 10 THEN 'null' ELSE et END AS event_type,
    CASE WHEN c IN (0, 2, 9, 11, 12, 13) THEN NULL WHEN c = 3 THEN 'SECONDS' ELSE 'MILLISECONDS' END AS timestamp_unit,
    CASE WHEN c = 5 THEN NULL ELSE '1' END AS version, et
  FROM copies)"""

_SHIP = """
ship AS (
  SELECT *, CASE WHEN l_returnflag = 'R' THEN 'return' ELSE 'shipment' END AS event_type,
    CASE WHEN l_returnflag = 'R' THEN 'RETURN' ELSE 'SHIPMENT' END || '-' || lpad(CAST(floor(epoch(l_shipdate)) AS BIGINT)::VARCHAR, 10, '0')
      || '-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS rowkey,
    '{"id":"' || l_orderkey || '-' || l_linenumber || '","timestamp":' || (epoch_us(l_shipdate) // 1000) || ',"eventType":"'
      || CASE WHEN l_returnflag = 'R' THEN 'return' ELSE 'shipment' END || '","item":{"part":' || l_partkey
      || ',"supplier":{"id":' || l_suppkey || '}},"price":' || l_extendedprice || ',"charges":['
      || concat_ws(',', CASE WHEN l_discount > 0 THEN '{"kind":"discount","rate":' || l_discount || '}' END,
           CASE WHEN l_tax > 0 THEN '{"kind":"tax","rate":' || l_tax || CASE WHEN l_linestatus = 'F' THEN ',"final":true' ELSE '' END || '}' END)
      || '],"codes":["' || l_returnflag || '",' || l_linenumber || ']'
      || CASE l_returnflag WHEN 'N' THEN ',"note":null' WHEN 'A' THEN ',"note":"ok"' ELSE '' END || '}' AS json
  FROM lineitem)"""

# Documents `docs(doc, event_type, json)` to one row per node or array item, with the type's bit.
_NODES = """
tree AS (
  SELECT d.doc, d.event_type, t.fullkey, t.fullkey LIKE '%]' AS item, t.type,
    ltrim(replace(regexp_replace(t.fullkey, '\\[\\d+\\]', '', 'g'), '$', ''), '.') AS path
  FROM docs d, json_tree(d.json) t),
nodes AS (
  SELECT doc, event_type, path, item,
    CASE WHEN type IN ('BIGINT', 'UBIGINT', 'HUGEINT') THEN 'INTEGER' WHEN type = 'DOUBLE' THEN 'FLOAT' WHEN type = 'VARCHAR' THEN 'TEXTUAL' ELSE type END AS jtype
  FROM tree),
paths AS (
  SELECT event_type, path,
    coalesce(string_agg(DISTINCT jtype, '|' ORDER BY jtype) FILTER (NOT item), '') AS json_types,
    coalesce(string_agg(DISTINCT jtype, '|' ORDER BY jtype) FILTER (item), '') AS item_types,
    count(DISTINCT doc) FILTER (NOT item) AS n_trees, bool_or(jtype = 'NULL' AND NOT item) AS saw_null
  FROM nodes GROUP BY ALL),
merged AS (
  SELECT p.*, CASE WHEN p.path = '' THEN NULL WHEN p.path LIKE '%.%' THEN regexp_replace(p.path, '\\.[^.]*$', '') ELSE '' END AS parent_path,
    regexp_extract(p.path, '[^.]*$') AS name,
    CASE WHEN p.path = '' THEN 0 ELSE length(p.path) - length(replace(p.path, '.', '')) + 1 END AS depth
  FROM paths p),
structure AS (
  SELECT m.*, m.saw_null OR coalesce(m.n_trees < q.n_trees, false) AS optional,
    m.path <> '' AND NOT EXISTS (SELECT 1 FROM merged k WHERE k.event_type = m.event_type AND k.parent_path = m.path) AS is_leaf,
    m.json_types LIKE '%ARRAY%' AS is_array
  FROM merged m LEFT JOIN merged q ON q.event_type = m.event_type AND q.path = m.parent_path),
typed AS (
  SELECT *, CASE WHEN json_types LIKE '%TEXTUAL%' THEN 'TEXT' WHEN json_types LIKE '%FLOAT%' THEN 'DOUBLE'
      WHEN json_types LIKE '%INTEGER%' THEN 'BIGINT' WHEN json_types LIKE '%BOOLEAN%' THEN 'BOOLEAN' END AS primitive,
    CASE WHEN NOT is_array THEN NULL WHEN item_types LIKE '%TEXTUAL%' THEN 'TEXT' WHEN item_types LIKE '%FLOAT%' THEN 'DOUBLE'
      WHEN item_types LIKE '%INTEGER%' THEN 'BIGINT' WHEN item_types LIKE '%BOOLEAN%' THEN 'BOOLEAN' END AS item_primitive
  FROM structure)"""

_SHIP_DOCS = _SHIP + ", docs AS (SELECT row_number() OVER () AS doc, event_type, json FROM ship)," + _NODES
_DIRTY_DOCS = _DIRTY + """, docs AS (SELECT row_number() OVER () AS doc, event_type, value AS json FROM dirty WHERE event_type IS NOT NULL),""" + _NODES

_SCHEMA_TEXT = """'{"type":"record","name":"Account' || c_custkey || '","namespace":"shop","fields":[{"name":"id","type":"long"},'
  || '{"name":"balance","type":["null","double"]},'
  || '{"name":"segment","type":{"type":"enum","name":"Segment","symbols":["' || c_mktsegment || '"]}},'
  || '{"name":"home","type":{"type":"record","name":"Address","fields":[{"name":"nation","type":"int"}'
  || CASE WHEN c_acctbal < 0 THEN ',{"name":"owing","type":"float"}' ELSE '' END || ']}},'
  || '{"name":"ship_to","type":["null","Address"]},'
  || '{"name":"orders","type":{"type":"array","items":{"type":"record","name":"Ref","fields":[{"name":"key","type":"string"}]}}},'
  || '{"name":"tags","type":{"type":"array","items":"string"}},'
  || '{"name":"attrs","type":{"type":"map","values":["null","long"]}}]}'"""

# The paths each registered schema has, by construction.
_AVRO = f"""
schemas AS (SELECT md5({_SCHEMA_TEXT}) AS schema_hash, c_mktsegment AS symbol, c_acctbal < 0 AS owing FROM customer),
shape(path, optional, avro_types, avro_union_types, avro_item_types, avro_item_names, avro_map_value_types) AS (VALUES
  ('', false, '', '', '', '', ''), ('id', false, 'LONG', '', '', '', ''), ('balance', true, 'UNION', 'DOUBLE|NULL', '', '', ''),
  ('segment', false, 'ENUM', '', '', '', ''), ('home', false, 'RECORD', '', '', '', ''), ('home.nation', false, 'INT', '', '', '', ''),
  ('home.owing', false, 'FLOAT', '', '', '', ''), ('ship_to', true, 'UNION', 'NULL|RECORD', '', '', ''),
  ('ship_to.nation', false, 'INT', '', '', '', ''), ('ship_to.owing', false, 'FLOAT', '', '', '', ''),
  ('orders', false, 'ARRAY', '', 'RECORD', 'Ref', ''), ('orders.key', false, 'STRING', '', '', '', ''),
  ('tags', false, 'ARRAY', '', 'STRING', 'string', ''), ('attrs', false, 'MAP', '', '', '', 'LONG|NULL|UNION')),
avro AS (
  SELECT schema_hash, path, optional, avro_types, avro_union_types, CASE WHEN path = 'segment' THEN symbol ELSE '' END AS avro_enum_symbols,
    avro_item_types, avro_item_names, avro_map_value_types
  FROM schemas, shape WHERE owing OR path NOT LIKE '%.owing')"""

# Customers as messages: which are Avro, under which hash, and whether their body can be read.
_ACCOUNTS = f"""
accounts AS (
  SELECT *, event_ok AND (NOT avro OR registered) AS decoded FROM (
    SELECT 'accounts_' || (c_custkey % 2) AS topic, c_custkey AS "offset", 'account_' || (c_nationkey % 3) AS event_type,
      c_nationkey % 3 = 1 OR (c_nationkey % 3 = 2 AND c_custkey % 2 = 0) AS avro, NOT (c_nationkey % 3 = 1 AND c_custkey % 10 = 0) AS registered,
      NOT (c_nationkey % 3 = 1 AND c_custkey % 20 = 1) AS event_ok,
      CASE WHEN c_nationkey % 3 = 1 AND c_custkey % 10 = 0 THEN md5(c_name) ELSE md5({_SCHEMA_TEXT}) END AS schema_hash
    FROM customer))"""

_TOPICS = """
per_message AS (SELECT topic, value, broken_reason, invalid_reason, event_type, "partition" FROM dirty),
readable AS (SELECT DISTINCT topic, value, invalid_reason, event_type FROM per_message WHERE broken_reason IS NULL),
topic_facts AS (
  SELECT t.topic, coalesce(r.n_events, 0) AS n_events, coalesce(r.n_invalid, 0) AS n_invalid, coalesce(r.n_without_type, 0) AS n_without_type,
    coalesce(r.n_without_timestamp, 0) AS n_without_timestamp, t.n_broken, t.n_null, coalesce(r.event_types, '') AS event_types, t.n_partitions,
    coalesce(r.n_types = 1 AND r.n_invalid = 0, false) AND t.n_broken = 0 AS is_consistent
  FROM (SELECT topic, count(broken_reason) AS n_broken, count(*) FILTER (broken_reason = 'null message') AS n_null,
          count(DISTINCT "partition") AS n_partitions FROM per_message GROUP BY topic) t
  LEFT JOIN (SELECT topic, count(*) AS n_events, count(invalid_reason) AS n_invalid, count(*) FILTER (invalid_reason = 'no eventType') AS n_without_type,
          count(*) FILTER (invalid_reason = 'no timestamp') AS n_without_timestamp, count(DISTINCT event_type) AS n_types,
          string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS event_types FROM readable GROUP BY topic) r USING (topic))"""

_TYPES = """
type_facts AS (
  SELECT event_type, count(DISTINCT value) AS n_events, string_agg(DISTINCT topic, '|' ORDER BY topic) AS topics,
    string_agg(DISTINCT coalesce(version, 'ABSENT'), '|' ORDER BY coalesce(version, 'ABSENT')) AS versions,
    string_agg(DISTINCT timestamp_unit, '|' ORDER BY timestamp_unit) AS timestamp_units
  FROM dirty WHERE event_type IS NOT NULL GROUP BY event_type),
type_report AS (SELECT *, versions NOT LIKE '%|%' AND timestamp_units = 'MILLISECONDS' AS is_consistent FROM type_facts)"""

# Columns of the views of this run (dirty messages) and of the run before (clean ones).
_DRIFT = _DIRTY + """,
docs_now AS (SELECT event_type, value AS json FROM dirty WHERE event_type IS NOT NULL),""" + _CLEAN + """,
leaf_types AS (
  SELECT src, event_type, path, CASE WHEN bool_or(t = 'VARCHAR') THEN 'string' WHEN bool_or(t = 'DOUBLE') THEN 'double'
      WHEN bool_or(t LIKE '%BIGINT') THEN 'bigint' ELSE 'string' END AS column_type
  FROM (SELECT 'now' AS src, d.event_type, substr(t.fullkey, 3) AS path, t.type AS t FROM docs_now d, json_tree(d.json) t WHERE t.type <> 'OBJECT'
        UNION ALL SELECT 'before', d.event_type, substr(t.fullkey, 3), t.type FROM clean d, json_tree(d.json) t WHERE t.type <> 'OBJECT')
  GROUP BY ALL),
both_runs AS (
  SELECT event_type, path, max(column_type) FILTER (src = 'now') AS now, max(column_type) FILTER (src = 'before') AS before FROM leaf_types GROUP BY ALL),
drift_rows AS (
  SELECT event_type, coalesce(string_agg(path, '|' ORDER BY path) FILTER (before IS NULL), '') AS added,
    coalesce(string_agg(path, '|' ORDER BY path) FILTER (now IS NULL), '') AS removed,
    coalesce(string_agg(path, '|' ORDER BY path) FILTER (now <> before), '') AS retyped, count(now) AS n_now, count(before) AS n_before
  FROM both_runs GROUP BY event_type),
drift AS (
  SELECT event_type, CASE WHEN n_before = 0 THEN 'new' WHEN added || removed || retyped <> '' THEN 'changed' ELSE 'unchanged' END AS status,
    added, removed, retyped FROM drift_rows WHERE n_now > 0)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_VIEW_SCOPES = """
SELECT event_type AS view_name, count(*) AS n_rows FROM landed GROUP BY ALL
UNION ALL SELECT event_type || '_last_week', count(*) FILTER (floor(epoch(ts)) >= epoch(TIMESTAMP '2024-01-31') - 604800) FROM landed GROUP BY event_type
UNION ALL SELECT event_type || '_last_day', count(*) FILTER (floor(epoch(ts)) >= epoch(TIMESTAMP '2024-01-31') - 86400) FROM landed GROUP BY event_type"""

_SECOND = "strftime({}, '%Y-%m-%d %H:%M:%S')"
_MILLI = "rtrim(rtrim(strftime({}, '%Y-%m-%d %H:%M:%S.%g'), '0'), '.')"

ORACLE: dict[str, str] = {
    "s1_select_topics": _with(_DIRTY) + "SELECT DISTINCT topic FROM dirty WHERE topic NOT LIKE '\\_%' ESCAPE '\\' AND topic <> 'avro_schema'",
    "s2a_sample_topics": _with(_DIRTY) + """SELECT topic, "partition", "offset", md5(value) AS digest FROM dirty
        QUALIFY row_number() OVER (PARTITION BY topic ORDER BY "partition", "offset") <= 100""",
    "s2b_sample_topics_per_partition": _with(_DIRTY) + """,
      ranked AS (SELECT *, row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS r FROM dirty),
      parts AS (SELECT topic, "partition", count(*) AS taken FROM ranked WHERE r <= 100 GROUP BY ALL),
      opened AS (SELECT topic, "partition", coalesce(sum(taken) OVER (PARTITION BY topic ORDER BY "partition"
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier FROM parts)
      SELECT topic, "partition", "offset", md5(value) AS digest FROM ranked JOIN opened USING (topic, "partition") WHERE r <= 100 AND earlier < 100""".replace(",\n      ranked", ", ranked", 1),
    "s3_topic_partition_count": _with(_DIRTY) + 'SELECT topic, count(DISTINCT "partition") AS n_partitions FROM dirty GROUP BY topic',
    "s5_read_landed_events": _with(_LANDED) + "SELECT rowkey, md5(json) AS digest FROM landed",
    "s6_schema_registry_lookup": f"""SELECT c_custkey AS "offset", CASE WHEN c_acctbal < -500 THEN md5(c_name) ELSE md5({_SCHEMA_TEXT}) END AS schema_hash,
        CASE WHEN c_acctbal < -500 THEN 'unknown schema' END AS broken_reason,
        CASE WHEN c_acctbal >= -500 THEN sha256({_SCHEMA_TEXT}) END AS schema_digest FROM customer""",
    "s6_hot_schema_lookup": f"""SELECT c_custkey AS "offset",
        CASE c_custkey % 3 WHEN 0 THEN md5('hot') WHEN 1 THEN md5({_SCHEMA_TEXT}) ELSE md5('x' || c_custkey) END AS schema_hash,
        CASE c_custkey % 3 WHEN 0 THEN sha256('{{"type":"hot"}}') WHEN 1 THEN sha256({_SCHEMA_TEXT}) END AS schema_digest FROM customer""",
    "s6_registry_from_base64": f"""SELECT md5({_SCHEMA_TEXT}) AS schema_hash, sha256({_SCHEMA_TEXT}) AS schema_digest FROM customer""",
    "s7_write_samples": _with(_DIRTY) + """SELECT event_type, event_id AS id FROM (
        SELECT event_type, event_id, topic, "partition", "offset" FROM dirty WHERE event_type IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY event_type, value ORDER BY topic, "partition", "offset") = 1)
        QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY topic, "partition", "offset") <= 10""",
    "s8_structure_registry": _with(_SHIP_DOCS) + "SELECT event_type, path, optional, n_trees, is_leaf FROM structure",
    "s9_create_views": _with(_LANDED) + "SELECT *, 'unchanged' AS status FROM (" + _VIEW_SCOPES + ")",
    "s11_write_reports": _with(_DIRTY, _TOPICS) + "SELECT topic, n_events, n_invalid, n_broken, is_consistent FROM topic_facts",
    "f1_is_avro_message": _with(_DIRTY) + """SELECT topic, "offset", length(value) >= 32 AND value NOT LIKE '{%' AS is_avro FROM dirty""",
    "f2_schema_hash_of": _with(_DIRTY) + """SELECT topic, "offset", substr(value, 1, 32) AS schema_hash FROM dirty""",
    "f4_decode_messages": _with(_DIRTY) + """SELECT topic, "offset", c NOT IN (2, 9, 11, 12) AS decoded,
        CASE WHEN c NOT IN (2, 9, 11, 12, 13) THEN k END AS k FROM dirty""",
    "f5_split_broken": _with(_DIRTY) + 'SELECT topic, "offset", broken_reason FROM dirty WHERE broken_reason IS NOT NULL',
    "f6_split_invalid": _with(_DIRTY) + 'SELECT topic, "offset", invalid_reason FROM dirty WHERE invalid_reason IS NOT NULL',
    "f7_rowkey_range_all": _with(_LANDED) + "SELECT rowkey, md5(json) AS digest FROM landed WHERE event_type = 'click'",
    "f8_rowkey_range_week": _with(_LANDED) + """SELECT rowkey, md5(json) AS digest FROM landed
        WHERE event_type = 'purchase' AND floor(epoch(ts)) >= epoch(TIMESTAMP '2024-01-31') - 604800""",
    "p1_extract_envelope": _with(_DIRTY) + """SELECT topic, "offset", CASE WHEN c NOT IN (2, 9, 11, 12, 13) THEN event_id::VARCHAR END AS id,
        CASE WHEN c IN (0, 2, 9, 11, 12, 13) THEN NULL WHEN c = 3 THEN CAST(floor(epoch(ts)) AS BIGINT)::VARCHAR ELSE (epoch_us(ts) // 1000)::VARCHAR END AS timestamp_text,
        CASE WHEN c IN (1, 2, 9, 11, 12, 13) THEN NULL WHEN c = 10 THEN 'null' ELSE et END AS event_type,
        CASE WHEN c NOT IN (2, 5, 9, 11, 12, 13) THEN '1' END AS version FROM dirty""",
    "p2_timestamp_unit": _with(_DIRTY) + 'SELECT topic, "offset", timestamp_unit FROM dirty',
    "p3_rowkey_timestamp": _with(_LANDED) + f"SELECT rowkey, {_SECOND.format('ts')} AS row_time FROM landed",
    "p4_json_paths": _with(_SHIP_DOCS) + "SELECT event_type, path, json_types, item_types, n_trees FROM paths",
    "p4_json_paths_of_dirty_messages": _with(_DIRTY_DOCS) + "SELECT event_type, path, json_types, item_types, n_trees FROM paths",
    "p5_avro_paths": _with(_AVRO) + "SELECT * FROM avro",
    "p6_flatten_untyped": _with(_SHIP) + f"""SELECT rowkey AS row_key, {_SECOND.format('l_shipdate')} AS row_timestamp, l_orderkey || '-' || l_linenumber AS id,
        l_partkey AS item_part, l_suppkey AS item_supplier_id, l_extendedprice AS price, '["' || l_returnflag || '",' || l_linenumber || ']' AS codes,
        CASE WHEN l_returnflag = 'A' THEN 'ok' END AS note FROM ship WHERE event_type = 'shipment'""",
    "p7_flatten_typed": _with(_SHIP) + f"""SELECT rowkey, event_type AS "eventType", l_orderkey || '-' || l_linenumber AS id, l_partkey AS item_part,
        l_suppkey AS item_supplier_id, CASE WHEN l_returnflag = 'A' THEN 'ok' END AS note, l_extendedprice AS price,
        {_SECOND.format('l_shipdate')} AS event_time, l_returnflag || '|' || l_linenumber AS codes, (l_discount > 0)::INT + (l_tax > 0)::INT AS n_charges,
        concat_ws('|', CASE WHEN l_discount > 0 THEN 'discount' END, CASE WHEN l_tax > 0 THEN 'tax' END) AS kinds, l_discount + l_tax AS rate_sum
        FROM ship WHERE event_type = 'shipment'""",
    "p8_cast_event_timestamp": _with(_DIRTY) + f"""SELECT topic, "offset",
        CASE WHEN c = 3 THEN {_SECOND.format('ts')} ELSE {_MILLI.format("ts")} END AS event_time FROM dirty WHERE event_type IS NOT NULL""",
    "p11_explode_arrays": _with(_SHIP) + """SELECT rowkey, charges_array_index, charges_final, charges_kind, charges_rate FROM (
        SELECT rowkey, 0 AS charges_array_index, NULL AS charges_final, 'discount' AS charges_kind, l_discount::VARCHAR AS charges_rate FROM ship
          WHERE event_type = 'shipment' AND l_discount > 0
        UNION ALL SELECT rowkey, (l_discount > 0)::INT, CASE WHEN l_linestatus = 'F' THEN 'true' END, 'tax', l_tax::VARCHAR FROM ship
          WHERE event_type = 'shipment' AND l_tax > 0
        UNION ALL SELECT rowkey, NULL, NULL, NULL, NULL FROM ship WHERE event_type = 'shipment' AND l_discount <= 0 AND l_tax <= 0)""",
    "p11_explode_scalar_arrays": _with(_SHIP) + """SELECT rowkey, 0 AS codes_array_index, l_returnflag AS codes_item FROM ship WHERE event_type = 'return'
        UNION ALL SELECT rowkey, 1, l_linenumber::VARCHAR FROM ship WHERE event_type = 'return'""",
    "p12_json_tuple_view": _with(_SHIP) + """SELECT rowkey, event_type AS "eventType", l_orderkey || '-' || l_linenumber AS id, l_extendedprice::VARCHAR AS price,
        (epoch_us(l_shipdate) // 1000)::VARCHAR AS timestamp, l_partkey::VARCHAR AS item_part, l_suppkey::VARCHAR AS item_supplier_id
        FROM ship WHERE event_type = 'return'""",
    "p13_warehouse_columns": _with(_SHIP_DOCS) + """SELECT event_type, replace(path, '.', '_') AS column_name, CASE primitive WHEN 'BIGINT' THEN 'BIGINT'
        WHEN 'DOUBLE' THEN 'NUMERIC(18, 5)' WHEN 'BOOLEAN' THEN 'BIT' ELSE 'NVARCHAR(255)' END AS column_type FROM typed WHERE is_leaf""",
    "p14_load_mapping": _with(_SHIP_DOCS) + """SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY replace(path, '.', '_')) AS kv_index,
        replace(path, '.', '_') AS target_column, '$.' || path AS source_path, CASE primitive WHEN 'BIGINT' THEN 'Integer' WHEN 'DOUBLE' THEN 'Number'
        WHEN 'BOOLEAN' THEN 'Boolean' ELSE 'String' END AS data_type FROM typed WHERE is_leaf
        UNION ALL SELECT DISTINCT event_type, 0, 'meta_CreateProcessID', '_RUN_ID', 'Integer' FROM typed""",
    "p15_append_increment": _with(_SHIP) + """, top AS (SELECT max(rowkey) AS mark FROM ship WHERE event_type = 'return')
      SELECT rowkey, CASE WHEN rowkey < 'RETURN-0800000000' THEN 1 ELSE 2 END AS run, l_orderkey || '-' || l_linenumber AS id, mark
      FROM ship, top WHERE event_type = 'return'""",
    "p15_load_warehouse_increment": _with(_SHIP) + """SELECT rowkey, 7 AS "meta_CreateProcessID", '["' || l_returnflag || '",' || l_linenumber || ']' AS codes,
        event_type AS "eventType", l_orderkey || '-' || l_linenumber AS id, l_partkey AS item_part, l_suppkey AS item_supplier_id,
        CASE WHEN l_returnflag = 'A' THEN 'ok' END AS note, CAST(l_extendedprice AS DECIMAL(18, 5))::VARCHAR AS price, (epoch_us(l_shipdate) // 1000) AS timestamp
        FROM ship WHERE event_type = 'shipment' AND rowkey > 'SHIPMENT-0900000000'""",
    "p15_load_ledger": _with(_SHIP) + """,
      rows AS (SELECT rowkey, l_orderkey || '-' || l_linenumber AS id, CAST(l_extendedprice AS DECIMAL(18, 5))::VARCHAR AS price,
          rowkey < 'RETURN-0800000000' AND right(rowkey, 1) <> '3' AS early FROM ship WHERE event_type = 'return'),
      runs AS (SELECT *, CASE WHEN early THEN 1 WHEN rowkey <= (SELECT max(rowkey) FROM rows WHERE early) THEN 3 ELSE 2 END AS run FROM rows)
      SELECT rowkey, run, id, price, count(*) OVER (PARTITION BY run) AS n_rows FROM runs""".replace(",\n      rows", ", rows", 1),
    "p15_next_mark": _with(_SHIP) + "SELECT upper(event_type) AS event_type, max(rowkey) AS mark FROM ship GROUP BY ALL",
    "a1_distinct_events": _with(_DIRTY) + """SELECT topic, "partition", "offset", count(*) OVER (PARTITION BY topic, coalesce(value, "partition" || '/' || "offset" || 'null')) AS n_copies FROM dirty
        QUALIFY row_number() OVER (PARTITION BY topic, coalesce(value, "partition" || '/' || "offset" || 'null') ORDER BY "partition", "offset") = 1""",
    "a1_distinct_events_of_type": _with(_DIRTY) + """SELECT event_type, topic, "offset" FROM dirty WHERE event_type IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY event_type, value ORDER BY topic, "partition", "offset") = 1""",
    "a2_events_by_type": _with(_DIRTY, _TYPES) + "SELECT event_type, n_events, topics FROM type_report",
    "a3_schema_versions": _with(_DIRTY, _TYPES) + "SELECT event_type, versions FROM type_report",
    "a4_avro_mix": _with(_DIRTY, _TYPES) + "SELECT event_type, 1 AS n_flags, 0 AS n_schemas FROM type_report",
    "a5_timestamp_units": _with(_DIRTY, _TYPES) + "SELECT event_type, timestamp_units FROM type_report",
    "a6_distinct_structures": _with(_SHIP_DOCS) + """,
      bits AS (SELECT DISTINCT event_type, doc, path, CASE jtype WHEN 'ARRAY' THEN 1 WHEN 'BINARY' THEN 2 WHEN 'BOOLEAN' THEN 4 WHEN 'FLOAT' THEN 8
                 WHEN 'INTEGER' THEN 16 WHEN 'NULL' THEN 32 WHEN 'OBJECT' THEN 64 WHEN 'TEXTUAL' THEN 128 END * CASE WHEN item THEN 512 ELSE 1 END AS bit FROM nodes),
      trees AS (SELECT event_type, doc, string_agg(path || ':' || bit, '|' ORDER BY path, bit) AS nodes FROM bits GROUP BY ALL)
      SELECT event_type, nodes, count(*) AS n_events FROM trees GROUP BY ALL""".replace(",\n      bits", ", bits", 1),
    "a7_merge_structures": _with(_SHIP_DOCS) + "SELECT event_type, path, parent_path, name, depth, optional, n_trees FROM structure",
    "a7_merge_with_avro": _with(_AVRO) + """, counted AS (SELECT path, count(*) AS n_trees, bool_or(optional) AS flag, max(avro_types) AS kind,
          max(avro_union_types) AS branches, max(avro_item_types) AS items,
          coalesce(string_agg(DISTINCT avro_enum_symbols, '|' ORDER BY avro_enum_symbols) FILTER (avro_enum_symbols <> ''), '') AS avro_enum_symbols
        FROM avro GROUP BY path)
      SELECT 'account' AS event_type, c.path, c.flag OR coalesce(c.n_trees < p.n_trees, false) AS optional, c.n_trees, c.kind = 'ARRAY' AS is_array,
        CASE WHEN c.kind IN ('ENUM', 'STRING') THEN 'TEXT' WHEN c.kind = 'LONG' THEN 'BIGINT' WHEN c.kind IN ('INT', 'FLOAT') THEN c.kind
          WHEN c.branches LIKE 'DOUBLE%' THEN 'DOUBLE' END AS primitive,
        CASE WHEN c.items = 'STRING' THEN 'TEXT' END AS item_primitive, c.avro_enum_symbols
      FROM counted c LEFT JOIN counted p ON p.path = CASE WHEN c.path = '' THEN NULL WHEN c.path LIKE '%.%' THEN split_part(c.path, '.', 1) ELSE '' END""",
    "a4_avro_mix_of_accounts": _with(_ACCOUNTS) + """SELECT event_type, count(*) AS n_events, string_agg(DISTINCT avro::VARCHAR, '|' ORDER BY avro::VARCHAR) AS avro_flags,
        count(DISTINCT schema_hash) FILTER (avro) AS n_schemas,
        count(DISTINCT avro) = 1 AND count(DISTINCT schema_hash) FILTER (avro) <= 1 AS is_consistent FROM accounts WHERE decoded GROUP BY event_type""",
    "a9_topic_report_of_accounts": _with(_ACCOUNTS) + """SELECT topic, count(*) FILTER (decoded) AS n_events, 0::BIGINT AS n_invalid, 0::BIGINT AS n_undecoded,
        count(*) FILTER (NOT decoded) AS n_broken, string_agg(DISTINCT event_type, '|' ORDER BY event_type) FILTER (decoded) AS event_types,
        count(DISTINCT event_type) FILTER (decoded) = 1 AND count(*) FILTER (NOT decoded) = 0 AS is_consistent FROM accounts GROUP BY topic""",
    "a9_topic_report_of_undecoded_accounts": _with(_ACCOUNTS) + """SELECT topic, count(*) FILTER (NOT avro OR registered) AS n_events, 0::BIGINT AS n_invalid,
        count(*) FILTER (avro AND registered) AS n_undecoded, count(*) FILTER (NOT registered) AS n_broken FROM accounts GROUP BY topic""",
    "f6_undecoded": _with(_ACCOUNTS) + """SELECT topic, "offset", CASE WHEN NOT registered THEN 'unknown schema' END AS broken_reason, NULL::VARCHAR AS invalid_reason,
        avro AND registered AS undecoded, CASE WHEN NOT avro THEN event_type END AS event_type FROM accounts""",
    "a7_learned_from_accounts": _with(_ACCOUNTS, _AVRO) + """,
      event_paths(path, json_types) AS (VALUES ('', 'OBJECT'), ('id', 'INTEGER'), ('timestamp', 'INTEGER'), ('eventType', 'TEXTUAL'), ('version', 'TEXTUAL'), ('balance', 'FLOAT')),
      of_events AS (SELECT event_type, path, json_types, count(*) AS n FROM accounts, event_paths WHERE decoded GROUP BY ALL),
      in_use AS (SELECT DISTINCT event_type, schema_hash FROM accounts WHERE decoded AND avro),
      of_schemas AS (SELECT event_type, path, max(avro_types) AS avro_types, count(*) AS n FROM in_use JOIN avro USING (schema_hash) GROUP BY ALL)
      SELECT event_type, path, coalesce(e.n, 0) + coalesce(s.n, 0) AS n_trees, coalesce(s.avro_types, '') AS avro_types, coalesce(e.json_types, '') AS json_types
      FROM of_events e FULL JOIN of_schemas s USING (event_type, path)""".replace(",\n      event_paths", ", event_paths", 1),
    "a7_open_keys": r"""WITH docs AS (
        SELECT event_id AS doc, event_type, event_id % 3 <> 0 AS nested, value FROM events),
      shape(path, json_types, is_map, is_leaf, deep, parent_deep) AS (VALUES ('', 'OBJECT', false, false, false, false), ('id', 'INTEGER', false, true, false, false),
        ('timestamp', 'INTEGER', false, true, false, false), ('eventType', 'TEXTUAL', false, true, false, false), ('props', 'OBJECT', false, false, false, false),
        ('props.k', 'INTEGER', false, true, false, false), ('seen', 'OBJECT', true, true, false, false), ('seen.total', 'INTEGER', false, true, false, false),
        ('seen.\*', 'OBJECT', false, false, false, false), ('seen.\*.n', 'FLOAT', false, false, false, false), ('seen.\*.by\.day', 'OBJECT', true, false, true, false),
        ('seen.\*.by\.day.\*', 'INTEGER|TEXTUAL', false, false, true, true))
      SELECT event_type, path, json_types, count(*) FILTER (nested OR NOT deep) AS n_trees, deep AND NOT parent_deep AS optional, is_map, is_leaf
      FROM docs, shape GROUP BY ALL""".replace("\\\\", "\\"),
    "a8_resolve_primitive": _with(_SHIP_DOCS) + "SELECT event_type, path, primitive, item_primitive FROM typed WHERE is_leaf",
    "a9_topic_report": _with(_DIRTY, _TOPICS) + "SELECT * FROM topic_facts",
    "a10_event_type_report": _with(_DIRTY, _TYPES) + """SELECT *, concat_ws('|', CASE WHEN n_events < 2 THEN 'a single event says nothing about consistency' END,
        CASE WHEN versions LIKE '%|%' THEN 'several schema versions in use' END, CASE WHEN timestamp_units LIKE '%|%' THEN 'timestamps in different units' END,
        CASE WHEN timestamp_units LIKE '%|SECONDS' OR timestamp_units = 'SECONDS' THEN 'timestamps count seconds' END) AS messages FROM type_report""",
    "a11_day_count": """SELECT event_type, count(*) FILTER (floor(epoch(ts)) >= epoch(TIMESTAMP '2024-01-31') - 86400) AS day_count FROM events GROUP BY event_type""",
    "a11_range_counts": """WITH keys AS (
        SELECT 'part' || l_partkey AS event_type, 'PART' || l_partkey || '-' || CAST(floor(epoch(l_shipdate)) AS BIGINT) || '-' || l_orderkey || '-' || l_linenumber AS rowkey
        FROM lineitem WHERE floor(epoch(l_shipdate)) >= 100000000),
      types AS (SELECT 'part' || p_partkey AS event_type FROM part),
      scopes(scope, start) AS (VALUES ('all', '0'), ('week', (epoch(TIMESTAMP '1996-06-01') - 604800)::BIGINT::VARCHAR))
      SELECT t.event_type, s.scope, count(k.rowkey) AS n_rows FROM types t CROSS JOIN scopes s
      LEFT JOIN keys k ON k.event_type = t.event_type AND k.rowkey >= upper(t.event_type) || '-' || s.start AND k.rowkey < upper(t.event_type) || '-9' GROUP BY ALL""",
    "a12_pivot_parameters": """SELECT c_name AS param_filter, lower(c_mktsegment) AS targetname, 'nation_' || c_nationkey AS sourcename,
        CAST(NULL AS VARCHAR) AS deltatype, upper(c_mktsegment) || '-0' AS strvalue FROM customer""",
    "a13_too_few_events": _with(_DIRTY, _TOPICS, _TYPES) + """SELECT 'event type ' || event_type AS subject, 'not enough events: ' || n_events AS message
        FROM type_report WHERE n_events < 2
        UNION ALL SELECT 'topic shop_' || c_custkey, 'no events received' FROM customer
        WHERE 'shop_' || c_custkey NOT IN (SELECT topic FROM topic_facts WHERE n_events > 0)""",
    "w2_example_event": _with(_DIRTY) + """SELECT event_type, topic, "partition", "offset" FROM dirty WHERE event_type IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY topic, "partition", "offset") = 1""",
    "u1_union_of_sources": _with(_CLEAN, _SHIP) + """, docs AS (SELECT row_number() OVER () AS doc, event_type, json FROM (
          SELECT event_type, json FROM clean UNION ALL SELECT event_type, json FROM ship)),""" + _NODES + """
      SELECT event_type, count(*) AS n_paths, max(n_trees) AS n_trees FROM paths GROUP BY event_type""",
    "d1_view_drift": _with(_DRIFT) + "SELECT * FROM drift",
    "d2_schema_conflicts": "SELECT md5(c_mktsegment) AS schema_hash, count(*) AS n_schemas FROM customer GROUP BY c_mktsegment HAVING count(*) > 1",
    "d3_change_log": _with(_DRIFT, _TOPICS, _TYPES) + """SELECT 'change' AS kind, 'event type ' || event_type AS subject,
        CASE WHEN status = 'new' THEN 'view is new' ELSE 'view changed' END AS message FROM drift WHERE status <> 'unchanged'
      UNION ALL SELECT 'warning', 'topic ' || topic, 'report shows inconsistencies' FROM topic_facts WHERE NOT is_consistent AND n_events > 0
      UNION ALL SELECT 'warning', 'event type ' || event_type, 'report shows inconsistencies' FROM type_report WHERE NOT is_consistent
      UNION ALL SELECT 'warning', 'event type ' || event_type, 'not enough events: ' || n_events FROM type_report WHERE n_events < 2
      UNION ALL SELECT 'warning', 'topic silent', 'no events received'
      UNION ALL SELECT 'change', 'schema ' || md5(c_mktsegment), 'more than one schema for this hash' FROM customer GROUP BY c_mktsegment HAVING count(*) > 1""",
    "d4_structure_lineage": _with(_SHIP_DOCS) + """,
      kinds AS (SELECT DISTINCT event_type, doc, path, item, jtype FROM nodes),
      trees AS (SELECT event_type, doc, string_agg(path || item || jtype, '|' ORDER BY path, item, jtype) AS nodes FROM kinds GROUP BY ALL)
      SELECT event_type, count(DISTINCT nodes) AS n_sources FROM trees GROUP BY ALL""".replace(",\n      kinds", ", kinds", 1),
    "r1_stream_structures": _with(_SHIP_DOCS) + "SELECT event_type, path, optional, n_trees FROM structure",
    "r1_stream_shapes": _with(_SHIP_DOCS) + "SELECT event_type, path, optional, n_trees FROM structure",
    "s11_schema_report": _with(_ACCOUNTS, _AVRO) + """,
      carried AS (SELECT schema_hash, event_type, count(*) AS n FROM accounts WHERE avro AND registered AND event_ok GROUP BY ALL),
      named AS (SELECT md5(""" + _SCHEMA_TEXT + """) AS schema_hash, 'Account' || c_custkey AS name FROM customer),
      sizes AS (SELECT schema_hash, count(*) AS n_nodes FROM avro GROUP BY schema_hash)
      SELECT schema_hash, name, 'shop.' || name AS full_name, '1' AS versions, string_agg(event_type, '|' ORDER BY event_type) AS event_types, sum(n)::BIGINT AS n_messages, n_nodes
      FROM carried JOIN named USING (schema_hash) JOIN sizes USING (schema_hash) GROUP BY ALL""".replace(",\n      carried", ", carried", 1),
    "s11_structure_report": _with(_SHIP_DOCS) + """,
      kinds AS (SELECT DISTINCT event_type, doc, path, item, jtype FROM nodes),
      trees AS (SELECT event_type, doc, string_agg(path || item || jtype, '|' ORDER BY path, item, jtype) AS tree, count(DISTINCT path) AS n_nodes FROM kinds GROUP BY ALL)
      SELECT event_type, 'EVENT' AS source, count(*) AS n_events, any_value(n_nodes) AS n_nodes FROM trees GROUP BY event_type, tree
      UNION ALL SELECT event_type, 'MERGE', max(n_trees), count(*) FROM structure GROUP BY event_type""".replace(",\n      kinds", ", kinds", 1),
    "d4_lineage_over_runs": _with(_SHIP) + """, docs AS (SELECT row_number() OVER () AS doc, event_type, json, l_orderkey % 3 AS run FROM ship),""" + _NODES + """,
      kinds AS (SELECT DISTINCT event_type, doc, path, item, jtype FROM nodes),
      trees AS (SELECT event_type, doc, string_agg(path || item || jtype, '|' ORDER BY path, item, jtype) AS tree FROM kinds GROUP BY ALL),
      firsts AS (SELECT t.event_type, t.tree, min(d.run) AS run FROM trees t JOIN docs d USING (doc) GROUP BY ALL)
      SELECT event_type, 'EVENT' AS source, run, count(*) AS n_structures FROM firsts GROUP BY ALL""".replace(",\n      kinds", ", kinds", 1),
    "s2_sample_by_offset_index": _with(_DIRTY) + """,
      ranked AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY "partition", "offset") AS in_topic, row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS r FROM dirty),
      parts AS (SELECT topic, "partition", count(*) AS taken FROM ranked WHERE r <= 100 GROUP BY ALL),
      opened AS (SELECT topic, "partition", coalesce(sum(taken) OVER (PARTITION BY topic ORDER BY "partition"
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier FROM parts)
      SELECT false AS per_partition, topic, "partition", "offset", md5(value) AS digest FROM ranked WHERE in_topic <= 100
      UNION ALL SELECT true, topic, "partition", "offset", md5(value) FROM ranked JOIN opened USING (topic, "partition") WHERE r <= 100 AND earlier < 100""".replace(",\n      ranked", ", ranked", 1),
    "s3_partitions_by_offset_index": _with(_DIRTY) + """SELECT topic, 8 AS n_partitions, 8 - count(DISTINCT "partition") AS n_empty, count(*) AS n_messages FROM dirty GROUP BY topic
      UNION ALL SELECT 'silent', 8, 8, 0""",
}
