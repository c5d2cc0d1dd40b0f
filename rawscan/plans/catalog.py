"""Registered queries over the raw-object sources, with the SQL that each must equal.

Each query exports a table as a raw object (once per data folder), loads it by SQL through the sources and returns the
relation; the oracle states the same over the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F

from rawscan import operators
from rawscan.plans.export import exported, store
from rawscan.plans.sql import sql

BUCKET = "data"


def _t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- objects: key -> function(spark, sf_dir) -> rows of text, or bytes ---


def _events_json(spark, sf):
    flat = "to_json(struct(event_id, user_id, event_type, value))"
    return _t(spark, sf, "events").selectExpr(f"""concat(substr({flat}, 1, length({flat}) - 1), ',"props":', props, '}}') AS value""")


def _orders_csv(header):
    def make(spark, sf):
        rows = _t(spark, sf, "orders").selectExpr("1 AS o", "concat_ws(';', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority) AS value")
        if header:
            head = spark.sql("SELECT 0 AS o, ' o_orderkey;o_custkey; o_orderstatus ;o_totalprice;o_orderpriority' AS value")
            rows = head.unionByName(rows).repartition(1).sortWithinPartitions("o")
        return rows.select("value")

    return make


def _lines(*exprs, head=None, table="customer", order=None):
    def make(spark, sf):
        rows = _t(spark, sf, table)
        rows = rows.selectExpr("1 AS o", f"{exprs[0]} AS value")
        for extra in exprs[1:]:
            rows = rows.unionByName(_t(spark, sf, table).selectExpr("1 AS o", f"{extra} AS value"))
        for o, text in enumerate(head or []):
            rows = rows.unionByName(spark.createDataFrame([(0 if o < len(head) - 1 or len(head) == 1 else 2, text)], "o int, value string"))
        return rows.repartition(1).sortWithinPartitions("o").select("value")

    return make


def _quoted_texts(spark, sf):
    """All documents with their texts in quotes: quotes doubled, escapes escaped, line breaks as they are."""
    text = """replace(replace(coalesce(text, ''), '\\\\', '\\\\\\\\'), '"', '""')"""
    rows = _t(spark, sf, "documents").selectExpr("1 AS o", f"""concat(doc_id, ';"', {text}, '"') AS value""")
    head = spark.sql("SELECT 0 AS o, 'doc_id;text' AS value")
    return head.unionByName(rows).repartition(1).sortWithinPartitions("o").select("value")


def _bytes(charset, sep, expr, table, mark=b""):
    """A small table in another charset, which Spark's text sink doesn't write."""

    def make(spark, sf):
        rows = _t(spark, sf, table).selectExpr(f"{expr} AS v").collect()
        return mark + "".join(r.v + sep for r in rows).encode(charset)

    return make


def _text(content):
    return lambda spark, sf: content.encode()


def _numbered(line, head=None):
    """40,000 lines over every third number from 5 on: several splits of a megabyte."""

    def make(spark, sf):
        rows = spark.range(5, 120_005, 3, 1).selectExpr("id", f"{line} AS value")
        if head:
            rows = spark.createDataFrame([(0, head)], "id bigint, value string").unionByName(rows).repartition(1).sortWithinPartitions("id")
        return rows.select("value")

    return make


_XML_ROW = "concat('<customer id=\"', c_custkey, '\"><name>', c_name, '</name><segment>', c_mktsegment, '</segment>', if(c_custkey % 3 = 0, concat('<nation>', c_nationkey, '</nation>'), ''), '</customer>')"
OBJECTS = {
    "events.jsonl": _events_json,
    "orders.csv": _orders_csv(True),
    "orders-bare.csv": _orders_csv(False),
    "customer-quoted.csv": _lines("concat('\"', c_name, ';', c_custkey, '\";\"say \"\"', c_mktsegment, '\"\"\";', 'a\\\\\\\\b')", head=["q;s;e"]),
    "customer-short.csv": _lines("if(c_custkey % 2 = 0, cast(c_custkey AS string), concat(c_custkey, ';', c_name, ';extra;more'))", head=["k;n;x"]),
    "customer-gaps.csv": _lines("concat(c_custkey, ';;', c_name)", "'   '", head=["k;e;n"]),
    "documents.csv": _quoted_texts,
    "dates.csv": _lines("concat(o_orderkey, ';', date_format(o_orderdate, 'yyyy-MM-dd'), ';', o_totalprice)", head=["k;d;p"], table="orders"),
    "customer.txt": _lines("concat(c_custkey, '|', c_name, '|', c_mktsegment)"),
    "pairs.txt": _lines("concat('id=', c_custkey, ' name=', c_name, if(c_custkey % 2 = 0, concat(' seg=', c_mktsegment), ''))"),
    "blank.txt": _text("a\n\nb\r\n\n\nc"),
    "multi.txt": _bytes("utf-8", "||", "concat(s_suppkey, ':', s_name)", "supplier"),
    "latin1.txt": _bytes("iso-8859-1", "\n", "concat('é', s_suppkey, 'ü')", "supplier"),
    "utf16.txt": _bytes("utf-16-le", "\n", "concat('é', s_suppkey, 'ü')", "supplier"),
    "utf16-mark.txt": _bytes("utf-16-be", "\n", "concat('é', s_suppkey, 'ü')", "supplier", b"\xfe\xff"),
    "cp1252.txt": _bytes("cp1252", "\n", "concat('€', s_suppkey, '–', s_name)", "supplier"),
    "customer.xml": _lines(_XML_ROW, head=["<customers>", "</customers>"]),
    "notes.xml": _text('<log><note day="mon">Rain<place>Ghent</place> at noon</note><note><place/></note><note>\n</note></log>'),
    "blank.xml": _text('<stock><part no=""><label></label><shelf>  </shelf></part><part><label/></part></stock>'),
    "odd.xml": _text('<stock><part no="7"><label>bolt</label></part><part no="8"><label><b>nut</b></label></part><part no="9"><label>a</label><label>b</label></part><part no="10">loose<label>c</label></part></stock>'),
    "types.jsonl": _text('{"a":null,"b":1,"c":true,"d":9223372036854775808}\n{"a":1,"b":1.5,"c":1,"d":1}\n\n{"a":"x","b":2,"c":false}\r\n'),
    "mismatch.jsonl": _text('{"i":1,"f":1.5,"b":true}\n{"i":1.0,"f":"NaN","b":"true"}\n{"i":"7","f":2,"b":0}\n{"i":9223372036854775808,"f":null}\n'),
    "raw.jsonl": _text('{"v":"x"}\n{"v":1.50}\n{"v":1e2}\n{"v":true}\n{"v":[1, {"a": "b"}]}\n{"v":"1.50"}\n{"v":null}\n{"v":1,"v":"last"}\n'),
    "numbered.txt": _numbered("concat(id, '|', sha2(cast(id AS string), 256))"),
    "numbered.jsonl": _numbered("concat('{\"id\":', id, ',\"sha\":\"', sha2(cast(id AS string), 256), '\"}')"),
    "numbered.csv": _numbered("concat(id, ';', sha2(cast(id AS string), 256))", head="id;sha"),
}


def path(spark, sf_dir, key):
    return exported(spark, sf_dir, BUCKET, key, lambda: OBJECTS[key](spark, sf_dir))


@dataclass(frozen=True)
class Query:
    """SQL over TABLE(...) calls in which {key} stands for an object's path, and DuckDB's SQL for the same rows."""

    text: str
    oracle: str

    def __call__(self, spark, sf_dir):
        text = self.text
        for key in OBJECTS:
            if f"{{{key}}}" in text:
                text = text.replace(f"{{{key}}}", path(spark, sf_dir, key))
        return sql(spark, text)


_EVENTS = "TABLE(raw.json.load(path => '{events.jsonl}'))"
_ORDERS = "TABLE(raw.csv.load(path => '{orders.csv}'))"
_CUSTOMERS = "(SELECT CAST(split_part(line, '|', 1) AS bigint) AS k, split_part(line, '|', 2) AS name, split_part(line, '|', 3) AS seg FROM TABLE(raw.txt.load(path => '{customer.txt}')))"
_EXACT = "count(*) AS n, min({0}) AS lo, max({0}) AS hi, sum({0}) AS total"
_EXACT_ORACLE = "SELECT 40000::BIGINT AS n, 5::BIGINT AS lo, 120002::BIGINT AS hi, 2400140000::BIGINT AS total"
_QUERIES = {
    "json_load_all": Query(f"SELECT event_id, user_id, event_type, value, props FROM {_EVENTS}", "SELECT event_id, user_id, event_type, value, replace(props, ': ', ':') AS props FROM events"),
    "json_project": Query(f"SELECT event_type, count(*) AS n, sum(user_id) AS users FROM {_EVENTS} GROUP BY event_type", "SELECT event_type, count(*) AS n, sum(user_id)::BIGINT AS users FROM events GROUP BY event_type"),
    "json_count": Query(f"SELECT count(*) AS n FROM {_EVENTS}", "SELECT count(*) AS n FROM events"),
    "json_nested_text": Query(f"SELECT event_id, get_json_object(props, '$.k') AS k FROM {_EVENTS}", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events"),
    "json_additional_columns": Query("SELECT event_id, campaign FROM TABLE(raw.json.load(path => '{events.jsonl}', additional_columns => 'campaign:varchar, score:double'))", "SELECT event_id, NULL::VARCHAR AS campaign FROM events"),
    "json_type_override": Query("SELECT event_id, user_id FROM TABLE(raw.json.load(path => '{events.jsonl}', additional_columns => 'event_id:double'))", "SELECT event_id::DOUBLE AS event_id, user_id FROM events"),
    "json_types": Query("SELECT a, b, c, d FROM TABLE(raw.json.load(path => '{types.jsonl}'))", "SELECT * FROM (VALUES (NULL, 1.0::DOUBLE, 'true', 9223372036854775808::DOUBLE), ('1', 1.5, '1', 1), ('x', 2, 'false', NULL)) t(a, b, c, d)"),
    "json_sample_limit": Query("SELECT * FROM TABLE(raw.json.load(path => '{mismatch.jsonl}', schema_sample_rows => 1))", "SELECT * FROM (VALUES (1::BIGINT, 1.5::DOUBLE, true), (NULL, NULL, NULL), (NULL, 2, NULL), (NULL, NULL, NULL)) t(i, f, b)"),
    "json_raw_scalars": Query("SELECT v FROM TABLE(raw.json.load(path => '{raw.jsonl}'))", """SELECT * FROM (VALUES ('x'), ('1.50'), ('1e2'), ('true'), ('[1,{"a":"b"}]'), ('1.50'), (NULL), ('last')) t(v)"""),
    "csv_header": Query(f"SELECT CAST(o_orderkey AS bigint) AS o_orderkey, o_orderstatus, CAST(o_totalprice AS double) AS o_totalprice, o_orderpriority FROM {_ORDERS}", "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"),
    "csv_no_header": Query("SELECT CAST(column_2 AS bigint) AS cust, count(*) AS n FROM TABLE(raw.csv.load(path => '{orders-bare.csv}', header => 'false')) GROUP BY 1", "SELECT o_custkey AS cust, count(*) AS n FROM orders GROUP BY 1"),
    "csv_quoted": Query("SELECT q, s, e FROM TABLE(raw.csv.load(path => '{customer-quoted.csv}'))", "SELECT c_name || ';' || c_custkey AS q, 'say \"' || c_mktsegment || '\"' AS s, 'a\\b' AS e FROM customer"),
    "csv_short_row_null": Query("SELECT k, n, x FROM TABLE(raw.csv.load(path => '{customer-short.csv}'))", "SELECT c_custkey::VARCHAR AS k, CASE WHEN c_custkey % 2 = 1 THEN c_name END AS n, CASE WHEN c_custkey % 2 = 1 THEN 'extra' END AS x FROM customer"),
    "csv_empty_string_blank_skipped": Query("SELECT k, e, n FROM TABLE(raw.csv.load(path => '{customer-gaps.csv}'))", "SELECT c_custkey::VARCHAR AS k, '' AS e, c_name AS n FROM customer"),
    "csv_multiline": Query("SELECT CAST(doc_id AS bigint) AS doc_id, text FROM TABLE(raw.csv.load(path => '{documents.csv}', multiline => 'true'))", "SELECT doc_id, coalesce(text, '') AS text FROM documents"),
    "txt_lines": Query("SELECT line FROM TABLE(raw.txt.load(path => '{customer.txt}'))", "SELECT c_custkey || '|' || c_name || '|' || c_mktsegment AS line FROM customer"),
    "txt_blank_kept": Query("SELECT line FROM TABLE(raw.txt.load(path => '{blank.txt}', line_break => '\\n'))", "SELECT unnest(['a', '', 'b' || chr(13), '', '', 'c']) AS line"),
    "txt_multichar_break": Query("SELECT line FROM TABLE(raw.txt.load(path => '{multi.txt}', line_break => '||'))", "SELECT s_suppkey || ':' || s_name AS line FROM supplier"),
    "txt_latin1": Query("SELECT line FROM TABLE(raw.txt.load(path => '{latin1.txt}', encoding => 'ISO-8859-1'))", "SELECT 'é' || s_suppkey || 'ü' AS line FROM supplier"),
    "txt_utf16": Query("SELECT line FROM TABLE(raw.txt.load(path => '{utf16.txt}', encoding => 'UTF-16LE'))", "SELECT 'é' || s_suppkey || 'ü' AS line FROM supplier"),
    "txt_utf16_mark": Query("SELECT line FROM TABLE(raw.txt.load(path => '{utf16-mark.txt}', encoding => 'UTF-16'))", "SELECT 'é' || s_suppkey || 'ü' AS line FROM supplier"),
    "txt_windows1252": Query("SELECT line FROM TABLE(raw.txt.load(path => '{cp1252.txt}', encoding => 'windows-1252'))", "SELECT '€' || s_suppkey || '–' || s_name AS line FROM supplier"),
    "txt_split_to_map": Query("WITH m AS (SELECT split_to_map(line, ' ', '=') AS kv FROM TABLE(raw.txt.load(path => '{pairs.txt}'))) SELECT CAST(element_at(kv, 'id') AS bigint) AS id, upper(element_at(kv, 'name')) AS name, element_at(kv, 'seg') AS seg FROM m", "SELECT c_custkey AS id, upper(c_name) AS name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS seg FROM customer"),
    "xml_attrs_elements": Query("SELECT CAST(\"@id\" AS bigint) AS id, name, segment, nation FROM TABLE(raw.xml.load(path => '{customer.xml}', row_element => 'customer', invalid_row_column => ''))", "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CASE WHEN c_custkey % 3 = 0 THEN c_nationkey::VARCHAR END AS nation FROM customer"),
    "xml_include_text": Query("SELECT \"@day\" AS day, place, text FROM TABLE(raw.xml.load(path => '{notes.xml}', row_element => 'note', include_text => 'true'))", "SELECT * FROM (VALUES ('mon', 'Ghent', 'Rain at noon'), (NULL, '', NULL), (NULL, NULL, NULL)) t(day, place, text)"),
    "xml_empty_as_null": Query("SELECT 1 AS pass, \"@no\" AS no, label, shelf FROM TABLE(raw.xml.load(path => '{blank.xml}', row_element => 'part')) UNION ALL SELECT 2, \"@no\", label, shelf FROM TABLE(raw.xml.load(path => '{blank.xml}', row_element => 'part', empty_as_null => 'true'))", "SELECT * FROM (VALUES (1, '', '', ''), (1, NULL, '', NULL), (2, NULL, NULL, NULL), (2, NULL, NULL, NULL)) t(pass, no, label, shelf)"),
    "xml_invalid_rows": Query("SELECT \"@no\" AS no, label, broken FROM TABLE(raw.xml.load(path => '{odd.xml}', row_element => 'part', invalid_row_column => 'broken'))", """SELECT * FROM (VALUES ('7', 'bolt', NULL), (NULL, NULL, '<part no="8"><label><b>nut</b></label></part>'), (NULL, NULL, '<part no="9"><label>a</label><label>b</label></part>'), (NULL, NULL, '<part no="10">loose<label>c</label></part>')) t(no, label, broken)"""),
    "tiny_splits_txt": Query("SELECT " + _EXACT.format("CAST(split_part(line, '|', 1) AS bigint)") + " FROM TABLE(raw.txt.load(path => '{numbered.txt}', split_size_mb => 1))", _EXACT_ORACLE),
    "tiny_splits_json": Query("SELECT " + _EXACT.format("id") + " FROM TABLE(raw.json.load(path => '{numbered.jsonl}', split_size_mb => 1, schema_sample_rows => 1))", _EXACT_ORACLE),
    "tiny_splits_csv": Query("SELECT " + _EXACT.format("CAST(id AS bigint)") + " FROM TABLE(raw.csv.load(path => '{numbered.csv}', split_size_mb => 1))", _EXACT_ORACLE),
    "host_join": Query(f"SELECT c.seg, count(*) AS n, min(CAST(o.o_totalprice AS double)) AS lo, max(CAST(o.o_totalprice AS double)) AS hi FROM {_ORDERS} o JOIN {_CUSTOMERS} c ON CAST(o.o_custkey AS bigint) = c.k GROUP BY c.seg", "SELECT c_mktsegment AS seg, count(*) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1"),
    "host_groupby_rollup": Query(f"SELECT o_orderstatus, o_orderpriority, count(*) AS n, count(DISTINCT o_custkey) AS custs FROM {_ORDERS} GROUP BY ROLLUP (o_orderstatus, o_orderpriority)", "SELECT o_orderstatus, o_orderpriority, count(*) AS n, count(DISTINCT o_custkey) AS custs FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)"),
    "host_cube_grouping_sets": Query(f"SELECT o_orderstatus, o_orderpriority, grouping_id() AS g, count(*) AS n FROM {_ORDERS} GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderpriority), ())", "SELECT o_orderstatus, o_orderpriority, grouping(o_orderstatus, o_orderpriority) AS g, count(*) AS n FROM orders GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderpriority), ())"),
    "host_window": Query(f"SELECT CAST(o_custkey AS bigint) AS cust, CAST(o_orderkey AS bigint) AS k, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderkey AS bigint)) AS bigint) AS nth, count(*) OVER (PARTITION BY o_custkey) AS n, lag(CAST(o_orderkey AS bigint)) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderkey AS bigint)) AS before FROM {_ORDERS}", "SELECT o_custkey AS cust, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS nth, count(*) OVER (PARTITION BY o_custkey) AS n, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before FROM orders"),
    "host_setops": Query(f"(SELECT CAST(o_custkey AS bigint) AS k FROM {_ORDERS} INTERSECT SELECT k FROM {_CUSTOMERS}) EXCEPT SELECT k FROM {_CUSTOMERS} WHERE seg = 'BUILDING' UNION ALL SELECT -1", "(SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer) EXCEPT SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' UNION ALL SELECT -1"),
    "host_topk": Query(f"SELECT CAST(o_orderkey AS bigint) AS k, CAST(o_totalprice AS double) AS price FROM {_ORDERS} ORDER BY price DESC, k LIMIT 20", "SELECT o_orderkey AS k, o_totalprice AS price FROM orders ORDER BY price DESC, k LIMIT 20"),
    "host_semi_anti": Query(f"SELECT 'semi' AS kind, k FROM {_CUSTOMERS} c WHERE EXISTS (SELECT 1 FROM {_ORDERS} o WHERE CAST(o.o_custkey AS bigint) = c.k) UNION ALL SELECT 'anti', k FROM {_CUSTOMERS} c WHERE NOT EXISTS (SELECT 1 FROM {_ORDERS} o WHERE CAST(o.o_custkey AS bigint) = c.k)", "SELECT CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) THEN 'semi' ELSE 'anti' END AS kind, c_custkey AS k FROM customer"),
    "host_right_join": Query(f"SELECT c.k, count(o.o_orderkey) AS n FROM {_ORDERS} o RIGHT JOIN {_CUSTOMERS} c ON CAST(o.o_custkey AS bigint) = c.k AND o.o_orderstatus = 'P' GROUP BY c.k", "SELECT c_custkey AS k, count(o_orderkey) AS n FROM orders RIGHT JOIN customer ON o_custkey = c_custkey AND o_orderstatus = 'P' GROUP BY 1"),
    "host_full_join": Query(f"SELECT coalesce(a.k, b.k) AS k, a.seg AS one, b.seg AS two FROM (SELECT k, seg FROM {_CUSTOMERS} WHERE seg < 'H') a FULL OUTER JOIN (SELECT k, seg FROM {_CUSTOMERS} WHERE seg > 'B') b ON a.k = b.k", "SELECT coalesce(a.c_custkey, b.c_custkey) AS k, a.c_mktsegment AS one, b.c_mktsegment AS two FROM (SELECT * FROM customer WHERE c_mktsegment < 'H') a FULL OUTER JOIN (SELECT * FROM customer WHERE c_mktsegment > 'B') b ON a.c_custkey = b.c_custkey"),
    "host_lateral": Query(f"SELECT c.k, t.top, t.n FROM {_CUSTOMERS} c CROSS JOIN LATERAL (SELECT max(CAST(o.column_4 AS double)) AS top, count(*) AS n FROM TABLE(raw.csv.load(path => '{{orders-bare.csv}}', header => 'false')) o WHERE CAST(o.column_2 AS bigint) = c.k) t", "SELECT c_custkey AS k, top, n FROM customer, LATERAL (SELECT max(o_totalprice) AS top, count(*) AS n FROM orders WHERE o_custkey = c_custkey) t"),
    "host_dates": Query("SELECT CAST(k AS bigint) AS k, year(CAST(d AS date)) AS y, quarter(CAST(d AS date)) AS q, date_format(date_add(CAST(d AS date), 45), 'yyyy-MM-dd') AS later, CAST(datediff(CAST(d AS date), DATE '1995-06-17') AS bigint) AS days, date_format(date_trunc('month', CAST(d AS date)), 'yyyy-MM-dd') AS month FROM TABLE(raw.csv.load(path => '{dates.csv}'))", "SELECT o_orderkey AS k, year(o_orderdate)::INTEGER AS y, quarter(o_orderdate)::INTEGER AS q, strftime(o_orderdate::DATE + 45, '%Y-%m-%d') AS later, date_diff('day', DATE '1995-06-17', o_orderdate::DATE) AS days, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month FROM orders"),
    "host_arrays": Query(f"SELECT k, w AS part, size(parts) AS n, array_join(array_sort(parts), '+') AS sorted FROM (SELECT k, split(concat(seg, '#', name), '#') AS parts FROM {_CUSTOMERS}) LATERAL VIEW explode(parts) t AS w", "SELECT k, unnest(parts) AS part, len(parts)::INTEGER AS n, array_to_string(list_sort(parts), '+') AS sorted FROM (SELECT c_custkey AS k, string_split(c_mktsegment || '#' || c_name, '#') AS parts FROM customer)"),
    "host_dynamic_filter": Query(f"SELECT o.o_orderpriority, count(*) AS n FROM {_ORDERS} o JOIN (SELECT k FROM {_CUSTOMERS} WHERE seg = 'MACHINERY' AND name LIKE '%7') c ON CAST(o.o_custkey AS bigint) = c.k GROUP BY o.o_orderpriority", "SELECT o_orderpriority, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'MACHINERY' AND c_name LIKE '%7' GROUP BY 1"),
    "host_cte_subquery": Query(f"WITH per AS (SELECT o_custkey, count(*) AS n FROM {_ORDERS} GROUP BY o_custkey) SELECT CAST(o_custkey AS bigint) AS cust, CAST(n AS varchar) AS n FROM per WHERE n > (SELECT avg(n) FROM per)", "WITH per AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) SELECT o_custkey AS cust, n::VARCHAR AS n FROM per WHERE n > (SELECT avg(n) FROM per)"),
    "host_functions": Query(f"SELECT k, upper(name) AS u, strpos(name, '#') AS at, substr(seg, 1, 3) AS s3, abs(k - 500) AS d, coalesce(nullif(seg, 'BUILDING'), '-') AS seg FROM {_CUSTOMERS}", "SELECT c_custkey AS k, upper(c_name) AS u, strpos(c_name, '#') AS at, substr(c_mktsegment, 1, 3) AS s3, abs(c_custkey - 500) AS d, coalesce(nullif(c_mktsegment, 'BUILDING'), '-') AS seg FROM customer"),
}


def _tree(spark, sf_dir):
    nations = _t(spark, sf_dir, "nation").collect()
    for n in nations:
        exported(spark, sf_dir, "tree", f"r{n.n_regionkey}/{n.n_name}.txt", lambda n=n: f"{n.n_name}\n".encode())
    exported(spark, sf_dir, "tree", "top.txt", lambda: b"top\n")


def list_recursive(spark, sf_dir):
    _tree(spark, sf_dir)
    return sql(spark, "SELECT path, bucket, key, name, parent, size, type FROM TABLE(raw.list.objects(bucket => 'tree', prefix => 'r')) WHERE last_modified IS NOT NULL")


def list_prefixes(spark, sf_dir):
    _tree(spark, sf_dir)
    return sql(spark, "SELECT key, name, parent, size, type FROM TABLE(raw.list.objects(bucket => 'tree', recursive_listing => 'false', include_prefixes => 'true'))")


def list_buckets(spark, sf_dir):
    _tree(spark, sf_dir)
    path(spark, sf_dir, "blank.txt")
    return sql(spark, "SELECT path, bucket FROM TABLE(raw.list.buckets())")


def host_asof(spark, sf_dir):
    events = sql(spark, Query(f"SELECT event_id, user_id, event_type, value FROM {_EVENTS}", "").text.replace("{events.jsonl}", path(spark, sf_dir, "events.jsonl")))
    left = events.where("event_type = 'click'").select("user_id", "event_id")
    right = events.where("event_type <> 'click'").select("user_id", "event_id", "value")
    return operators.asof_join(left, right, "user_id", "event_id", ["value"])


def host_range(spark, sf_dir):
    customers = sql(spark, f"SELECT k, seg FROM {_CUSTOMERS}".replace("{customer.txt}", path(spark, sf_dir, "customer.txt")))
    spans = customers.selectExpr("k AS span", "k AS lo", "k + 7 AS hi")
    return operators.range_join(customers, spans, "k", "lo", "hi", 8.0).select("k", "span")


def host_outer_theta(spark, sf_dir):
    customers = sql(spark, f"SELECT k, seg FROM {_CUSTOMERS}".replace("{customer.txt}", path(spark, sf_dir, "customer.txt")))
    return operators.range_count(customers.selectExpr("k", "seg", "k + 1 AS lo", "k + 20 AS hi"), customers, "k", "seg", "k", "lo", "hi", 20.0)


_MORE = {
    "list_recursive": (list_recursive, "SELECT 's3://tree/' || key AS path, 'tree' AS bucket, key, n_name || '.txt' AS name, 'r' || n_regionkey || '/' AS parent, strlen(n_name) + 1 AS size, 'object' AS type FROM (SELECT *, 'r' || n_regionkey || '/' || n_name || '.txt' AS key FROM nation)"),
    "list_prefixes": (list_prefixes, "SELECT DISTINCT 'r' || n_regionkey || '/' AS key, 'r' || n_regionkey AS name, '' AS parent, NULL::BIGINT AS size, 'prefix' AS type FROM nation UNION ALL SELECT 'top.txt', 'top.txt', '', 4, 'object'"),
    "list_buckets": (list_buckets, "SELECT * FROM (VALUES ('s3://data', 'data'), ('s3://tree', 'tree')) t(path, bucket)"),
    "host_asof": (host_asof, "SELECT l.user_id, l.event_id, r.value FROM (SELECT user_id, event_id FROM events WHERE event_type = 'click') l ASOF LEFT JOIN (SELECT * FROM events WHERE event_type <> 'click') r ON l.user_id = r.user_id AND l.event_id >= r.event_id"),
    "host_outer_theta": (host_outer_theta, "SELECT a.c_custkey AS k, count(b.c_custkey) AS n FROM customer a LEFT JOIN customer b ON a.c_mktsegment = b.c_mktsegment AND b.c_custkey BETWEEN a.c_custkey + 1 AND a.c_custkey + 20 GROUP BY 1"),
    "host_range": (host_range, "SELECT a.c_custkey AS k, b.c_custkey AS span FROM customer a JOIN customer b ON a.c_custkey >= b.c_custkey AND a.c_custkey < b.c_custkey + 7"),
}


def entry(spark, sf_dir):
    """Events as raw NDJSON, loaded back with an inferred schema and aggregated."""
    return _QUERIES["json_project"](spark, sf_dir).orderBy(F.desc("n"))


def queries():
    return {**_QUERIES, **{k: f for k, (f, _) in _MORE.items()}}


def oracle_sql():
    return {**{k: q.oracle for k, q in _QUERIES.items()}, **{k: o for k, (_, o) in _MORE.items()}}


__all__ = ["entry", "oracle_sql", "queries", "store"]
