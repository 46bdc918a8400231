"""The same queries as plain SQL over the driver's tables, for DuckDB."""

EVENTS = """
ev AS (
  SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS epoch_ms,
         CAST(props->>'$.k' AS BIGINT) AS k,
         'host/000' || CAST(user_id % 10 AS VARCHAR) AS stream
  FROM events
)
"""

KVLOG = (
    EVENTS
    + """,
kvlog AS (
  SELECT event_id, stream,
         row_number() OVER (PARTITION BY stream ORDER BY event_id) - 1 AS seq_num,
         'user=' || CAST(user_id AS VARCHAR) || CASE event_type
           WHEN 'signup' THEN ';search=q' || CAST(k % 15 AS VARCHAR)
           WHEN 'view' THEN ';item=' || CAST(k % 20 AS VARCHAR) || ';action=view'
           WHEN 'click' THEN ';item=' || CAST(k % 20 AS VARCHAR) || ';action=cart'
           WHEN 'purchase' THEN ';item=' || CAST(k % 20 AS VARCHAR) || ';action=buy'
           ELSE ';broken' END || ';epoch_ms=' || CAST(epoch_ms AS VARCHAR) AS body
  FROM ev
)
"""
)

LISTING = """
listing AS (
  SELECT 'host/000' || CAST(k AS VARCHAR) AS stream, TIMESTAMP '2024-01-01' AS created_at,
         CAST(NULL AS TIMESTAMP) AS deleted_at,
         CAST(CASE WHEN k % 2 = 0 THEN 5 ELSE 0 END AS BIGINT) AS first_seq
  FROM range(10) AS t(k)
  UNION ALL
  SELECT 'feature/s' || CAST(s_suppkey AS VARCHAR), TIMESTAMP '2024-01-01', NULL, 0 FROM supplier
  UNION ALL
  SELECT 'host/x' || CAST(s_suppkey AS VARCHAR), TIMESTAMP '2024-01-01',
         CASE WHEN s_suppkey % 2 = 1 THEN TIMESTAMP '2024-02-01' END, 0 FROM supplier
)
"""

PARSED = (
    KVLOG
    + """,
parsed AS (
  SELECT stream, seq_num,
         CAST(regexp_extract(body, 'user=([0-9]+)', 1) AS INTEGER) AS user_id,
         CASE WHEN contains(body, 'action=') THEN regexp_extract(body, 'action=([a-z]+)', 1)
              ELSE 'search' END AS "action",
         TRY_CAST(regexp_extract(body, 'item=([0-9]+)', 1) AS INTEGER) AS item_id,
         CASE WHEN contains(body, 'search=') THEN regexp_extract(body, 'search=(q[0-9]+)', 1) END
           AS query,
         CAST(regexp_extract(body, 'epoch_ms=([0-9]+)', 1) AS BIGINT) AS epoch_ms
  FROM kvlog WHERE NOT contains(body, 'broken')
)
"""
)

STEPS = (
    PARSED
    + """,
steps AS (
  SELECT user_id, "action", query, epoch_ms,
         lead("action", 1) OVER w AS a1, lead("action", 2) OVER w AS a2,
         lead("action", 3) OVER w AS a3,
         lead(item_id, 1) OVER w AS i1, lead(item_id, 2) OVER w AS i2,
         lead(item_id, 3) OVER w AS i3, lead(epoch_ms, 3) OVER w AS last_ms
  FROM parsed WINDOW w AS (PARTITION BY user_id ORDER BY epoch_ms, stream, seq_num)
)
"""
)


OWN_ITEMS = """FROM (
    SELECT * REPLACE (CASE WHEN item_id % 2 = 0 THEN user_id % 20 ELSE item_id END AS item_id)
    FROM parsed)"""


def conversions(within_ms: str, extra: str = "") -> str:
    return f"""
conversions AS (
  SELECT CAST(user_id AS BIGINT) AS "userId", query AS "matchedSearchQuery",
         CAST(i3 AS BIGINT) AS "matchedItemId"
  FROM steps
  WHERE "action" = 'search' AND a1 = 'view' AND a2 = 'cart' AND a3 = 'buy'
    AND last_ms - epoch_ms < {within_ms} {extra}
)
"""


CHANGES = """
changes AS (
  SELECT o_orderkey, o_custkey AS custkey, o_orderstatus AS status, o_orderpriority AS pri,
         CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0 THEN 'd' ELSE 'u' END AS flag,
         row_number() OVER (ORDER BY o_orderkey) - 1 AS seq_num
  FROM orders
)
"""

COUNTS = (
    EVENTS
    + """,
counted AS (
  SELECT k % 20 AS item, 'q' || CAST(user_id % 15 AS VARCHAR) AS query, count(*) AS n
  FROM ev GROUP BY ALL
),
ranked AS (
  SELECT item, query, n, row_number() OVER (PARTITION BY item ORDER BY n DESC, query) AS rn
  FROM counted
)
"""
)

DAY = "CAST(86400000 AS BIGINT)"
DECODED = """
SELECT {keep} custkey, CASE WHEN flag = 'u' THEN status END AS status,
       CASE WHEN flag = 'u' THEN pri END AS pri,
       CASE WHEN flag = 'u' THEN '+U' ELSE '-D' END AS kind
FROM {source}
"""
TOP_LISTS = """
SELECT item, string_agg(query, ',' ORDER BY rn) AS top_queries FROM ranked WHERE rn <= 5 GROUP BY item
"""
LAST_CHANGE = """
  SELECT * FROM changes
  QUALIFY row_number() OVER (PARTITION BY {group} ORDER BY seq_num DESC) = 1
"""
VALUE_JSON = "CASE WHEN flag = 'u' THEN CAST(json_object('status', status, 'pri', pri) AS VARCHAR) ELSE '' END"
KEY_JSON = "CAST(json_object('custkey', custkey) AS VARCHAR)"
KIND_OF_ORDER = (
    "CASE o_orderkey % 4 WHEN 0 THEN '+I' WHEN 1 THEN '-U' WHEN 2 THEN '+U' ELSE '-D' END"
)
TIME_TEXT = "'%Y-%m-%d %H:%M:%S.%g'"
FIRST_READ = "CASE WHEN CAST(right(stream, 1) AS INTEGER) % 2 = 0 THEN 5 ELSE 0 END"
HALF = "(SELECT count(*) // 2 FROM kvlog AS o WHERE o.stream = kvlog.stream)"
LISTING_COLUMNS = f"""
SELECT stream, strftime(created_at, {TIME_TEXT}) AS created_at,
       strftime(deleted_at, {TIME_TEXT}) AS deleted_at, first_seq
FROM listing
"""
ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_orderpriority"
NUMBERED_DOCUMENTS = """
numbered AS (
  SELECT doc_id, octet_length(encode(text)) AS size, row_number() OVER (ORDER BY doc_id) - 1 AS seq_num
  FROM documents
)
"""

ORACLE: dict[str, str] = {
    "scan_static_streams": f"""WITH {KVLOG} SELECT stream, seq_num, body FROM kvlog
        WHERE stream IN ('host/0000', 'host/0003') AND seq_num >= {FIRST_READ}""",
    "scan_prefix_streams": f"""WITH {KVLOG}, {LISTING} SELECT stream, seq_num, body
        FROM kvlog JOIN listing USING (stream)
        WHERE starts_with(stream, 'host/') AND deleted_at IS NULL AND seq_num >= first_seq""",
    "list_streams": f"WITH {LISTING} {LISTING_COLUMNS} ORDER BY stream",
    "list_live_streams": f"WITH {LISTING} {LISTING_COLUMNS} WHERE deleted_at IS NULL ORDER BY stream",
    "discover_new_streams": f"""WITH {LISTING} SELECT stream, first_seq FROM listing
        WHERE deleted_at IS NULL
          AND CAST(regexp_extract(stream, '([0-9]+)$', 1) AS BIGINT) % 2 <> 0""",
    "scan_start_first": f"""WITH {KVLOG} SELECT stream, min(seq_num) AS first_read,
        count(*) AS records FROM kvlog WHERE seq_num >= {FIRST_READ} GROUP BY stream""",
    "scan_start_next": f"""WITH {KVLOG} SELECT stream, seq_num, body FROM kvlog
        WHERE event_id > (SELECT 3 * max(event_id) // 4 FROM events)""",
    "scan_resume": f"WITH {KVLOG} SELECT stream, seq_num, body FROM kvlog WHERE seq_num >= {HALF}",
    "stream_progress": f"""WITH {KVLOG} SELECT stream, max(seq_num) + 1 AS next_seq,
        count(*) AS consumed_records, CAST(sum(length(body)) AS BIGINT) AS consumed_bytes
        FROM kvlog WHERE seq_num >= {HALF} GROUP BY stream""",
    "check_tail": f"""WITH {KVLOG}, {LISTING} SELECT stream,
        coalesce(max(seq_num) + 1, min(first_seq)) AS next_seq
        FROM listing LEFT JOIN kvlog USING (stream) GROUP BY stream""",
    "read_limited": f"""WITH {KVLOG} SELECT stream, seq_num, body FROM kvlog WHERE seq_num >= 10
        QUALIFY row_number() OVER (PARTITION BY stream ORDER BY seq_num) <= 5""",
    "detect_trim_gap": f"""WITH {LISTING} SELECT stream, length(stream) % 7 AS next_seq, first_seq
        FROM listing WHERE length(stream) % 7 < first_seq""",
    "decode_text": f"WITH {KVLOG} SELECT body AS text FROM kvlog",
    "decode_with_context": f"WITH {KVLOG} SELECT stream, seq_num, body AS text FROM kvlog",
    "flat_decode": f"""WITH {KVLOG} SELECT stream, seq_num, unnest(string_split(body, ';')) AS piece
        FROM kvlog""",
    "json_decode": "SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events",
    "append_encode_json": """SELECT o_orderkey, CAST(0 AS BIGINT) AS n_headers,
        CAST(json_object('o_orderkey', o_orderkey, 'o_custkey', o_custkey,
             'o_orderstatus', o_orderstatus, 'o_orderpriority', o_orderpriority) AS VARCHAR) AS body
        FROM orders""",
    "custom_encode": """SELECT o_orderkey,
        'customer ' || CAST(o_custkey AS VARCHAR) || ' ' || lower(o_orderstatus) AS body,
        'priority' AS header_name, o_orderpriority AS header_value FROM orders""",
    "parse_kv_events": f"WITH {PARSED} SELECT * FROM parsed",
    "parse_kv_rejects": f"""WITH {KVLOG} SELECT stream, seq_num, body, 'shape' AS reason FROM kvlog
        WHERE contains(body, 'broken')""",
    "event_time_column": f"""WITH {PARSED} SELECT stream, seq_num,
        strftime(make_timestamp(epoch_ms * 1000), {TIME_TEXT}) AS event_time FROM parsed""",
    "project_key_value": f"""WITH {CHANGES} SELECT
        CAST(json_object('custkey', custkey, 'o_orderkey', o_orderkey) AS VARCHAR) AS "key",
        CAST(json_object('status', status, 'pri', pri) AS VARCHAR) AS "value" FROM changes""",
    "upsert_encode": f"""WITH {CHANGES} SELECT o_orderkey, '@key' AS first_header, {KEY_JSON} AS "key",
        '@action' AS second_header, flag AS "action", {VALUE_JSON} AS body FROM changes""",
    "extract_key_action": f"""WITH {CHANGES} SELECT seq_num, {KEY_JSON} AS "key", flag AS "action"
        FROM changes""",
    "action_to_kind": f"""WITH {CHANGES} SELECT seq_num,
        CASE flag WHEN 'u' THEN '+U' WHEN 'd' THEN '-D' END AS kind FROM changes""",
    "upsert_decode": f"WITH {CHANGES} {DECODED.format(keep='seq_num,', source='changes')}",
    "compact_upserts": f"""WITH {CHANGES} SELECT seq_num // 1000 AS append_batch, seq_num,
        {KEY_JSON} AS "key", {VALUE_JSON} AS body
        FROM ({LAST_CHANGE.format(group='seq_num // 1000, custkey')})""",
    "insert_only_guard": f"""SELECT o_orderkey, {KIND_OF_ORDER} AS kind, o_orderkey % 4 = 0 AS accepted
        FROM orders""",
    "normalize_changelog": f"""SELECT o_orderkey,
        CASE WHEN {KIND_OF_ORDER} IN ('+I', '+U') THEN 'u' ELSE 'd' END AS "action"
        FROM orders WHERE {KIND_OF_ORDER} <> '-U'""",
    "materialize_latest": f"""WITH {CHANGES} SELECT custkey, status, pri
        FROM ({LAST_CHANGE.format(group='custkey')}) WHERE flag = 'u'""",
    "materialize_updates_only": f"""WITH {CHANGES} SELECT custkey, status, pri FROM changes
        WHERE flag = 'u'
        QUALIFY row_number() OVER (PARTITION BY custkey ORDER BY seq_num DESC) = 1
        ORDER BY custkey""",
    "materialize_as_of": f"""WITH {CHANGES}, early AS (SELECT * FROM changes WHERE seq_num < 10000)
        SELECT custkey, status, pri FROM (SELECT * FROM early
          QUALIFY row_number() OVER (PARTITION BY custkey ORDER BY seq_num DESC) = 1)
        WHERE flag = 'u'""",
    "append_roundtrip": f"""SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS seq_num,
        {ORDER_COLUMNS} FROM orders""",
    "upsert_roundtrip": f"""WITH {CHANGES}, last AS ({LAST_CHANGE.format(group='custkey')}),
        placed AS (SELECT * REPLACE (row_number() OVER (ORDER BY seq_num) - 1 AS seq_num) FROM last)
        {DECODED.format(keep='seq_num,', source='placed')}""",
    "sql_insert_append": f"SELECT {ORDER_COLUMNS} FROM orders",
    "sql_scan_insert_only": """SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS seq_num, o_orderkey, o_orderstatus
        FROM orders""",
    "sql_insert_upsert": f"""WITH {CHANGES},
        last AS ({LAST_CHANGE.format(group='o_orderkey % 2, custkey')})
        {DECODED.format(keep='', source='last')}""",
    "sql_scan_upsert": f"WITH {CHANGES} {DECODED.format(keep='', source='changes')}",
    "append_preserves_order": """SELECT
        row_number() OVER (ORDER BY o_custkey, o_orderkey DESC) - 1 AS seq_num, o_orderkey FROM orders""",
    "route_to_streams": """SELECT 'orders/' || CAST(o_custkey % 4 AS VARCHAR) AS stream,
        row_number() OVER (PARTITION BY o_custkey % 4 ORDER BY o_orderkey) - 1 AS seq_num, o_orderkey
        FROM orders""",
    "append_batches_by_count": f"""WITH {NUMBERED_DOCUMENTS} SELECT doc_id,
        seq_num // 1000 AS append_batch, seq_num // 100 AS batch_of_100 FROM numbered""",
    "append_batches_by_bytes": f"""WITH RECURSIVE {NUMBERED_DOCUMENTS}, filled AS (
          SELECT seq_num, size AS used, CAST(0 AS BIGINT) AS append_in_block
          FROM numbered WHERE seq_num % 1000 = 0
          UNION ALL
          SELECT n.seq_num, CASE WHEN f.used + n.size > 65536 THEN n.size ELSE f.used + n.size END,
                 CASE WHEN f.used + n.size > 65536 THEN f.append_in_block + 1
                      ELSE f.append_in_block END
          FROM filled AS f JOIN numbered AS n ON n.seq_num = f.seq_num + 1 AND n.seq_num % 1000 <> 0
        )
        SELECT doc_id, seq_num // 1000 AS append_block, append_in_block
        FROM filled JOIN numbered USING (seq_num)""",
    "oversize_records": f"""WITH {NUMBERED_DOCUMENTS} SELECT doc_id, size FROM numbered
        WHERE size > 5000""",
    "record_metering": """SELECT doc_id, octet_length(encode(text)) + 4 + octet_length(encode(lang))
        + 6 + octet_length(encode(source)) AS metered_bytes FROM documents""",
    "late_rows": f"""WITH {EVENTS}, arrived AS (
          SELECT event_id, epoch_ms,
                 (event_id + CASE WHEN event_id % 97 = 0 THEN 600 ELSE 0 END) // 100 AS batch FROM ev),
        marks AS (
          SELECT batch, max(max(epoch_ms)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING
                 AND 1 PRECEDING) AS earlier FROM arrived GROUP BY batch)
        SELECT batch, event_id, epoch_ms FROM arrived JOIN marks USING (batch)
        WHERE epoch_ms <= earlier - 5000""",
    "match_conversions": f"WITH {STEPS}, {conversions(f'3 * {DAY}')} SELECT * FROM conversions",
    "match_within_bound": f"WITH {STEPS}, {conversions(DAY)} SELECT * FROM conversions",
    "match_same_item": f"""WITH {STEPS.replace('FROM parsed WINDOW', OWN_ITEMS + ' WINDOW')}, {conversions(
        f'30 * {DAY}', 'AND i1 = i2 AND i2 = i3')} SELECT * FROM conversions""",
    "match_generic_steps": f"""WITH {EVENTS}, ahead AS (
          SELECT user_id, event_type, epoch_ms, event_id AS first_event,
                 lead(event_type, 1) OVER w AS t1, lead(event_type, 2) OVER w AS t2,
                 lead(event_id, 2) OVER w AS last_event, lead(epoch_ms, 2) OVER w AS last_ms
          FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY epoch_ms, event_id))
        SELECT user_id, first_event, last_event FROM ahead
        WHERE event_type = 'view' AND t1 = 'click' AND t2 = 'purchase'
          AND last_ms - epoch_ms < 3 * {DAY}""",
    "match_dense_key": f"""WITH {EVENTS}, ahead AS (
          SELECT CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS user_id, event_type, epoch_ms,
                 event_id AS first_event,
                 lead(event_type, 1) OVER w AS t1, lead(event_type, 2) OVER w AS t2,
                 lead(event_id, 2) OVER w AS last_event, lead(epoch_ms, 2) OVER w AS last_ms
          FROM ev WINDOW w AS (
            PARTITION BY CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END ORDER BY epoch_ms, event_id))
        SELECT user_id, first_event, last_event FROM ahead
        WHERE event_type = 'view' AND t1 = 'click' AND t2 = 'purchase'
          AND last_ms - epoch_ms < 3 * {DAY}""",
    "stream_match_conversions": f"""WITH {STEPS}, {conversions(f'3 * {DAY}',
        'AND last_ms <= (SELECT max(epoch_ms) - 5000 FROM parsed)')} SELECT * FROM conversions""",
    "reconcile_conversions": f"""WITH {STEPS}, {conversions(f'3 * {DAY}')},
        doctored AS (
          SELECT "userId", "matchedSearchQuery",
                 CASE WHEN "userId" % 5 = 0 THEN "matchedItemId" + 100 ELSE "matchedItemId" END
                   AS "matchedItemId"
          FROM conversions WHERE "userId" % 3 <> 0),
        differences AS (
          SELECT *, 'missing' AS status
          FROM (SELECT * FROM conversions EXCEPT ALL SELECT * FROM doctored)
          UNION ALL
          SELECT *, 'extra' AS status
          FROM (SELECT * FROM doctored EXCEPT ALL SELECT * FROM conversions))
        SELECT "userId", "matchedSearchQuery", "matchedItemId", status, count(*) AS copies
        FROM differences GROUP BY ALL""",
    "count_item_query": f"WITH {COUNTS} SELECT item, query, n FROM counted",
    "rank_item_query": f"WITH {COUNTS} SELECT item, query, n, rn FROM ranked",
    "top5_rows": f"WITH {COUNTS} SELECT item, query, n, rn FROM ranked WHERE rn <= 5",
    "top5_queries_per_item": f"WITH {COUNTS} {TOP_LISTS}",
    "stream_top5_upserts": f"WITH {COUNTS} {TOP_LISTS}",
    "sql_pipeline": f"WITH {COUNTS} {TOP_LISTS}",
}
