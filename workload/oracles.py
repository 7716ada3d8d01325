"""The registered queries as plain SQL over the given tables."""

from __future__ import annotations

from workload.views import BULK_SQL_VIEWS, PRIOR_NAME, SQL_VIEWS


def _sql(body: str, views: str = SQL_VIEWS) -> str:
    return f"WITH {views.strip()}\n{body.strip()}"


_ALL = "uid, tbl, k, version, last_ts, deleted, CAST(0 AS INTEGER) AS encoding, content, poll_date"
_NOT_CHANGED = "NOT EXISTS (SELECT 1 FROM latest l WHERE l.tbl = p.tbl AND l.k = p.k)"
_NEWEST = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tbl, k
              ORDER BY version DESC, last_ts DESC, uid DESC) AS rn FROM changes) WHERE rn = 1)"""
_ORIGIN = "CASE WHEN p.tbl IN (SELECT tbl FROM merged_tables) THEN 'prior' ELSE 'copy' END"


def _merge(origin: str, views: str = SQL_VIEWS) -> str:
    return _sql(
        f"""
        SELECT tbl, k, content AS value, 'update' AS origin FROM latest WHERE NOT deleted
        UNION ALL
        SELECT p.tbl, p.k, p.value, {origin} AS origin FROM prior p
        WHERE p.tbl IN (SELECT tbl FROM live) AND {_NOT_CHANGED}
        """,
        views,
    )


_GENERATED = _sql(
    f"""
    SELECT tbl, k, props AS body FROM latest WHERE NOT deleted
    UNION ALL
    SELECT p.tbl, p.k, p.value AS body FROM prior p WHERE p.tbl IN (SELECT tbl FROM live) AND {_NOT_CHANGED}
    """
)

_BULK_ORIGIN = (
    "CASE WHEN p.tbl IN (SELECT tbl FROM win WHERE tbl IN (SELECT tbl FROM live)) THEN 'prior' ELSE 'copy' END"
)

_REPEATED = """SELECT 't' || (o_custkey % 8) AS tbl, CAST(o_custkey AS VARCHAR) AS k, o_orderpriority AS file,
  o_orderkey AS line, 'order ' || o_orderkey AS value FROM orders"""

_DOCUMENT = """'{"about":{"~id":"inner","~table":"inner","~version":-1},"~deleted":' || CAST(deleted AS VARCHAR)
  || ',"~id":"' || k || '","~lastUpdateAt":"' || stamp || '","~table":"' || tbl || '","~version":' || version
  || ',"body":"' || replace(props, '"', '\\"') || '"}'"""


def _uuid(text: str) -> str:
    digest = f"md5({text})"
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return " || '-' || ".join(f"substr({digest}, {at}, {size})" for at, size in cuts)


def _sized(*columns: str) -> str:
    return " || ".join(f"length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR)" for c in columns)


_SHARD = "'shard:' || (c_custkey // 500)"
_SHARD_LINES = f"""SELECT {_SHARD} AS tbl, c_name AS value,
  CAST(row_number() OVER (PARTITION BY c_custkey // 500 ORDER BY c_custkey) AS INTEGER) AS line FROM customer"""

_CUSTOMER_DOCUMENTS = "'t' || (c_custkey % 8) AS tbl, CAST(c_custkey AS VARCHAR) AS k"

ORACLES = {
    "scan_changes": _sql(f"SELECT {_ALL} FROM changes"),
    "live_tables_text": _sql("SELECT tbl FROM live"),
    "live_tables_catalog": "SELECT 'c' || c_custkey AS tbl FROM customer WHERE c_custkey % 5 IN (0, 4)",
    "latest_snapshot": """SELECT 'nation:' || s_nationkey AS tbl, count(*) AS documents, '2024-01-20-00-00-00' AS name
        FROM supplier GROUP BY 1""",
    "publish_snapshot": f"SELECT {_CUSTOMER_DOCUMENTS}, '{PRIOR_NAME}' AS name FROM customer",
    "snapshot_files": f"SELECT {_SHARD} AS tbl, CAST(1 AS BIGINT) AS files, true AS filled FROM customer GROUP BY 1",
    "snapshot_file_count": "SELECT count(DISTINCT c_custkey // 500) AS files FROM customer",
    "scan_snapshot_lines": _SHARD_LINES,
    "scan_snapshot_keys": "SELECT 'doc:' || lang AS tbl, CAST(doc_id AS VARCHAR) AS k, md5(text) AS text_md5 FROM documents",
    "filter_condition": _sql(
        "SELECT tbl, k, version, last_ts FROM changes WHERE version >= 10 AND NOT deleted AND tbl <> 't2'"
    ),
    "append_change_log": _sql("SELECT poll_date, tbl, k, uid, content FROM changes"),
    "write_snapshot": f"SELECT {_CUSTOMER_DOCUMENTS}, c_name AS body FROM customer",
    "copy_unmodified": _sql(
        """SELECT tbl, k, value AS body FROM prior
           WHERE tbl IN (SELECT tbl FROM live) AND tbl NOT IN (SELECT tbl FROM win)"""
    ),
    "dropped_tables": _sql("SELECT DISTINCT tbl FROM win WHERE tbl NOT IN (SELECT tbl FROM live) ORDER BY tbl"),
    "window_changes": _sql(f"SELECT {_ALL} FROM win"),
    "updated_tables": _sql("SELECT DISTINCT tbl FROM win"),
    "latest_change_ids": _sql("SELECT tbl, k, version, uid FROM latest"),
    "change_payloads": _sql("SELECT tbl, k, uid, content FROM latest"),
    "drop_tombstones": _sql("SELECT tbl, k, uid, content FROM latest WHERE NOT deleted"),
    "table_status": _sql(
        """SELECT tbl, bool_or(l) AS live, bool_or(u) AS updated,
             CASE WHEN NOT bool_or(l) THEN 'drop' WHEN bool_or(u) THEN 'merge' ELSE 'copy' END AS action
           FROM (SELECT tbl, true AS l, false AS u FROM live UNION ALL SELECT DISTINCT tbl, false, true FROM win)
           GROUP BY tbl"""
    ),
    "table_status_flags": _sql(
        """SELECT tbl, bit_or(status) AS status
           FROM (SELECT tbl, 1 AS status FROM live UNION ALL SELECT DISTINCT tbl, 2 FROM win) GROUP BY tbl"""
    ),
    "unmodified_tables": _sql("SELECT tbl FROM live WHERE tbl NOT IN (SELECT tbl FROM win)"),
    "to_change_rows": _sql(
        f"""SELECT {_uuid(_sized("tbl", "k", "version", "last_ts", "deleted", "doc"))} AS uid, tbl, k, version, last_ts,
              deleted, CAST(0 AS INTEGER) AS encoding, CASE WHEN NOT deleted THEN doc END AS content, poll_date
            FROM (SELECT *, {_DOCUMENT} AS doc FROM (
              SELECT c.*, strftime(make_timestamp(last_ts * 1000), '%Y-%m-%dT%H:%M:%S.%gZ') AS stamp FROM changes c))"""
    ),
    "all_documents": _sql(
        """SELECT coalesce(l.tbl, p.tbl) AS tbl, coalesce(l.k, p.k) AS k, l.k IS NOT NULL AS has_change,
             p.k IS NOT NULL AS has_prior, l.uid, l.deleted, p.value
           FROM latest l FULL JOIN prior p ON l.tbl = p.tbl AND l.k = p.k"""
    ),
    "split_changed": _sql("SELECT tbl, k, uid FROM latest"),
    "split_unchanged": _sql(f"SELECT p.tbl, p.k, p.value FROM prior p WHERE {_NOT_CHANGED}"),
    "unchanged_documents": _sql(f"SELECT p.tbl, p.k, p.value FROM prior p WHERE {_NOT_CHANGED}"),
    "changes_of_live_tables": _sql("SELECT tbl, k, uid FROM win WHERE tbl IN (SELECT tbl FROM live)"),
    "fetch_by_location": f"SELECT * FROM ({_SHARD_LINES}) WHERE line % 7 = 0",
    "merge_counts": _sql(
        f"""SELECT (SELECT count(*) FROM latest) AS changed,
              (SELECT count(*) FROM prior p WHERE {_NOT_CHANGED}) AS carried"""
    ),
    "merge_snapshot": _merge(_ORIGIN),
    "merge_snapshot_late": _merge(_ORIGIN),
    "merge_all_live": _merge("'prior'"),
    "merge_partitioned_log": _merge(_ORIGIN),
    "merge_bulk": _merge(_BULK_ORIGIN, BULK_SQL_VIEWS),
    "merge_bulk_late": _merge(_BULK_ORIGIN, BULK_SQL_VIEWS),
    "merge_repeated_prior": _sql(
        f"""SELECT tbl, k, content AS value, 'update' AS origin FROM latest WHERE NOT deleted
            UNION ALL
            SELECT tbl, k, value, 'prior' AS origin FROM (
              SELECT *, row_number() OVER (PARTITION BY tbl, k ORDER BY file, line) AS n FROM ({_REPEATED})) p
            WHERE n = 1 AND tbl IN (SELECT tbl FROM merged_tables) AND {_NOT_CHANGED}
            UNION ALL
            SELECT tbl, k, value, 'copy' AS origin FROM ({_REPEATED})
            WHERE tbl IN (SELECT tbl FROM live) AND tbl NOT IN (SELECT tbl FROM merged_tables)"""
    ),
    "generate_snapshot": _GENERATED,
    "generate_snapshot_by_shuffle": _GENERATED,
    "generate_snapshot_all_live": _GENERATED,
    "generate_snapshot_plain_names": _GENERATED,
    "dedup_batch": _sql(f"SELECT tbl, k, uid, version, content FROM {_NEWEST}"),
    "latest_changes": _sql(f"SELECT {_ALL} FROM latest"),
    "latest_changes_bulk": _sql("SELECT tbl, k, uid FROM latest", BULK_SQL_VIEWS),
    "newest_turn": """SELECT role AS tbl, CAST(conv_id AS VARCHAR) AS k, turn AS version, md5(text) AS text_md5
        FROM (SELECT *, row_number() OVER (PARTITION BY role, conv_id ORDER BY turn DESC) AS rn FROM conversations)
        WHERE rn = 1""",
    "dedup_snapshot": f"""SELECT tbl, k, file, line, value FROM (
        SELECT *, row_number() OVER (PARTITION BY tbl, k ORDER BY file, line) AS rn FROM ({_REPEATED})) WHERE rn = 1""",
    "repeated_documents": f"SELECT tbl, k FROM ({_REPEATED}) GROUP BY tbl, k HAVING count(*) > 1",
    "sort_changes": _sql("SELECT tbl, k, uid FROM changes ORDER BY tbl, k"),
    "snapshot_file_plan": f"""SELECT tbl, count(*) AS documents, (count(*) + 99) // 100 AS files
        FROM ({_REPEATED}) GROUP BY tbl""",
    "snapshot_ranges": f"""SELECT tbl, file_number, min(k) AS first_key, max(k) AS last_key, count(*) AS documents FROM (
        SELECT tbl, k, (row_number() OVER (PARTITION BY tbl ORDER BY k) - 1) * ((count(*) OVER (PARTITION BY tbl) + 199) // 200)
          // count(*) OVER (PARTITION BY tbl) AS file_number
        FROM (SELECT {_CUSTOMER_DOCUMENTS} FROM customer)) GROUP BY tbl, file_number""",
    "range_files": """SELECT lang AS tbl, CAST(doc_id AS VARCHAR) AS k,
        (row_number() OVER (PARTITION BY lang ORDER BY CAST(doc_id AS VARCHAR)) - 1) * ((count(*) OVER (PARTITION BY lang) + 99) // 100)
          // count(*) OVER (PARTITION BY lang) AS file_number FROM documents""",
    "balanced_files": """SELECT count(*) AS files, CAST(coalesce(sum(n_chars), 0) AS BIGINT) AS bytes, TRUE AS bytes_fit, TRUE AS files_fit
        FROM documents""",
    "union_changes": _sql(f"SELECT tbl, k, uid FROM {_NEWEST}"),
    "union_tables": _sql(
        """SELECT tbl FROM live UNION ALL SELECT tbl FROM live
           UNION ALL SELECT DISTINCT 'o' || (o_orderkey % 18) FROM orders WHERE o_orderkey % 18 <> 3"""
    ),
    "encode_table_name": "SELECT page_id, replace(url, ':', '~') AS encoded FROM pages",
    "decode_table_name": "SELECT page_id, replace(replace(url, '/', '~'), '~', ':') AS decoded FROM pages",
    "extract_intrinsics": """SELECT event_id, 't' || (user_id % 6) AS tbl, CAST(user_id AS VARCHAR) AS k,
        CAST(day(ts) AS BIGINT) AS version, epoch_us(ts) // 1000 AS last_ts, event_id % 10 = 0 AS deleted FROM events""",
    "iso_to_millis": """SELECT event_id, CASE event_id % 5 WHEN 3 THEN NULL
        WHEN 4 THEN epoch_us(date_trunc('minute', ts)) // 1000 ELSE epoch_us(ts) // 1000 END AS millis FROM events""",
    "invalid_documents": "SELECT event_id FROM events WHERE event_id % 6 IN (1, 2, 4, 5)",
    "poll_date": "SELECT event_id, strftime(ts, '%Y%m%d') AS poll_date FROM events",
    "poll_dates": """SELECT user_id, strftime(d, '%Y%m%d') AS poll_date FROM (
        SELECT user_id, unnest(generate_series(date_trunc('day', min(ts)),
          date_trunc('day', max(ts)) - INTERVAL 1 MICROSECOND, INTERVAL 1 DAY)) AS d
        FROM events GROUP BY user_id)""",
    "snapshot_name": """SELECT event_id, strftime(ts, '%Y-%m-%d-%H-%M-%S') AS name,
        epoch_us(date_trunc('second', ts)) // 1000000 AS seconds FROM events""",
    "file_suffix": "SELECT doc_id, md5(text) AS suffix FROM documents",
    "update_id": _sql(f"SELECT uid, {_uuid(_sized('tbl', 'k', 'version', 'last_ts'))} AS id FROM changes"),
    "text_payload": "SELECT doc_id, CAST(strlen(text) AS BIGINT) AS bytes, md5(text) AS text_md5 FROM documents",
    "decode_payloads": "SELECT doc_id, md5(text) AS text_md5 FROM documents",
    "parse_envelopes": "SELECT 'e' || event_id AS event_key, props AS body, 'inner' AS about FROM events",
    "stream_ingest": _sql(
        f"SELECT tbl, k, version, last_ts, deleted, CASE WHEN NOT deleted THEN props END AS body FROM {_NEWEST}"
    ),
    "union_streams": _sql(f"SELECT tbl, k, version, props AS body FROM {_NEWEST} WHERE tbl <> 't1' AND NOT deleted"),
    "stream_dedup": _sql(f"SELECT tbl, k, version, last_ts, deleted FROM {_NEWEST}"),
    "stream_replay": _sql(f"SELECT tbl, k, version, last_ts, CAST(1 AS BIGINT) AS times FROM {_NEWEST}"),
    "bad_pages": """SELECT true AS readable, 'e' || event_id AS name FROM events WHERE (event_id // 50) % 10 <> 0
        UNION ALL SELECT DISTINCT false AS readable, 'page ' || (event_id // 50) AS name FROM events WHERE (event_id // 50) % 10 = 0""",
    "stream_quarantine": _sql(
        """SELECT DISTINCT 'unreadable page' AS outcome, 'page ' || (event_id // 50) AS name, '' AS body FROM events WHERE (event_id // 50) % 10 = 0
           UNION ALL
           SELECT 'lacks ~deleted' AS outcome, 'e' || event_id AS name, props AS body FROM events WHERE (event_id // 50) % 10 <> 0 AND event_id % 10 = 0
           UNION ALL
           SELECT 'stored' AS outcome, tbl || '/' || k || '/' || version AS name, props AS body FROM (
             SELECT *, row_number() OVER (PARTITION BY tbl, k ORDER BY version DESC, last_ts DESC, uid DESC) AS rn
             FROM changes WHERE (CAST(substr(uid, 2) AS BIGINT) // 50) % 10 <> 0 AND NOT deleted) WHERE rn = 1"""
    ),
    "generate_new_tables": _sql(
        """SELECT tbl, k, props AS body FROM latest WHERE NOT deleted
           UNION ALL
           SELECT 'nation:' || s_nationkey AS tbl, CAST(s_suppkey AS VARCHAR) AS k, s_name AS body FROM supplier"""
    ),
    "generate_hidden_names": """SELECT CASE WHEN c_custkey % 3 = 0 THEN '.' || (c_custkey % 6) ELSE '__system:' || (c_custkey % 4) END AS tbl,
        CAST(c_custkey AS VARCHAR) AS k,
        CASE WHEN c_custkey % 5 = 0 THEN replace(c_name, 'Customer', 'Changed') ELSE c_name END AS body FROM customer""",
}
