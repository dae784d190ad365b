"""DuckDB SQL for the registered queries, over the same ``events`` table."""

from __future__ import annotations

LOG = """
log AS (
  SELECT CASE WHEN event_id % 7 <> 0 THEN CAST(user_id AS VARCHAR) END AS _key,
         CASE WHEN event_id % 10 <> 0 THEN props END AS _message,
         event_type AS _topic,
         CAST(user_id % 4 AS INTEGER) AS _partition,
         CAST(row_number() OVER (PARTITION BY event_type, user_id % 4 ORDER BY event_id) - 1
              AS BIGINT) AS _offset,
         event_id
  FROM events
)"""

#: The append (of three) that holds an event.
APPENDS = """
span AS (SELECT min(event_id) AS low, max(event_id) + 1 AS high FROM events),
dated AS (
  SELECT log.*, CASE WHEN event_id < low + (high - low) // 3 THEN 0 WHEN event_id < low + (high - low) * 2 // 3 THEN 1 ELSE 2 END AS append
  FROM log, span
)"""

PARTITIONS = """
parts AS (
  SELECT _topic, _partition, min(_offset) AS earliest, max(_offset) + 1 AS latest
  FROM log GROUP BY _topic, _partition
),
subscribed AS (SELECT * FROM parts WHERE _topic IN ('click', 'view'))"""

COMMITS = """
commits AS (
  SELECT 'g_full' AS group_id, 0 AS seq, _topic, _partition, (latest - 1) // 2 AS last_offset FROM parts
  UNION ALL
  SELECT 'g_partial', 0, _topic, _partition, (latest - 1) // 2 FROM parts
  WHERE NOT (_topic = 'view' AND _partition = 3)
  UNION ALL
  SELECT 'g_rewind', 0, _topic, _partition, latest - 1 FROM parts
  UNION ALL
  SELECT 'g_rewind', 1, _topic, _partition, (latest - 1) // 2 FROM parts
),
newest AS (
  SELECT group_id, _topic, _partition, last_offset FROM (
    SELECT *, row_number() OVER (PARTITION BY group_id, _topic, _partition ORDER BY seq DESC) AS rn
    FROM commits)
  WHERE rn = 1
)"""

RECORD = "_key, _message, _topic, _partition, _offset"


def _starts(group: str, reset: str) -> str:
    column = "earliest" if reset == "smallest" else "latest"
    return f"""
starts AS (
  SELECT s._topic, s._partition,
         CASE WHEN (SELECT count(*) FROM subscribed) =
                   (SELECT count(*) FROM subscribed x JOIN newest y
                    ON x._topic = y._topic AND x._partition = y._partition AND y.group_id = '{group}')
              THEN n.last_offset + 1 ELSE s.{column} END AS next_offset
  FROM subscribed s LEFT JOIN newest n
    ON s._topic = n._topic AND s._partition = n._partition AND n.group_id = '{group}'
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _start(group: str, reset: str) -> str:
    tables = _with(LOG, PARTITIONS, COMMITS, _starts(group, reset))
    return f"{tables} SELECT _topic, _partition, next_offset FROM starts"


def _scan(group: str, reset: str, columns: str = RECORD, where: str = "true") -> str:
    return f"""{_with(LOG, PARTITIONS, COMMITS, _starts(group, reset))}
SELECT {columns} FROM log JOIN starts USING (_topic, _partition)
WHERE _offset >= next_offset AND {where}"""


def _records(where: str = "true", columns: str = RECORD) -> str:
    return f"{_with(LOG)} SELECT {columns} FROM log WHERE {where}"


PROGRESS = f"{_with(LOG)} SELECT _topic, _partition, max(_offset) AS last_offset FROM log GROUP BY ALL"

TOPIC_JSON = f"""{_with(LOG, PARTITIONS)}
SELECT _topic,
       '{{' || string_agg('"' || _partition || '":' || (latest - 1), ',' ORDER BY _partition) || '}}'
         AS offsets
FROM parts GROUP BY _topic"""

ORACLE: dict[str, str] = {
    "resume_and_decode": _scan(
        "g_full",
        "largest",
        "_topic, _partition, _offset, _key AS user_id, "
        "CAST(json_extract_string(_message, '$.k') AS BIGINT) AS k",
        "_message IS NOT NULL",
    ),
    "source_scan": _records(),
    "renamed_columns": _records(
        columns="_topic AS topic, _partition AS partition, _offset AS position, _key AS user_id"
    ),
    "topic_subset": _records("_topic IN ('click', 'view')"),
    "offset_range_filter": _records("_topic = 'click' AND _partition = 1 AND _offset >= 100"),
    "tombstones": _records("_message IS NULL", "_key, _topic, _partition, _offset"),
    "keyless_records": _records("_key IS NULL"),
    "decode_payload": _records(
        "_message IS NOT NULL",
        "_topic, _partition, _offset, CAST(json_extract_string(_message, '$.k') AS BIGINT) AS k",
    ),
    "partition_discovery": f"{_with(LOG, PARTITIONS)} SELECT * FROM parts",
    "partition_discovery_records": f"{_with(LOG, PARTITIONS)} SELECT * FROM parts",
    "start_group_full_smallest": _start("g_full", "smallest"),
    "start_group_full_largest": _start("g_full", "largest"),
    "start_group_partial_smallest": _start("g_partial", "smallest"),
    "start_group_partial_largest": _start("g_partial", "largest"),
    "start_group_none_smallest": _start("g_none", "smallest"),
    "start_group_none_largest": _start("g_none", "largest"),
    "scan_group_full": _scan("g_full", "largest"),
    "scan_group_rewind": _scan("g_rewind", "largest"),
    "scan_group_partial_smallest": _scan("g_partial", "smallest"),
    "scan_group_none_smallest": _scan("g_none", "smallest"),
    "scan_checkpoint": _scan("g_full", "largest"),
    "scan_task_ranges": f"""{_with(LOG, PARTITIONS, APPENDS).replace("WITH", "WITH RECURSIVE", 1)},
files AS (
  SELECT _topic, _partition, append, greatest(min(_offset), (any_value(latest) - 1) // 2 + 1) AS low, max(_offset) + 1 AS high
  FROM dated JOIN parts USING (_topic, _partition) GROUP BY ALL
),
pieces AS (
  SELECT _topic, _partition, append, first, least(first + 100, high) AS last,
         row_number() OVER (ORDER BY _topic, _partition, first) AS no
  FROM (SELECT *, unnest(range(low, high, 100)) AS first FROM files WHERE low < high)
),
dealt AS (
  SELECT no, CAST(0 AS BIGINT) AS task, last - first AS used FROM pieces WHERE no = 1
  UNION ALL
  SELECT p.no, CASE WHEN used + last - first > 100 THEN task + 1 ELSE task END,
         CASE WHEN used + last - first > 100 THEN last - first ELSE used + last - first END
  FROM dealt JOIN pieces AS p ON p.no = dealt.no + 1
)
SELECT task, _topic, _partition, min(first) AS start_offset, max(last) AS end_offset
FROM dealt JOIN pieces USING (no) GROUP BY task, _topic, _partition, append""",
    "missing_starts": f"""{_with(LOG, PARTITIONS)}
SELECT _topic, _partition,
       CASE WHEN _topic = 'view' THEN 'partition has no start offset'
            WHEN _partition = 0 THEN 'records before the earliest are gone'
            ELSE 'start offset lies beyond the end of the log' END AS problem
FROM parts WHERE (_topic, _partition) IN (('view', 3), ('click', 0), ('click', 1))
UNION ALL
SELECT 'click', 99, 'start offset names a partition that does not exist'""",
    "offset_gaps": f"""{_with(LOG, APPENDS)}
SELECT _topic, _partition, min(_offset) FILTER (append = 1) AS first, max(_offset) FILTER (append = 1) AS last
FROM dated GROUP BY _topic, _partition HAVING count(*) FILTER (append = 1) > 0 AND count(*) FILTER (append = 2) > 0""",
    "source_batch_filtered": _records("_topic IN ('click', 'view') AND _partition IN (1, 2) AND _offset >= 100 AND _offset < 300"),
    "append_continues": f"""{_with(LOG, APPENDS)}
SELECT _key, _message, _topic, _partition,
       CAST(row_number() OVER (PARTITION BY _topic, _partition ORDER BY append, event_id * 1000003 % 2147483647) - 1 AS BIGINT) AS _offset
FROM dated""",
    "read_progress": PROGRESS,
    "merge_offsets_idle": f"""{_with(LOG, PARTITIONS)}
SELECT _topic, _partition,
       CASE WHEN _topic = 'click' AND _partition = 2 THEN (latest - 1) // 2 ELSE latest - 1 END
         AS last_offset
FROM subscribed""",
    "offsets_json": TOPIC_JSON,
    "offsets_json_document": f"""WITH topics AS ({TOPIC_JSON})
SELECT '{{' || string_agg('"' || _topic || '":' || offsets, ',' ORDER BY _topic) || '}}' AS offsets
FROM topics""",
    "offsets_json_roundtrip": PROGRESS,
    "offsets_equality": f"""{_with(LOG, PARTITIONS, COMMITS)},
compared AS (
  SELECT 'restored' AS other, true AS same FROM parts
  UNION ALL
  SELECT 'g_full', latest - 1 = last_offset
  FROM parts JOIN newest USING (_topic, _partition) WHERE group_id = 'g_full'
)
SELECT other, count(*) AS partitions, count(*) FILTER (NOT same) AS different,
       bool_and(same) AS equal
FROM compared GROUP BY other""",
    "commit_latest": f"{_with(LOG, PARTITIONS, COMMITS)} SELECT * FROM newest",
    "group_commit": f"""{_with(LOG, PARTITIONS)}
SELECT 'readers' AS group_id, 'q1' AS query_id, CAST(0 AS BIGINT) AS batch_id, _topic, _partition,
       CASE WHEN _topic = 'click' THEN latest - 1 ELSE earliest - 1 END AS last_offset
FROM subscribed
UNION ALL
SELECT 'readers', 'q1', CAST(1 AS BIGINT), _topic, _partition, latest - 1 FROM subscribed""",
    "broker_projection": _records(),
    "broker_group_commit": f"""{_with(LOG, PARTITIONS)}
SELECT _topic, _partition, (latest - 1) // 2 + 1 AS first, latest - 1 - (latest - 1) // 2 AS records, latest - 1 AS last_offset
FROM subscribed""",
    "stream_available_now": _records(),
    "stream_resume": _records(),
    "scan_stream_checkpoint": f"{_with(LOG, APPENDS)} SELECT {RECORD} FROM dated WHERE append > 0",
    "stream_native_growing": _records(),
    "stream_native": _records("_topic IN ('click', 'view')"),
    "stream_native_commit": f"""{_with(LOG, PARTITIONS)}
SELECT _topic, _partition, latest - 1 AS last_offset FROM subscribed""",
}
