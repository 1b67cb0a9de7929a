"""SQL texts of the adapters, used by the equivalents of several queries."""

EVENTS = """ev AS (
  SELECT event_id, user_id, event_type, value, props, ts,
         CAST(floor(epoch(ts)) AS BIGINT) AS timestamp,
         CAST(props->>'$.k' AS BIGINT) AS item_id
  FROM events)"""

BEHAVIOR = (
    EVENTS
    + """, behavior AS (
  SELECT event_id, user_id, item_id, item_id % 500 + 1 AS category_id,
         CASE event_type WHEN 'view' THEN 'pv' WHEN 'click' THEN 'fav'
                         WHEN 'signup' THEN 'cart' WHEN 'purchase' THEN 'buy' END AS behavior_type,
         timestamp
  FROM ev WHERE event_type IN ('view', 'click', 'signup', 'purchase'))"""
)

NOISY = (
    BEHAVIOR
    + """, noisy AS (
  SELECT user_id, item_id, category_id, behavior_type, timestamp FROM behavior
  UNION ALL
  SELECT user_id, item_id, category_id + 7, 'pv', timestamp FROM behavior
  UNION ALL
  SELECT user_id, item_id, item_id % 500 + 1, 'pv', CAST(0 AS BIGINT) FROM ev
  WHERE event_type = 'error')"""
)

WEBLOG = (
    EVENTS
    + """, weblog AS (
  SELECT event_id,
         CASE WHEN event_type = 'error' THEN 'guest-' || user_id
              WHEN user_id = 0 THEN '-1' ELSE CAST(user_id AS VARCHAR) END AS user_id,
         CASE WHEN event_type = 'view' THEN CAST(timestamp AS VARCHAR)
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS action_time,
         '  ' || upper(event_type) || ' ' AS event_type,
         CASE event_type WHEN 'signup' THEN 'not json' WHEN 'click' THEN '{"browser": "b"}'
              ELSE '{"os": "os' || (user_id % 3) || '"}' END AS device_info,
         props AS metadata
  FROM ev)"""
)

REVIEWS = """reviews AS (
  SELECT d.doc_id, d.source AS cat, d.text AS review, l.quality AS label,
         CASE l.quality WHEN 1 THEN '正面' WHEN 0 THEN '负面' END AS sentiment
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

ARRIVALS = (
    EVENTS
    + """, arrivals AS (
  SELECT event_type, CAST(floor(timestamp / 3600.0) AS BIGINT) AS hour_no,
         count(*) AS arrivals, CAST(3 AS BIGINT) AS capacity
  FROM ev GROUP BY 1, 2)"""
)


def with_(cte: str, body: str) -> str:
    """A query on the CTEs; a body that starts with a comma adds CTEs of its own."""
    return f"WITH {cte}{'' if body.startswith(',') else chr(10)}{body}"


def dedup_sql(source: str, keys: str, others: str) -> str:
    """Rows of ``source`` with row number 1 per key."""
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
        f"ORDER BY {others}) AS rn FROM {source}) WHERE rn = 1"
    )


def sessions_sql(source: str, partition: str, timeout: int) -> str:
    """``source`` with a session id; equal times cannot change it."""
    return (
        f"SELECT * EXCLUDE (brk, tie), CAST(sum(brk) OVER (PARTITION BY {partition} "
        f"ORDER BY timestamp, tie ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_id FROM ("
        f"SELECT *, CASE WHEN timestamp - lag(timestamp) OVER w > {timeout} OR lag(timestamp) "
        f"OVER w IS NULL THEN 1 ELSE 0 END AS brk, row_number() OVER w AS tie FROM {source} "
        f"WINDOW w AS (PARTITION BY {partition} ORDER BY timestamp))"
    )
