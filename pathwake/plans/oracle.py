"""The registered queries as SQL on the same tables, for checking results."""

from __future__ import annotations

MS = "(epoch_us(ts) // 1000)"
K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

# Shared views, by name; each may use the ones before it.
VIEWS = {
    "all_events": f"""
        SELECT {MS} AS timestamp, user_id AS visitor_id,
               CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'addtocart'
                    WHEN 'purchase' THEN 'transaction' ELSE event_type END AS event,
               {K} AS item_id,
               CASE WHEN event_type = 'purchase' THEN event_id END AS transaction_id,
               event_id AS seq, event_type
        FROM events""",
    "clicks": """
        SELECT * EXCLUDE (event_type) FROM all_events
        WHERE event_type IN ('view', 'click', 'purchase')""",
    "copies": """
        SELECT * FROM clicks UNION ALL
        SELECT timestamp, visitor_id, event, item_id, -1, seq + 1000000000000
        FROM clicks WHERE seq % 10 = 0""",
    "first_copies": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY visitor_id, timestamp, event, item_id ORDER BY seq) AS rn
            FROM copies) WHERE rn = 1""",
    "lag_samples": f"""
        SELECT event_type AS group_id, user_id % 3 AS instance,
               ({MS} // 3600000) * 3600 AS ts, user_id % 3 AS part,
               CAST(floor(value * 10) AS BIGINT) AS lag, event_id AS seq FROM events""",
    "part_lags": """
        SELECT group_id, ts, part, arg_max(lag, seq) AS lag FROM lag_samples
        GROUP BY group_id, ts, part""",
    "total_lags": """
        SELECT group_id, ts, CAST(sum(lag) AS BIGINT) AS total FROM part_lags
        GROUP BY group_id, ts""",
    "batch_metrics": f"""
        SELECT event_type AS group_id, user_id % 3 AS instance, event_id AS batch_id,
               {MS} AS end_ms, {K} + 1 AS batch_size, CAST(100 AS BIGINT) AS max_batch_size,
               value AS pg_events_ms, CAST({K} AS DOUBLE) AS valkey_ms,
               value / 2 AS pg_sessions_ms, CAST({K} * 10 AS DOUBLE) AS poll_ms,
               value / 10 AS commit_ms FROM events""",
    "loops": """
        SELECT *, batch_size / max_batch_size AS fill,
               pg_events_ms + valkey_ms + pg_sessions_ms AS stage_ms,
               poll_ms + (pg_events_ms + valkey_ms + pg_sessions_ms) + commit_ms AS loop_ms
        FROM batch_metrics""",
    "gaps": """
        SELECT *, coalesce((end_ms - loop_ms) - lag(end_ms) OVER (
                   PARTITION BY group_id, instance ORDER BY batch_id), 0) AS idle_ms,
               row_number() OVER (PARTITION BY group_id, instance ORDER BY batch_id) AS x
        FROM loops""",
    "slopes": """
        SELECT *,
            CASE WHEN count(*) OVER w < 2 THEN 0 ELSE regr_slope(pg_events_ms, x) OVER w END
                AS pg_events_slope,
            CASE WHEN count(*) OVER w < 2 THEN 0 ELSE regr_slope(valkey_ms, x) OVER w END
                AS valkey_slope,
            CASE WHEN count(*) OVER w < 2 THEN 0 ELSE regr_slope(pg_sessions_ms, x) OVER w END
                AS pg_sessions_slope
        FROM gaps WINDOW w AS (PARTITION BY group_id, instance ORDER BY batch_id
                               ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)""",
    "indicators": """
        SELECT p.*, coalesce(n, 0) AS rebalance_count FROM (
            SELECT group_id, instance, end_ms // 86400000 AS period, count(*) AS loops,
                   avg(fill) AS fill_ratio, max(loop_ms / 1000.0) AS poll_proximity,
                   avg(idle_ms) AS idle_ms,
                   arg_max(bottleneck, batch_id) FILTER (WHERE bottleneck IS NOT NULL)
                       AS any_bottleneck,
                   max(batch_id) AS last_batch, (end_ms // 86400000 + 1) * 86400 AS ts
            FROM (SELECT *, CASE
                      WHEN greatest(pg_events_slope, valkey_slope, pg_sessions_slope) <= 0.5
                          THEN NULL
                      WHEN pg_events_slope >= valkey_slope
                          AND pg_events_slope >= pg_sessions_slope THEN 'pg_events'
                      WHEN valkey_slope >= pg_sessions_slope THEN 'valkey'
                      ELSE 'pg_sessions' END AS bottleneck FROM slopes)
            GROUP BY group_id, instance, end_ms // 86400000) p
        LEFT JOIN (
            SELECT CASE e.user_id % 2 WHEN 0 THEN 'view' ELSE 'purchase' END AS group_id,
                e.user_id % 3 AS instance, t.ts, count(*) AS n
            FROM events e JOIN (SELECT DISTINCT (end_ms // 86400000 + 1) * 86400 AS ts
                                FROM batch_metrics) t
              ON epoch_us(e.ts) // 1000000 BETWEEN t.ts - 300 AND t.ts
            WHERE e.event_type = 'error' GROUP BY 1, 2, 3) r
          ON r.group_id = p.group_id AND r.instance = p.instance AND r.ts = p.ts""",
    "named_indicators": """
        SELECT i.* EXCLUDE (any_bottleneck, last_batch), CASE
                   WHEN greatest(pg_events_slope, valkey_slope, pg_sessions_slope) <= 0.5
                       THEN NULL
                   WHEN pg_events_slope >= valkey_slope
                       AND pg_events_slope >= pg_sessions_slope THEN 'pg_events'
                   WHEN valkey_slope >= pg_sessions_slope THEN 'valkey'
                   ELSE 'pg_sessions' END AS bottleneck_stage
        FROM indicators i JOIN slopes s ON s.group_id = i.group_id
             AND s.instance = i.instance AND s.batch_id = i.last_batch""",
    "backpressure": """
        SELECT group_id, max(fill_ratio) AS fill_ratio, max(poll_proximity) AS poll_proximity,
               min(idle_ms) AS idle_ms, CAST(sum(rebalance_count) AS BIGINT) AS rebalance_count,
               max(CASE WHEN rank = 1 THEN bottleneck_stage END) AS bottleneck_stage,
               count(*) AS instance_count, max(ts) AS ts
        FROM (SELECT *, row_number() OVER (PARTITION BY group_id
                      ORDER BY poll_proximity DESC, instance) AS rank
              FROM (SELECT *, row_number() OVER (PARTITION BY group_id, instance
                                                 ORDER BY ts DESC) AS age
                    FROM named_indicators) WHERE age = 1)
        GROUP BY group_id""",
    "tail_slopes": """
        SELECT group_id, instance, stage, stage_order, coalesce(regr_slope(ms, x), 0) AS slope,
               arg_min(ms, x) AS first_ms, arg_max(ms, x) AS last_ms
        FROM (SELECT group_id, instance, x, unnest([0, 1, 2]) AS stage_order,
                     unnest(['pg_events', 'valkey', 'pg_sessions']) AS stage,
                     unnest([pg_events_ms, valkey_ms, pg_sessions_ms]) AS ms
              FROM (SELECT *, max(x) OVER (PARTITION BY group_id, instance) AS newest FROM gaps)
              WHERE x > newest - 100)
        GROUP BY group_id, instance, stage, stage_order""",
    "committed": """
        SELECT o_orderpriority AS topic, o_custkey % 4 AS part,
               CASE WHEN o_custkey % 4 = 3 THEN CAST(-1 AS BIGINT) ELSE max(o_orderkey) END
                   AS committed
        FROM orders GROUP BY 1, 2, o_custkey % 4""",
    "ends": """
        SELECT o.o_orderpriority AS topic, o.o_custkey % 4 AS part,
               max(l.l_orderkey) + CAST(sum(l.l_linenumber) % 7 AS BIGINT) AS end_offset
        FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2""",
    "ramp": f"""
        SELECT event_type AS run_id, {MS} AS ts_ms, 1 + {K} % 5 AS step,
               (1 + {K} % 5) * 1000 AS rate_target,
               CAST(floor(value * 10) AS BIGINT) AS consumer_throughput,
               {K} * 100 AS total_lag,
               CASE user_id % 3 WHEN 0 THEN 'stable' WHEN 1 THEN 'growing' ELSE 'shrinking' END
                   AS lag_trend,
               event_id AS seq FROM events""",
    "trends": """
        SELECT run_id, step, lag_trend, count(*) AS n, min(seq) AS first_seq
        FROM ramp GROUP BY run_id, step, lag_trend""",
    "dominant": """
        SELECT run_id, step, lag_trend AS dominant_trend FROM (
            SELECT *, row_number() OVER (PARTITION BY run_id, step
                                         ORDER BY n DESC, first_seq) AS rank FROM trends)
        WHERE rank = 1""",
    "steps": """
        SELECT r.run_id, r.step, arg_min(rate_target, seq) AS rate_target,
               CAST(sum(consumer_throughput) // count(*) AS BIGINT) AS avg_throughput,
               arg_max(total_lag, seq) AS final_lag, max(d.dominant_trend) AS dominant_trend,
               count(*) AS samples
        FROM ramp r JOIN dominant d ON d.run_id = r.run_id AND d.step = r.step
        GROUP BY r.run_id, r.step""",
    "polls": f"""
        SELECT event_type AS run_id, {MS} AS ts_ms, 1 + {K} % 5 AS step,
               CASE WHEN {K} = 0 THEN -1 ELSE event_id - event_id % 2000 END AS count,
               event_id AS seq FROM events""",
    "known": """
        SELECT *, coalesce(last_value(CASE WHEN count <> -1 THEN count END IGNORE NULLS) OVER w,
                           0) AS known
        FROM polls WINDOW w AS (PARTITION BY run_id ORDER BY step, ts_ms, seq
                                ROWS UNBOUNDED PRECEDING)""",
    "moves": """
        SELECT *, coalesce(lag(known) OVER w, 0) AS before, lag(step) OVER w AS step_before
        FROM known WINDOW w AS (PARTITION BY run_id ORDER BY step, ts_ms, seq)""",
    "runs": f"""
        SELECT {MS} AS ts_ms, CASE user_id % 2 WHEN 0 THEN 'local' ELSE 'cloud' END
                   AS environment,
               event_type AS impl, 1 + user_id % 4 AS partitions, {K} * 100 AS events_consumed,
               1 + {K} AS duration_sec, CAST(floor(value * 100) AS BIGINT) AS throughput
        FROM events""",
    "raw_text": """
        SELECT CASE WHEN seq % 11 = 0 THEN 'later' ELSE CAST(timestamp AS VARCHAR) END
                   AS timestamp,
               CASE WHEN seq % 13 = 0 THEN NULL ELSE CAST(visitor_id AS VARCHAR) END
                   AS visitor_id,
               event,
               CASE WHEN seq % 17 = 0 THEN 'x7' ELSE CAST(item_id AS VARCHAR) END AS item_id,
               CASE WHEN seq % 19 = 0 THEN '?' ELSE CAST(transaction_id AS VARCHAR) END
                   AS transaction_id,
               seq
        FROM all_events""",
    "checked": """
        SELECT *, concat_ws(',',
            CASE WHEN TRY_CAST(timestamp AS BIGINT) IS NULL THEN 'timestamp' END,
            CASE WHEN TRY_CAST(visitor_id AS BIGINT) IS NULL THEN 'visitor_id' END,
            CASE WHEN event NOT IN ('view', 'addtocart', 'transaction') THEN 'event' END,
            CASE WHEN TRY_CAST(item_id AS BIGINT) IS NULL THEN 'item_id' END,
            CASE WHEN transaction_id IS NOT NULL AND TRY_CAST(transaction_id AS BIGINT) IS NULL
                 THEN 'transaction_id' END) AS reasons
        FROM raw_text""",
}


def _with(*names: str) -> str:
    return "WITH " + ", ".join(f"{name} AS ({VIEWS[name]})" for name in names)


def sessions_views(source: str, timeout_ms: int, name: str = "sessions") -> str:
    """Views ending in ``name``: sessions of ``source`` in the state layout, lists as text."""

    def counted(kind: str) -> str:
        return f"count(*) FILTER (WHERE event = '{kind}')"

    def listed(kind: str) -> str:
        return (
            "coalesce(string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY first_at) "
            f"FILTER (WHERE event = '{kind}'), '')"
        )

    return f"""
        {name}_gaps AS (SELECT *, timestamp - lag(timestamp) OVER (
                PARTITION BY visitor_id ORDER BY timestamp, seq) AS gap FROM {source}),
        {name}_rows AS (SELECT *,
                1 + sum(CASE WHEN gap > {timeout_ms} THEN 1 ELSE 0 END) OVER w AS session_num,
                row_number() OVER w AS pos
            FROM {name}_gaps WINDOW w AS (PARTITION BY visitor_id ORDER BY timestamp, seq
                                          ROWS UNBOUNDED PRECEDING)),
        {name}_lists AS (SELECT visitor_id, session_num, {listed('view')} AS items_viewed,
                {listed('addtocart')} AS items_carted, {listed('transaction')} AS items_purchased
            FROM (SELECT visitor_id, session_num, event, item_id, min(pos) AS first_at
                  FROM {name}_rows GROUP BY visitor_id, session_num, event, item_id)
            GROUP BY visitor_id, session_num),
        {name} AS (SELECT r.visitor_id || '_' || r.session_num AS session_id, r.visitor_id,
                CAST(r.session_num AS BIGINT) AS session_num, min(timestamp) AS session_start,
                max(timestamp) AS session_end, count(*) AS event_count,
                {counted('view')} AS view_count, {counted('addtocart')} AS cart_count,
                {counted('transaction')} AS transaction_count,
                any_value(items_viewed) AS items_viewed, any_value(items_carted) AS items_carted,
                any_value(items_purchased) AS items_purchased
            FROM {name}_rows r JOIN {name}_lists l
              ON l.visitor_id = r.visitor_id AND l.session_num = r.session_num
            GROUP BY r.visitor_id, r.session_num)"""


_RECORD = """session_id, visitor_id, make_timestamp(session_start * 1000) AS session_start,
    make_timestamp(session_end * 1000) AS session_end,
    (session_end - session_start) // 1000 AS duration_seconds, event_count, view_count,
    cart_count, transaction_count, items_viewed, items_carted, items_purchased,
    transaction_count > 0 AS converted"""


def _sessions(source: str, timeout_ms: int, *views: str) -> str:
    return f"{_with(*views)}, {sessions_views(source, timeout_ms)} SELECT {_RECORD} FROM sessions"


def _funnel(timeout_ms: int) -> str:
    return f"""{_with('all_events', 'clicks')}, {sessions_views('clicks', timeout_ms)},
        newest AS (SELECT max(session_start) AS m FROM sessions),
        windows AS (SELECT unnest(['all_time', 'last_day', 'last_month']) AS time_window,
                           unnest([NULL, 86400000, 2592000000]) AS width),
        totals AS (SELECT time_window,
            count(*) FILTER (WHERE inside) AS sessions,
            count(*) FILTER (WHERE inside AND cart_count > 0) AS cart_sessions,
            count(*) FILTER (WHERE inside AND transaction_count > 0) AS purchase_sessions,
            CAST(coalesce(sum(transaction_count) FILTER (WHERE inside), 0) AS BIGINT)
                AS total_purchases
            FROM (SELECT *, width IS NULL OR session_start > m - width AS inside
                  FROM windows, newest, sessions) GROUP BY time_window)
        SELECT *,
            CASE WHEN sessions > 0 THEN purchase_sessions / sessions * 100 ELSE 0 END
                AS conversion_rate,
            CASE WHEN cart_sessions > 0
                THEN (cart_sessions - purchase_sessions) / cart_sessions * 100 ELSE 0 END
                AS cart_abandonment,
            CASE WHEN purchase_sessions > 0 THEN total_purchases / purchase_sessions ELSE 0 END
                AS avg_items_per_purchase
        FROM totals"""


def _class(samples: str, spread: str, slope: str, mean: str) -> str:
    direction = f"CASE WHEN {slope} > 0 THEN 'growing' ELSE 'shrinking' END"
    return f"""CASE WHEN {samples} < 2 OR NOT ({spread}) THEN 'unknown'
        WHEN {mean} = 0 THEN CASE WHEN abs({slope}) < 1 THEN 'stable' ELSE {direction} END
        WHEN abs({slope}) / {mean} < 0.01 THEN 'stable' ELSE {direction} END"""


def _trend(seconds: int) -> str:
    return f"""SELECT group_id, count(*) AS samples,
        {_class('count(*)', 'max(ts) > min(ts)', 'regr_slope(total, ts)', 'avg(total)')} AS trend
        FROM total_lags WHERE ts >= (SELECT max(ts) FROM lag_samples) - {seconds}
        GROUP BY group_id"""


_LABELS = """CASE WHEN fill_ratio >= 0.95 THEN 'saturated' WHEN fill_ratio >= 0.80 THEN 'high'
             WHEN fill_ratio IS NOT NULL THEN 'normal' END AS fill_status,
        CASE WHEN poll_proximity > 0.9 THEN 'critical' WHEN poll_proximity > 0.7 THEN 'warning'
             WHEN poll_proximity IS NOT NULL THEN 'healthy' END AS proximity_status,
        CASE WHEN idle_ms < 5 THEN 'minimal headroom' WHEN idle_ms < 50 THEN 'low headroom'
             WHEN idle_ms IS NOT NULL THEN 'healthy' END AS idle_status"""

_ISO = """strftime(make_timestamp(timestamp * 1000), '%Y-%m-%dT%H:%M:%S') ||
    CASE WHEN timestamp % 1000 = 0 THEN ''
         ELSE '.' || lpad(CAST(timestamp % 1000 AS VARCHAR), 3, '0') || '000' END || '+00:00'"""

_LOOP_VIEWS = ("batch_metrics", "loops", "gaps")
_INDICATOR_VIEWS = (*_LOOP_VIEWS, "slopes", "indicators", "named_indicators")
_CLICKS = ("all_events", "clicks")
_COPIES = (*_CLICKS, "copies", "first_copies")
_LAGS = ("lag_samples", "part_lags", "total_lags")
_STEPS = ("ramp", "trends", "dominant", "steps")

_SUMMARY = """count(*) AS batches, CAST(sum(batch_size) AS BIGINT) AS events,
    round(avg(stage_ms), 9) AS avg_batch_ms, round(avg(pg_events_ms), 9) AS avg_pg_events_ms,
    round(avg(valkey_ms), 9) AS avg_valkey_ms, round(avg(pg_sessions_ms), 9)
        AS avg_pg_sessions_ms,
    round(avg(poll_ms), 9) AS avg_poll_ms, round(avg(commit_ms), 9) AS avg_commit_ms,
    round(avg(idle_ms), 4) AS avg_idle_ms, round(avg(fill), 9) AS avg_fill,
    round(CASE WHEN avg(poll_ms) + avg(commit_ms) + avg(idle_ms) > 0
        THEN avg(idle_ms) / (avg(poll_ms) + avg(commit_ms) + avg(idle_ms)) * 100 ELSE 0 END, 6)
        AS headroom"""

SPLIT_MS = 1_705_406_400_000  # 2024-01-16 12:00:00
STREAM_EVENTS = f"{_with(*_CLICKS)} SELECT timestamp, visitor_id, event, item_id FROM clicks"


def oracle_sql() -> dict[str, str]:
    sql = {}
    sql["normalize_events"] = f"""{_with(*_CLICKS)}
        SELECT timestamp, visitor_id, event, item_id, nullif(transaction_id, 0) AS transaction_id,
               make_timestamp(timestamp * 1000) AS event_time, seq FROM clicks"""
    sql["scan_events_csv"] = f"""{_with(*_CLICKS)}
        SELECT timestamp, visitor_id, event, item_id, nullif(transaction_id, 0) AS transaction_id,
               make_timestamp(timestamp * 1000) AS event_time FROM clicks"""
    sql["validate_events"] = f"""{_with('all_events', 'raw_text', 'checked')}
        SELECT seq, event, reasons, reasons = '' AS is_valid FROM checked"""
    sql["split_valid_rejected"] = f"""{_with('all_events', 'raw_text', 'checked')}
        SELECT seq, event, CASE WHEN reasons = '' THEN CAST(timestamp AS BIGINT) END AS timestamp,
               CASE WHEN reasons = '' THEN CAST(visitor_id AS BIGINT) END AS visitor_id,
               CASE WHEN reasons = '' THEN CAST(item_id AS BIGINT) END AS item_id,
               CASE WHEN reasons = '' THEN CAST(transaction_id AS BIGINT) END AS transaction_id,
               nullif(reasons, '') AS reasons FROM checked"""
    sql["dedup_events"] = f"""{_with(*_COPIES)}
        SELECT timestamp, visitor_id, event, item_id, transaction_id, seq FROM first_copies"""
    sql["insert_new_events"] = f"""{_with(*_COPIES)}
        SELECT timestamp, visitor_id, event, item_id, transaction_id, seq FROM first_copies f
        WHERE NOT EXISTS (SELECT 1 FROM clicks c WHERE c.seq % 3 = 0
            AND c.visitor_id = f.visitor_id AND c.timestamp = f.timestamp
            AND c.event = f.event AND c.item_id = f.item_id)"""
    sql["slice_events"] = f"""{_with(*_CLICKS)}
        SELECT * FROM clicks ORDER BY timestamp, seq OFFSET 100"""
    sql["slice_events_page"] = f"""{_with(*_CLICKS)}
        SELECT * FROM clicks ORDER BY timestamp, seq LIMIT 500 OFFSET 100"""
    sql["batch_visitors"] = f"{_with(*_CLICKS)} SELECT DISTINCT visitor_id FROM clicks"
    sql["publish_events"] = f"""{_with(*_CLICKS)}
        SELECT CAST(visitor_id AS VARCHAR) AS key, CAST(to_json({{'timestamp': timestamp,
            'visitor_id': visitor_id, 'event': event, 'item_id': item_id,
            'transaction_id': transaction_id}}) AS VARCHAR) AS value, 'events' AS topic, seq
        FROM clicks"""
    sql["decode_messages"] = f"""{_with(*_CLICKS)}
        SELECT seq,
            CASE WHEN direct THEN timestamp END AS timestamp,
            CASE WHEN direct THEN visitor_id END AS visitor_id,
            CASE WHEN direct THEN event END AS event,
            CASE WHEN direct AND seq % 7 <> 0 AND seq % 5 <> 0 THEN item_id END AS item_id,
            CASE WHEN direct THEN transaction_id END AS transaction_id,
            CASE WHEN seq % 23 = 0 THEN 'oops' END AS corrupt
        FROM (SELECT *, seq % 3 = 0 AND seq % 23 <> 0 AS direct FROM clicks)"""
    sql["decode_messages_with_errors"] = f"""
        SELECT * FROM ({sql["decode_messages"]}) WHERE seq % 10 <> 0"""
    sql["unwrap_messages"] = f"""{_with(*_CLICKS)}
        SELECT seq, timestamp, visitor_id, event,
               CASE WHEN seq % 5 <> 0 THEN item_id END AS item_id, transaction_id
        FROM clicks WHERE seq % 23 <> 0 AND seq % 7 <> 0"""
    sql["index_documents"] = f"""{_with(*_COPIES)}
        SELECT visitor_id || '_' || timestamp || '_' || event || '_' || item_id AS doc_id,
               {_ISO} AS event_time, timestamp, visitor_id, event, item_id,
               CASE WHEN seq % 10 = 0 THEN -1 ELSE transaction_id END AS transaction_id
        FROM first_copies"""

    sql["sessionize"] = _sessions("clicks", 1800000, *_CLICKS)
    sql["sessionize_12h"] = _sessions("clicks", 43200000, *_CLICKS)
    sql["sessionize_heavy"] = sql["sessionize_12h"]
    sql["sessionize_all_types"] = _sessions("all_events", 43200000, "all_events")
    sql["sessionize_copies"] = _sessions("copies", 43200000, *_CLICKS, "copies")
    sql["sessionize_dedupe"] = _sessions("first_copies", 43200000, *_COPIES)
    sql["session_item_sets"] = f"""{_with(*_CLICKS)}, {sessions_views('clicks', 43200000)}
        SELECT session_id, visitor_id, {', '.join(
            f"array_to_string(list_transform(list_sort(list_transform(list_filter("
            f"string_split({c}, ','), lambda x: x <> ''), lambda x: CAST(x AS BIGINT))), "
            f"lambda x: CAST(x AS VARCHAR)), ',') AS {c}"
            for c in ('items_viewed', 'items_carted', 'items_purchased'))}
        FROM sessions"""
    sql["resume_sessions"] = f"""{_with(*_CLICKS)}, {sessions_views('clicks', 43200000)}
        SELECT {_RECORD} FROM sessions WHERE session_end >= 1705363200000"""
    sql["upsert_sessions"] = f"""{_with(*_CLICKS)},
        early AS (SELECT * FROM clicks WHERE timestamp < 1705363200000),
        {sessions_views('early', 1800000, 'old')}, {sessions_views('clicks', 43200000, 'new')}
        SELECT coalesce(o.session_id, n.session_id) AS session_id,
            coalesce(o.visitor_id, n.visitor_id) AS visitor_id,
            make_timestamp(coalesce(o.session_start, n.session_start) * 1000) AS session_start,
            make_timestamp(coalesce(n.session_end, o.session_end) * 1000) AS session_end,
            coalesce((n.session_end - n.session_start) // 1000,
                     (o.session_end - o.session_start) // 1000) AS duration_seconds,
            {', '.join(f'coalesce(n.{c}, o.{c}) AS {c}' for c in (
                'event_count', 'view_count', 'cart_count', 'transaction_count',
                'items_viewed', 'items_carted', 'items_purchased'))},
            coalesce(n.transaction_count, o.transaction_count) > 0 AS converted
        FROM old o FULL JOIN new n ON n.session_id = o.session_id"""
    sql["active_sessions"] = f"""{_with(*_CLICKS)}
        SELECT count(*) AS active_sessions FROM (
            SELECT visitor_id, max(timestamp) AS t FROM clicks GROUP BY visitor_id)
        WHERE t > (SELECT max(timestamp) FROM clicks) - 86400000"""

    sql["funnel_metrics"] = _funnel(1800000)
    sql["funnel_metrics_12h"] = _funnel(43200000)
    fields = ", ".join(f"'{c}': {c}" for c in (
        "sessions", "cart_sessions", "purchase_sessions", "total_purchases", "conversion_rate",
        "cart_abandonment", "avg_items_per_purchase"))
    sql["funnel_json"] = f"""SELECT '{{' || string_agg('"' || time_window || '":' ||
            CAST(to_json({{{fields}}}) AS VARCHAR), ',' ORDER BY time_window) || '}}' AS json
        FROM ({_funnel(1800000)})"""
    sql["conversion_funnel"] = f"""{_with(*_CLICKS)}
        SELECT date_trunc('day', make_timestamp(timestamp * 1000))::TIMESTAMP AS day,
            count(DISTINCT visitor_id) AS unique_visitors,
            count(DISTINCT CASE WHEN event = 'view' THEN visitor_id END) AS viewers,
            count(DISTINCT CASE WHEN event = 'addtocart' THEN visitor_id END) AS carters,
            count(DISTINCT CASE WHEN event = 'transaction' THEN visitor_id END) AS purchasers
        FROM clicks GROUP BY 1 ORDER BY 1"""
    sql["hourly_traffic"] = f"""{_with(*_CLICKS)}
        SELECT CAST(extract(hour FROM make_timestamp(timestamp * 1000)) AS BIGINT) AS hour_of_day,
            count(*) AS event_count, count(DISTINCT visitor_id) AS unique_visitors
        FROM clicks GROUP BY 1 ORDER BY 1"""
    sql["item_metrics"] = f"""{_with(*_CLICKS)}
        SELECT item_id, count(*) FILTER (WHERE event = 'view') AS view_count,
            count(*) FILTER (WHERE event = 'addtocart') AS cart_count,
            count(*) FILTER (WHERE event = 'transaction') AS purchase_count,
            count(DISTINCT visitor_id) AS unique_visitors,
            make_timestamp(min(timestamp) * 1000) AS first_seen,
            make_timestamp(max(timestamp) * 1000) AS last_seen
        FROM clicks GROUP BY item_id"""
    sql["visitor_metrics"] = f"""{_with(*_CLICKS)}, {sessions_views('clicks', 1800000)}
        SELECT c.visitor_id, total_sessions, count(*) AS total_events,
            count(*) FILTER (WHERE event = 'view') AS total_views,
            count(*) FILTER (WHERE event = 'addtocart') AS total_carts,
            count(*) FILTER (WHERE event = 'transaction') AS total_purchases,
            count(DISTINCT CASE WHEN event = 'view' THEN item_id END) AS unique_items_viewed,
            make_timestamp(min(timestamp) * 1000) AS first_seen,
            make_timestamp(max(timestamp) * 1000) AS last_seen
        FROM clicks c JOIN (SELECT visitor_id, count(*) AS total_sessions FROM sessions
                            GROUP BY visitor_id) s ON s.visitor_id = c.visitor_id
        GROUP BY c.visitor_id, total_sessions"""
    for name, size in (("event_type_breakdown", 5), ("event_type_bars", 3)):
        sql[name] = f"""{_with('all_events')} SELECT event, count(*) AS events FROM all_events
            GROUP BY event ORDER BY events DESC, event LIMIT {size}"""
    sql["events_over_time"] = f"""{_with(*_CLICKS)}
        SELECT date_trunc('hour', make_timestamp(timestamp * 1000))::TIMESTAMP AS bucket,
            count(*) AS events FROM clicks GROUP BY 1"""
    sql["events_over_time_auto"] = f"""{_with(*_CLICKS)}
        SELECT make_timestamp(timestamp // 43200000 * 43200000 * 1000)::TIMESTAMP AS bucket, count(*) AS events FROM clicks
        WHERE timestamp BETWEEN 1704412800000 AND 1705017600000 GROUP BY 1"""
    sql["events_over_time_range"] = f"""{_with(*_CLICKS)}
        SELECT date_trunc('day', make_timestamp(timestamp * 1000))::TIMESTAMP AS bucket,
            count(*) AS events FROM clicks
        WHERE make_timestamp(timestamp * 1000)
            BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25' GROUP BY 1"""
    for name, kind in (("top_viewed_items", "view"), ("top_purchased_items", "transaction")):
        sql[name] = f"""{_with(*_CLICKS)} SELECT item_id, count(*) AS events FROM clicks
            WHERE event = '{kind}' GROUP BY item_id ORDER BY events DESC, item_id LIMIT 10"""
    sql["table_counts"] = f"""{_with(*_CLICKS)}, {sessions_views('clicks', 1800000)}
        SELECT 'events' AS table_name, count(*) AS rows FROM clicks
        UNION ALL SELECT 'sessions', count(*) FROM sessions"""

    sql["consumer_lag"] = f"""{_with('committed', 'ends')}
        SELECT topic, part, greatest(0, end_offset - committed) AS lag
        FROM committed JOIN ends USING (topic, part) WHERE committed >= 0"""
    sql["live_lag"] = f"""{_with('committed', 'ends')}
        SELECT topic, part, CASE WHEN committed >= 0
            THEN greatest(0, end_offset - committed) END AS lag
        FROM committed LEFT JOIN ends USING (topic, part)"""
    sql["live_lag_total"] = f"""{_with('committed', 'ends')}
        SELECT topic, CAST(sum(CASE WHEN committed >= 0
            THEN greatest(0, end_offset - committed) END) AS BIGINT) AS total_lag,
            count(*) FILTER (WHERE committed >= 0) AS known_partitions
        FROM committed LEFT JOIN ends USING (topic, part) GROUP BY topic"""
    sql["partitions_at_end"] = f"""{_with('committed', 'ends')}
        SELECT topic, count(*) AS assigned,
            count(*) FILTER (WHERE committed >= end_offset) AS finished,
            bool_and(committed >= end_offset) AS all_at_end
        FROM committed LEFT JOIN ends USING (topic, part) GROUP BY topic"""
    sql["partitions_at_end_revoked"] = f"""{_with('committed', 'ends')}
        SELECT topic, count(*) AS assigned,
            count(*) FILTER (WHERE committed >= end_offset) AS finished,
            bool_and(committed >= end_offset) AS all_at_end
        FROM committed LEFT JOIN ends USING (topic, part) WHERE part <> 3 GROUP BY topic"""
    sql["topic_message_counts_internal"] = f"""{_with('ends')}
        SELECT topic, CAST(sum(end_offset) AS BIGINT) AS messages
        FROM ends WHERE part NOT IN (1, 2) GROUP BY topic"""
    sql["topic_message_counts"] = f"""{_with('ends')}
        SELECT topic, CAST(sum(end_offset) AS BIGINT) AS messages FROM ends GROUP BY topic"""
    sql["lag_history"] = f"""{_with(*_LAGS)}
        SELECT group_id, ts, string_agg(part || ':' || lag, ',' ORDER BY part) AS partitions,
            CAST(sum(lag) AS BIGINT) AS total FROM part_lags
        GROUP BY group_id, ts ORDER BY group_id, ts"""
    sql["lag_json"] = f"""{_with('committed', 'ends')}
        SELECT '{{"topic":"' || topic || '","part":' || part || ',"lag":' || greatest(0, end_offset - committed) || '}}' AS json
        FROM committed JOIN ends USING (topic, part) WHERE committed >= 0"""
    sql["lag_history_json"] = f"""{_with(*_LAGS)}
        SELECT '{{"group_id":"' || group_id || '","ts":' || ts || ',"partitions":{{' ||
            string_agg('"' || part || '":' || lag, ',' ORDER BY part) || '}},"total":' || CAST(sum(lag) AS BIGINT) || '}}' AS json
        FROM part_lags GROUP BY group_id, ts"""
    sql["lag_history_window"] = f"""{_with(*_LAGS)}
        SELECT group_id, ts, string_agg(part || ':' || lag, ',' ORDER BY part) AS partitions,
            CAST(sum(lag) AS BIGINT) AS total FROM part_lags
        WHERE ts >= (SELECT max(ts) FROM lag_samples) - 86400
        GROUP BY group_id, ts ORDER BY group_id, ts"""
    sql["lag_history_pivot"] = f"""{_with(*_LAGS)}
        SELECT group_id, ts, max(lag) FILTER (WHERE part = 0) AS p0,
            max(lag) FILTER (WHERE part = 1) AS p1, max(lag) FILTER (WHERE part = 2) AS p2,
            CAST(sum(lag) AS BIGINT) AS total FROM part_lags GROUP BY group_id, ts"""
    sql["seen_partitions"] = f"{_with('lag_samples')} SELECT DISTINCT part FROM lag_samples"
    sql["lag_trend"] = f"{_with(*_LAGS)} {_trend(31536000)}"
    sql["lag_trend_window"] = f"{_with(*_LAGS)} {_trend(7200)}"
    sql["lag_trend_rolling"] = f"""{_with(*_LAGS)}
        SELECT group_id, ts, total, {_class('n', 'n > 1', 'slope', 'mean')} AS trend
        FROM (SELECT *, count(*) OVER w AS n, avg(total) OVER w AS mean,
                  CASE WHEN count(*) OVER w > 1 THEN regr_slope(total, ts) OVER w END AS slope
              FROM total_lags WINDOW w AS (PARTITION BY group_id ORDER BY ts
                                           ROWS BETWEEN 23 PRECEDING AND CURRENT ROW))"""
    sql["sample_retention"] = f"""{_with('lag_samples')} SELECT * FROM lag_samples
        WHERE ts > (SELECT max(ts) FROM lag_samples) - 604800"""
    sql["current_rate"] = f"""WITH hourly AS (
            SELECT event_type AS source, ({MS} // 3600000) * 3600 AS ts, count(*) AS n
            FROM events GROUP BY 1, 2),
        samples AS (SELECT source, ts, sum(n) OVER (PARTITION BY source ORDER BY ts) AS count
            FROM hourly),
        recent AS (SELECT source, min(ts) AS t0, max(ts) AS t1, arg_min(count, ts) AS c0,
            arg_max(count, ts) AS c1 FROM samples
            WHERE ts >= (SELECT max(ts) FROM samples) - 86400 GROUP BY source)
        SELECT s.source, round(CASE WHEN max(t1) > max(t0)
                THEN CAST(max(c1) - max(c0) AS BIGINT) / CAST(max(t1) - max(t0) AS BIGINT) END, 9)
                AS current_rate,
            count(*) AS samples_count
        FROM samples s LEFT JOIN recent r ON r.source = s.source GROUP BY s.source"""
    sql["rebalance_stability"] = f"""WITH marks AS (
            SELECT CASE user_id % 2 WHEN 0 THEN 'view' ELSE 'purchase' END AS group_id,
                user_id % 3 AS instance, {MS} // 1000 AS ts FROM events
            WHERE event_type = 'error')
        SELECT group_id, instance, count(*) FILTER (WHERE recent) AS rebalance_count,
            count(*) FILTER (WHERE recent) > 2 AS unstable
        FROM (SELECT *, ts >= (SELECT max(ts) FROM marks) - 3600 AS recent FROM marks)
        GROUP BY group_id, instance"""

    sql["poll_proximity"] = f"""{_with('batch_metrics', 'loops')}
        SELECT group_id, instance, batch_id, round(loop_ms / 1000.0, 9) AS proximity,
            CASE WHEN loop_ms / 1000.0 > 0.9 THEN 'critical' WHEN loop_ms / 1000.0 > 0.7
                THEN 'warning' ELSE 'healthy' END AS severity FROM loops"""
    sql["idle_gap"] = f"""{_with(*_LOOP_VIEWS)}
        SELECT group_id, instance, batch_id, round(idle_ms, 4) AS idle_ms FROM gaps"""
    sql["stage_trend_rolling"] = f"""{_with(*_LOOP_VIEWS, 'slopes')}
        SELECT group_id, instance, batch_id, round(pg_events_slope, 7) + 0 AS pg_events_slope,
            round(valkey_slope, 7) + 0 AS valkey_slope,
            round(pg_sessions_slope, 7) + 0 AS pg_sessions_slope FROM slopes"""
    for name, limit in (("stage_trends", 0.5), ("stage_trends_sensitive", 0.02)):
        sql[name] = f"""{_with(*_LOOP_VIEWS, 'tail_slopes')}
            SELECT group_id, instance, stage, round(slope, 6) AS slope, first_ms, last_ms
            FROM tail_slopes WHERE slope > {limit}"""
    for name, limit in (("bottleneck_stage", 0.5), ("bottleneck_stage_sensitive", 0.02)):
        sql[name] = f"""{_with(*_LOOP_VIEWS, 'tail_slopes')}
            SELECT group_id, instance, max(CASE WHEN rank = 1 AND slope > {limit} THEN stage END)
                AS bottleneck_stage
            FROM (SELECT *, row_number() OVER (PARTITION BY group_id, instance
                      ORDER BY slope DESC, stage_order) AS rank FROM tail_slopes)
            GROUP BY group_id, instance"""
    sql["batch_summary"] = f"""{_with(*_LOOP_VIEWS)}
        SELECT group_id, instance, end_ms // 86400000 AS period, {_SUMMARY},
            round(CAST(sum(batch_size) AS BIGINT) / 86400.0, 9) AS events_per_sec
        FROM gaps GROUP BY group_id, instance, end_ms // 86400000"""
    sql["batch_lifetime"] = f"""{_with(*_LOOP_VIEWS)}
        SELECT group_id, instance, {_SUMMARY}, round(CAST(sum(batch_size) AS BIGINT) /
            ((max(end_ms) - min(end_ms - loop_ms)) / 1000), 9) AS events_per_sec
        FROM gaps GROUP BY group_id, instance"""
    ages = "row_number() OVER (PARTITION BY group_id, instance ORDER BY batch_id DESC)"
    stages = ", ".join(
        f"({i}, '{stage}', coalesce(regr_slope({stage}_ms, -age), 0), arg_max({stage}_ms, age), arg_min({stage}_ms, age))"
        for i, stage in enumerate(("pg_events", "valkey", "pg_sessions"))
    )
    sql["batch_report"] = f"""{_with(*_LOOP_VIEWS)},
        newest AS (SELECT *, {ages} AS age FROM batch_metrics),
        slopes AS (SELECT group_id, instance, unnest([{stages}]) AS s FROM newest WHERE age <= 100 GROUP BY group_id, instance),
        trends AS (SELECT group_id, instance, string_agg(s[2] || ' ' || CAST(floor(s[4]) AS BIGINT) || ' > ' || CAST(floor(s[5]) AS BIGINT), ' | ' ORDER BY s[1]) AS trends
            FROM slopes WHERE s[3] > 0.02 GROUP BY group_id, instance),
        moved AS (SELECT CASE user_id % 2 WHEN 0 THEN 'view' ELSE 'purchase' END AS group_id, user_id % 3 AS instance, count(*) AS rebalances
            FROM events WHERE event_type = 'error' GROUP BY ALL),
        life AS (SELECT group_id, instance, {_SUMMARY}, round(CAST(sum(batch_size) AS BIGINT) /
                ((max(end_ms) - min(end_ms - loop_ms)) / 1000), 9) AS events_per_sec,
                round(max(loop_ms / 1000), 9) AS max_poll_proximity, CAST(sum(batch_size // 2) AS BIGINT) AS sessions
            FROM gaps GROUP BY group_id, instance)
        SELECT life.*, coalesce(rebalances, 0) AS rebalances, coalesce(trends, '') AS trends
        FROM life LEFT JOIN moved USING (group_id, instance) LEFT JOIN trends USING (group_id, instance)"""
    sql["batch_indicators"] = f"""{_with(*_INDICATOR_VIEWS)}
        SELECT group_id, instance, ts, loops, round(fill_ratio, 9) AS fill_ratio,
            round(poll_proximity, 9) AS poll_proximity, round(idle_ms, 4) AS idle_ms,
            rebalance_count, bottleneck_stage FROM named_indicators"""
    sql["backpressure_report"] = f"""{_with(*_INDICATOR_VIEWS, 'backpressure')}
        SELECT group_id, round(fill_ratio, 9) AS fill_ratio,
            round(poll_proximity, 9) AS poll_proximity, round(idle_ms, 4) AS idle_ms,
            rebalance_count, bottleneck_stage, instance_count, ts, {_LABELS} FROM backpressure"""
    sql["lag_report"] = f"""{_with(*_INDICATOR_VIEWS, 'backpressure', *_LAGS)},
        latest AS (SELECT group_id, arg_max(total, ts) AS consumer_lag FROM total_lags
            WHERE ts >= (SELECT max(ts) FROM lag_samples) - 86400 GROUP BY group_id),
        trend AS ({_trend(604800)})
        SELECT group_id, consumer_lag, coalesce(trend, 'unknown') AS lag_trend,
            round(fill_ratio, 9) AS fill_ratio, round(poll_proximity, 9) AS poll_proximity,
            round(idle_ms, 4) AS idle_ms, rebalance_count, bottleneck_stage, instance_count,
            {_LABELS}
        FROM latest FULL JOIN backpressure USING (group_id) LEFT JOIN trend USING (group_id)"""

    sql["bench_filter"] = f"""{_with('runs')}
        SELECT *, date_trunc('minute', make_timestamp(ts_ms * 1000))::TIMESTAMP AS started
        FROM runs WHERE environment = 'local' AND ts_ms >= 1704412800000
            AND ts_ms <= 1706140800000"""
    sql["bench_summary"] = f"""{_with('runs')}
        SELECT environment, count(*) AS runs, min(throughput) AS min_throughput,
            max(throughput) AS max_throughput,
            CAST(sum(throughput) // count(throughput) AS BIGINT) AS avg_throughput,
            CAST(min(make_timestamp(ts_ms * 1000)) AS DATE) AS first_date,
            CAST(max(make_timestamp(ts_ms * 1000)) AS DATE) AS last_date
        FROM runs GROUP BY environment"""
    sql["bench_throughput"] = f"""{_with('runs')}
        SELECT *, CAST(round_even(events_consumed / duration_sec, 0) AS BIGINT) AS events_per_sec
        FROM runs"""
    sql["ramp_steps"] = f"{_with(*_STEPS)} SELECT * FROM steps"
    sql["ramp_saturation"] = f"""{_with(*_STEPS)}
        SELECT run_id, arg_min(rate_target, step) FILTER (WHERE dominant_trend = 'growing')
                AS saturation_rate,
            arg_max(rate_target, step) FILTER (WHERE dominant_trend IN ('stable', 'shrinking'))
                AS peak_sustainable_rate,
            CAST(sum(samples) AS BIGINT) AS total_samples, count(*) AS steps_completed
        FROM steps GROUP BY run_id"""
    sql["ramp_runs"] = f"""{_with('ramp')}
        SELECT run_id, min(ts_ms) AS started_ms, max(ts_ms) AS ended_ms, count(*) AS samples
        FROM ramp GROUP BY run_id ORDER BY started_ms, run_id"""
    sql["ramp_latest_run"] = f"""{_with('ramp')} SELECT * FROM ramp WHERE run_id =
        (SELECT run_id FROM ramp ORDER BY ts_ms DESC, seq LIMIT 1)"""
    sql["sample_throughput"] = f"""{_with('polls', 'known', 'moves')}
        SELECT run_id, step, seq, greatest(0, (known - before) // 5) AS throughput
        FROM moves WHERE step_before = step"""
    sql["stall_detection"] = f"""{_with('polls', 'known', 'moves')},
        marked AS (SELECT *, count <> -1 AND known = before AS still,
            sum(CASE WHEN count <> -1 AND known <> before THEN 1 ELSE 0 END) OVER (
                PARTITION BY run_id ORDER BY step, ts_ms, seq ROWS UNBOUNDED PRECEDING) AS island
            FROM moves),
        counted AS (SELECT *, CAST(sum(CASE WHEN still THEN 1 ELSE 0 END) OVER (
                PARTITION BY run_id, island ORDER BY step, ts_ms, seq ROWS UNBOUNDED PRECEDING)
                AS BIGINT) AS unchanged_polls FROM marked)
        SELECT run_id, seq, unchanged_polls, unchanged_polls >= 30 AS stalled,
            CAST(least(100, round_even(known / 10000 * 100, 0)) AS BIGINT) AS percent
        FROM counted"""
    sql["replay_schedule"] = f"""{_with(*_CLICKS)}
        SELECT seq, round((timestamp - (SELECT min(timestamp) FROM clicks)) / 10000.0, 9)
            AS release_sec FROM clicks"""
    sql["rate_limited_schedule"] = f"""{_with(*_CLICKS)}
        SELECT seq, position, round(greatest(0, (position + 1 - 100) / 500.0), 9) AS release_sec
        FROM (SELECT *, row_number() OVER (ORDER BY timestamp, seq) - 1 AS position FROM clicks)"""
    sql["status_overview"] = f"""{_with(*_CLICKS, 'ends')}, {sessions_views('clicks', 1800000)}
        SELECT 'table events' AS metric, CAST(count(*) AS DOUBLE) AS value FROM clicks
        UNION ALL SELECT 'table sessions', count(*) FROM sessions
        UNION ALL SELECT 'topic ' || topic, sum(end_offset) FROM ends GROUP BY topic
        UNION ALL SELECT 'active sessions', count(*) FROM (
            SELECT visitor_id, max(timestamp) AS t FROM clicks GROUP BY visitor_id)
            WHERE t > (SELECT max(timestamp) FROM clicks) - 86400000
        UNION ALL SELECT 'rate ' || source, current_rate FROM ({sql['current_rate']})"""

    sql["stream_source"] = f"""{_with(*_CLICKS)}
        SELECT CAST(visitor_id AS VARCHAR) AS key, timestamp, visitor_id, event, item_id,
               transaction_id FROM clicks"""
    sql["run_available"] = f"""{_with(*_CLICKS)}
        SELECT event, count(*) AS events, CAST(sum(item_id) AS BIGINT) AS item_sum
        FROM clicks GROUP BY event"""
    sql["stream_dedup"] = f"""{_with(*_COPIES)}
        SELECT timestamp, visitor_id, event, item_id, transaction_id FROM first_copies"""
    sql["stream_dedup_late"] = f"""{_with(*_COPIES)},
        parts AS (SELECT *, timestamp < {SPLIT_MS} AND (timestamp // 3600000 + 1) * 3600000
                <= (SELECT max(timestamp) FROM copies) - 16 * 86400000 AS late FROM copies)
        SELECT 'late' AS part, event, count(*) AS events, CAST(sum(timestamp) AS BIGINT) AS time_sum,
            CAST(sum(seq) AS BIGINT) AS seq_sum FROM parts WHERE late GROUP BY event
        UNION ALL
        SELECT 'first', event, count(*), CAST(sum(timestamp) AS BIGINT), CAST(sum(seq) AS BIGINT)
        FROM (SELECT event, timestamp, min(seq) AS seq FROM parts WHERE NOT late
              GROUP BY visitor_id, timestamp, event, item_id) GROUP BY event"""
    items = "coalesce((SELECT string_agg(CAST(i AS VARCHAR), ',' ORDER BY i) FROM unnest({}) AS t(i)), '')"
    lists = ", ".join(f"{items.format(f's_{n}')} AS {n}" for n in ("items_viewed", "items_carted", "items_purchased"))
    sql["stream_closed_sessions"] = f"""{_with(*_CLICKS, 'copies')},
        gaps AS (SELECT *, timestamp - lag(timestamp) OVER w AS gap FROM copies
                 WINDOW w AS (PARTITION BY visitor_id ORDER BY timestamp, seq)),
        numbered AS (SELECT *, sum(CASE WHEN gap > 43200000 THEN 1 ELSE 0 END) OVER (
                PARTITION BY visitor_id ORDER BY timestamp, seq ROWS UNBOUNDED PRECEDING) AS num FROM gaps),
        made AS (SELECT visitor_id, min(timestamp) AS session_start, max(timestamp) AS session_end,
                count(*) AS event_count, count(*) FILTER (event = 'view') AS view_count,
                count(*) FILTER (event = 'addtocart') AS cart_count,
                count(*) FILTER (event = 'transaction') AS transaction_count,
                list(DISTINCT item_id) FILTER (event = 'view') AS s_items_viewed,
                list(DISTINCT item_id) FILTER (event = 'addtocart') AS s_items_carted,
                list(DISTINCT item_id) FILTER (event = 'transaction') AS s_items_purchased
            FROM numbered GROUP BY visitor_id, num)
        SELECT visitor_id, session_start, session_end, event_count, view_count, cart_count, transaction_count, {lists}
        FROM made WHERE session_end + 43200000 <= (SELECT max(timestamp) FROM copies) - 86400000"""
    sql["stream_late_events"] = f"""{_with(*_CLICKS)},
        arrived AS (SELECT *, timestamp < {SPLIT_MS} AS late FROM clicks),
        gaps AS (SELECT *, timestamp - lag(timestamp) OVER (
                PARTITION BY visitor_id ORDER BY late, timestamp, seq) AS gap FROM arrived),
        numbered AS (SELECT *, 1 + sum(CASE WHEN gap > 43200000 THEN 1 ELSE 0 END) OVER (
                PARTITION BY visitor_id ORDER BY late, timestamp, seq ROWS UNBOUNDED PRECEDING) AS num FROM gaps)
        SELECT visitor_id || '_' || num AS session_id, visitor_id,
            make_timestamp(arg_min(timestamp, (late, timestamp, seq)) * 1000) AS session_start,
            make_timestamp(max(timestamp) * 1000) AS session_end, count(*) AS event_count,
            count(*) FILTER (event = 'view') AS view_count, count(*) FILTER (event = 'addtocart') AS cart_count,
            count(*) FILTER (event = 'transaction') AS transaction_count
        FROM numbered GROUP BY visitor_id, num"""
    latest = f"""{_with(*_CLICKS)}, {sessions_views('clicks', 43200000)},
        latest AS (SELECT * FROM sessions QUALIFY session_num = max(session_num) OVER (PARTITION BY visitor_id))"""
    sql["stream_state"] = f"{latest} SELECT *, session_end AS last_activity FROM latest"
    sql["stream_state_active"] = f"""{latest}
        SELECT visitor_id, session_id, session_end AS last_activity, event_count FROM latest
        WHERE session_end + 2 * 86400000 > (SELECT max(timestamp) FROM clicks) - 86400000"""
    sql["stream_state_changes"] = f"""{_with(*_CLICKS)},
        early AS (SELECT * FROM clicks WHERE timestamp < {SPLIT_MS}),
        {sessions_views('early', 43200000, 'first_sessions')}, {sessions_views('clicks', 43200000)},
        states AS (
            SELECT 0 AS batch_id, visitor_id, event_count FROM first_sessions
            QUALIFY session_num = max(session_num) OVER (PARTITION BY visitor_id)
            UNION ALL SELECT 1, visitor_id, event_count FROM sessions
            WHERE visitor_id IN (SELECT visitor_id FROM clicks WHERE timestamp >= {SPLIT_MS})
            QUALIFY session_num = max(session_num) OVER (PARTITION BY visitor_id))
        SELECT batch_id, 'update' AS change_type, count(*) AS visitors, CAST(sum(event_count) AS BIGINT) AS events
        FROM states GROUP BY batch_id"""
    sql["stream_progress"] = f"""{_with(*_CLICKS)}
        SELECT 'clicks' AS group_id, n AS batch_size, n AS messages, count(*) AS batches
        FROM (SELECT count(*) AS n FROM clicks GROUP BY seq % 105) GROUP BY n"""
    sql["stream_continuous_run"] = STREAM_EVENTS
    sql["stream_csv_folder"] = f"""{_with(*_CLICKS)}
        SELECT timestamp, visitor_id, event, item_id, nullif(transaction_id, 0) AS transaction_id,
               make_timestamp(timestamp * 1000) AS event_time FROM clicks"""
    sql["stream_pipeline_tables"] = f"""{_with(*_CLICKS)}, {sessions_views('all_events', 43200000)},
        keys AS (SELECT DISTINCT visitor_id, timestamp, event, item_id FROM clicks),
        counts AS (
            SELECT 'events' AS table_name, count(*) AS rows FROM keys
            UNION ALL SELECT 'documents', count(*) FROM keys
            UNION ALL SELECT 'sessions', count(*) FROM sessions
            UNION ALL SELECT 'item_metrics', count(*) FROM (SELECT DISTINCT item_id FROM keys)
            UNION ALL SELECT 'visitor_metrics', count(*) FROM (SELECT DISTINCT visitor_id FROM keys)
            UNION ALL SELECT 'quarantine', count(*) FROM all_events WHERE event NOT IN ('view', 'addtocart', 'transaction'))
        SELECT 'filled' AS stage, * FROM counts
        UNION ALL SELECT 'reset', table_name, 0 FROM counts WHERE table_name NOT IN ('documents', 'quarantine')"""
    sql["stream_failing_sink"] = f"""{_with(*_COPIES)}
        SELECT timestamp, visitor_id, event, item_id, transaction_id, 2 AS restarts FROM first_copies"""
    sql["results_csv"] = f"""
        SELECT {MS} - {MS} % 1000 AS ts_ms,
            CASE WHEN user_id % 4 < 2 THEN CASE user_id % 2 WHEN 0 THEN 'local' ELSE 'cloud' END END AS environment,
            event_type AS consumer_impl, 1 + user_id % 4 AS partitions, {K} * 100 AS events_consumed,
            CASE WHEN user_id % 4 <> 0 THEN 1 + {K} END AS duration_sec,
            CASE WHEN user_id % 4 <> 1 THEN CAST(floor(value * 100) AS BIGINT) END AS throughput_events_sec
        FROM events"""
    sql["stream_events_table"] = f"""{_with(*_COPIES)}
        SELECT timestamp, visitor_id, event, item_id, transaction_id FROM first_copies"""
    sql["stream_sessions"] = sql["sessionize_copies"]
    sql["stream_session_table"] = sql["sessionize_copies"]
    sql["stream_documents"] = sql["index_documents"]
    sql["compacted_documents"] = sql["index_documents"]
    sql["compacted_events"] = sql["stream_events_table"]
    sql["stream_events_over_time"] = sql["events_over_time"]
    return sql
