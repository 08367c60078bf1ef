"""The registered queries as SQL over the same tables, for DuckDB."""

from __future__ import annotations

BEHAVIORS = """behaviors AS (
  SELECT user_id, event_id AS item_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS category_id,
         event_type AS behavior, ts FROM events)"""

SENSORS = """sensors AS (
  SELECT event_id, 'sensor_' || user_id AS id, date_trunc('second', ts) AS ts,
         CAST(floor(value) AS INTEGER) AS vc,
         date_trunc('second', ts) + to_seconds((event_id * 7919) % 21601) AS arrival, event_type
  FROM events)"""

MARKETING = """marketing AS (
  SELECT event_id, user_id, event_type AS behavior,
         ['XIAOMI', 'HUAWEI', 'OPPO', 'VIVO'][CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 + 1] AS channel,
         ts FROM events)"""

TOKENS = r"""tokens AS (
  SELECT doc_id, word FROM (
    SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\W+')) AS word FROM documents)
  WHERE word <> '')"""

# Watermark around each row in arrival order; w0 stands for "none yet".
WM = SENSORS + """,
wm AS (
  SELECT *, max(ts) OVER prior - INTERVAL '2 hours' AS wm_before,
         max(ts) OVER upto - INTERVAL '2 hours' AS wm_after,
         row_number() OVER (PARTITION BY id ORDER BY arrival, event_id) AS rn
  FROM sensors
  WINDOW prior AS (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         upto AS (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%g')"


def bucket(hours: int, ts: str = "ts") -> str:
    return f"time_bucket(INTERVAL '{hours} hours', {ts}, TIMESTAMP '1970-01-01')"


def classified(lateness_hours: int) -> str:
    last = f"{bucket(5)} + INTERVAL '5 hours' - INTERVAL '1 millisecond'"
    return WM + f""",
classified AS (
  SELECT *, {bucket(5)} AS window_start, {bucket(5)} + INTERVAL '5 hours' AS window_end,
         CASE WHEN wm_before IS NULL OR wm_before < {last} THEN 'on_time'
              WHEN wm_before < {last} + INTERVAL '{lateness_hours} hours' THEN 'refire'
              ELSE 'late' END AS row_class
  FROM wm),
closing AS (SELECT max(wm_after) AS final FROM wm)"""


def window_text(key: str) -> str:
    start, end = STAMP.format("window_start"), STAMP.format("window_end")
    return f"'key=' || {key} || ' window=[' || {start} || ',' || {end} || ') n=' || n"


def windows(source: str, key: str, hours: int, aggs: str, where: str = "true") -> str:
    return f"""SELECT {key}, {bucket(hours)} AS window_start,
  {bucket(hours)} + INTERVAL '{hours} hours' AS window_end, {aggs}
  FROM {source} WHERE {where} GROUP BY ALL"""


def histogram(n: int) -> str:
    return f"""WITH {SENSORS}, last AS (SELECT vc FROM sensors ORDER BY arrival DESC, event_id DESC LIMIT {n})
SELECT count(*) AS n, min(vc) AS min, max(vc) AS max, round(avg(vc), 6) AS mean,
  round(stddev_samp(vc), 6) AS stddev, round(quantile_cont(vc, 0.5), 6) AS median,
  round(quantile_cont(vc, 0.75), 6) AS p75, round(quantile_cont(vc, 0.95), 6) AS p95,
  round(quantile_cont(vc, 0.99), 6) AS p99 FROM last"""


def gate(condition: str) -> str:
    """Readings for which ``condition`` holds on the switches of the same key."""
    return f"""WITH {SENSORS}, switches AS (
  SELECT id, arrival AS opened, arrival + to_hours(CAST(vc + 1 AS BIGINT)) AS expiry
  FROM sensors WHERE event_type = 'purchase'),
paired AS (
  SELECT r.event_id, max(CASE WHEN s.opened <= r.arrival THEN s.opened END) AS last_open,
         max(CASE WHEN s.expiry <= r.arrival THEN s.expiry END) AS last_end,
         max(CASE WHEN s.opened <= r.arrival THEN s.expiry END) AS latest_end
  FROM sensors r LEFT JOIN switches s USING (id) GROUP BY ALL)
SELECT r.event_id, r.id, r.vc, r.arrival FROM sensors r JOIN paired p USING (event_id) WHERE {condition}"""


# Single-timer machines as recursive walks along each key's rows. c is the clock
# reading at the row, t the pending timer and due the reading that fires it.
def walk(source: str, set_expr: str, keep_cond: str, final: str, start: str = "true",
         clear: str = "false") -> str:
    """``source`` has id, rn, c, base and what the conditions use.

    ``set_expr`` is a row's own timer; ``keep_cond`` says a pending timer stays,
    ``start`` that a row without a pending timer sets one, ``clear`` that the
    pending timer is dropped.
    """
    due = f"greatest({set_expr}, coalesce(r.c + INTERVAL '1 millisecond', {set_expr}))"
    alive = "(w.t IS NOT NULL AND NOT coalesce(r.c >= w.due, false))"
    return f"""walk AS (
  SELECT r.id, r.rn, CASE WHEN {start} THEN {set_expr} END AS t,
         CASE WHEN {start} THEN {due} END AS due, CAST(NULL AS TIMESTAMP) AS fired
  FROM {source} r WHERE r.rn = 1
  UNION ALL
  SELECT r.id, r.rn,
    CASE WHEN {clear} THEN NULL WHEN {alive} AND {keep_cond} THEN w.t
         WHEN {alive} OR {start} THEN {set_expr} END,
    CASE WHEN {clear} THEN NULL WHEN {alive} AND {keep_cond} THEN w.due
         WHEN {alive} OR {start} THEN {due} END,
    CASE WHEN w.t IS NOT NULL AND coalesce(r.c >= w.due, false) THEN w.t END
  FROM walk w JOIN {source} r ON r.id = w.id AND r.rn = w.rn + 1),
ends AS (SELECT id, max(rn) AS rn FROM {source} GROUP BY id)
SELECT id, fired AS fire_time FROM walk WHERE fired IS NOT NULL
UNION ALL
SELECT w.id, w.t FROM walk w JOIN ends USING (id, rn) WHERE w.t IS NOT NULL AND {final} >= w.due"""


EVENT_FINAL = "(SELECT max(wm_after) FROM wm)"
CLOCK_FINAL = "(SELECT max(arrival) FROM sensors)"
EVENT_ROWS = """rows_ AS (
  SELECT id, rn, wm_before AS c, ts AS base, vc,
         lag(vc) OVER (PARTITION BY id ORDER BY rn) AS prev FROM wm)"""
CLOCK_ROWS = """rows_ AS (
  SELECT id, rn, arrival AS c, arrival AS base, vc,
         coalesce(lag(vc) OVER (PARTITION BY id ORDER BY rn), 0) AS prev FROM wm)"""

LINES = r"SELECT unnest(string_split(text, chr(10))) AS line FROM documents"

# JSON text as both engines print it for these plain values; clocks in whole milliseconds.
PAYLOAD = """'{"user_id":' || user_id || ',"item_id":' || item_id || ',"category_id":' || category_id ||
  ',"behavior":"' || behavior || '","ts":' || (epoch_us(ts) // 1000) || '}'"""

# Batches of the late-row streams: the feed in order of arrival, cut into five of equal length; wm is the watermark that
# judges a batch, that of all rows before it.
BATCHES = SENSORS + """,
batched AS (
  SELECT event_id, id, ts, vc, arrival, (row_number() OVER (ORDER BY arrival, event_id) - 1) * 5 // count(*) OVER () AS batch
  FROM sensors),
tops AS (SELECT batch, max(ts) AS top FROM batched GROUP BY batch),
marks AS (
  SELECT batch, max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL '2 hours' AS wm
  FROM tops),
judged AS (
  SELECT b.*, """ + bucket(5) + """ AS window_start, """ + bucket(5) + """ + INTERVAL '5 hours' AS window_end,
    CASE WHEN wm IS NULL OR wm < """ + bucket(5) + """ + INTERVAL '5 hours' - INTERVAL '1 millisecond' THEN 'on_time'
         WHEN wm < """ + bucket(5) + """ + INTERVAL '7 hours' - INTERVAL '1 millisecond' THEN 'refire' ELSE 'late' END AS row_class
  FROM batched b JOIN marks USING (batch))"""

# The single timers of those streams: one tick per key and batch, whose clock is the batch's watermark in milliseconds.
TIMERS = BATCHES + """,
placed AS (
  SELECT *, row_number() OVER (ORDER BY arrival, event_id) AS pos,
    lag(vc) OVER (PARTITION BY id ORDER BY arrival, event_id) AS prev FROM batched),
first_rows AS (
  SELECT id, batch, min_by(ts, pos) AS base, max_by(ts, pos) FILTER (WHERE vc <= prev) AS reset FROM placed GROUP BY id, batch),
clocks AS (SELECT batch, coalesce(epoch_ms(wm), 0) AS clock FROM marks),
final AS (SELECT epoch_ms(max(ts) - INTERVAL '2 hours') AS clock FROM sensors)"""


def stream_timer(sets: str, breaks: str) -> str:
    """Firings of the one-timer machine over the batches."""
    return f"""WITH RECURSIVE {TIMERS},
ticks AS (SELECT id, batch, epoch_ms({sets} + INTERVAL '5 hours') AS sets, {breaks} AS breaks FROM first_rows),
run(batch, id, time, due, fired) AS (
  SELECT CAST(-1 AS BIGINT), id, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM (SELECT DISTINCT id FROM batched)
  UNION ALL
  SELECT c.batch, r.id,
    CASE WHEN r.due IS NULL OR r.due <= c.clock OR t.breaks THEN t.sets ELSE r.time END,
    CASE WHEN r.due IS NULL OR r.due <= c.clock OR t.breaks THEN CASE WHEN t.sets >= c.clock + 1 THEN t.sets
      WHEN t.sets < c.clock + 1 THEN c.clock + 1 END ELSE r.due END,
    CASE WHEN r.due <= c.clock THEN r.time END
  FROM run r JOIN clocks c ON c.batch = r.batch + 1 LEFT JOIN ticks t ON t.id = r.id AND t.batch = c.batch)
SELECT id, make_timestamp(fired * 1000) AS fire_time FROM run WHERE fired IS NOT NULL
UNION ALL
SELECT id, make_timestamp(time * 1000) FROM run, final WHERE batch = 4 AND due <= final.clock"""


ORACLES = {
    "stream_timer_one_per_key": stream_timer("base", "false"),
    "stream_rising_alert": stream_timer("coalesce(reset, base)", "reset IS NOT NULL"),
    "stream_jump_self_cleaning": f"""WITH {TIMERS},
before AS (
  SELECT p.event_id, p.id, p.vc, p.batch, lag(p.vc) OVER o AS vc0, lag(p.batch) OVER o AS batch0, lag(p.ts) OVER o AS ts0
  FROM placed p WINDOW o AS (PARTITION BY p.id ORDER BY p.arrival, p.event_id)),
lasts AS (
  SELECT b.event_id, b.id, b.vc, CASE
    WHEN vc0 IS NULL THEN 0
    WHEN b.batch0 <> b.batch AND c.clock >= epoch_ms(ts0 + INTERVAL '60 hours') AND c.clock >= c0.clock + 1 THEN 0
    ELSE vc0 END AS last
  FROM before b JOIN clocks c ON c.batch = b.batch LEFT JOIN clocks c0 ON c0.batch = b.batch0)
SELECT event_id, id, vc, abs(vc - last) AS diff FROM lasts WHERE abs(vc - last) > 10""",
    "rolling_reduce_general": f"""WITH {SENSORS}
SELECT event_id, id, string_agg(CAST(vc AS VARCHAR), ',') OVER (
  PARTITION BY id ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING) AS running FROM sensors""",
    "uv_bitmap": f"""SELECT {bucket(10)} AS window_start, count(DISTINCT user_id) AS uv FROM events
WHERE event_type = 'view' GROUP BY 1
UNION ALL SELECT NULL, count(DISTINCT user_id) FROM events WHERE event_type = 'view'""",
    "window_user_aggregate": f"""WITH {SENSORS}
SELECT id, {bucket(15)} AS window_start, count(*) AS n, CAST(sum(vc) AS DOUBLE) / count(*) AS mean,
  CAST(max(vc) - min(vc) AS BIGINT) AS spread FROM sensors GROUP BY ALL""",
    "session_user_aggregate": f"""WITH {SENSORS}, flagged AS (
  SELECT *, CASE WHEN ts > lag(ts) OVER o + INTERVAL '5 hours' THEN 1 ELSE 0 END AS anew
  FROM sensors WINDOW o AS (PARTITION BY id ORDER BY ts, event_id)),
numbered AS (SELECT *, sum(anew) OVER (PARTITION BY id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM flagged)
SELECT id, min(ts) AS session_start, max(ts) + INTERVAL '5 hours' AS session_end, count(*) AS n,
  CAST(sum(vc) AS DOUBLE) / count(*) AS mean, CAST(max(vc) - min(vc) AS BIGINT) AS spread FROM numbered GROUP BY id, s""",
    "delay_sketch": f"""WITH {SENSORS}
SELECT {bucket(50)} AS window_start, count(*) AS n, true AS p50_close, true AS p95_close FROM sensors GROUP BY 1""",
    "state_lookup_list": f"""WITH {SENSORS}, placed AS (
  SELECT event_id % 16 AS shard, event_id, vc, row_number() OVER (PARTITION BY event_id % 16 ORDER BY arrival, event_id) AS pos,
    count(*) OVER (PARTITION BY event_id % 16) AS n FROM sensors)
SELECT CAST(shard AS INTEGER) AS shard, event_id, vc FROM placed WHERE pos > n // 3 * 3""",
    "stream_late_side_output": f"""WITH {BATCHES}
SELECT event_id, id, ts, vc, arrival FROM judged WHERE row_class = 'late'""",
    "stream_late_refire": f"""WITH {BATCHES},
per_batch AS (
  SELECT id, window_start, window_end, batch, row_class, count(*) AS k FROM judged WHERE row_class <> 'late' GROUP BY ALL),
running AS (
  SELECT *, sum(k) OVER (PARTITION BY id, window_start ORDER BY batch, row_class) AS n FROM per_batch)
SELECT id, window_start, window_end, 'refire' AS firing, CAST(n AS BIGINT) AS n FROM running WHERE row_class = 'refire'
UNION ALL
SELECT id, window_start, window_end, 'first', CAST(sum(k) AS BIGINT) FROM per_batch WHERE row_class = 'on_time'
GROUP BY id, window_start, window_end
HAVING window_end - INTERVAL '1 millisecond' <= (SELECT max(ts) - INTERVAL '2 hours' FROM sensors)""",
    "word_count": f"WITH {TOKENS} SELECT word, count(*) AS n FROM tokens GROUP BY word",
    "src_text_lines": LINES,
    "src_collection": f"""WITH {SENSORS}, pairs(id, duration_ms) AS (VALUES ('sensor_1', 10000), ('sensor_2', 60000))
SELECT id, CAST(duration_ms AS BIGINT) AS duration_ms, count(*) AS n FROM sensors JOIN pairs USING (id) GROUP BY ALL""",
    "parse_behavior_csv": f"""WITH {BEHAVIORS}
SELECT user_id, item_id, category_id, behavior, date_trunc('second', ts) AS ts FROM behaviors WHERE behavior <> 'error'""",
    "parse_behavior_bad": f"""WITH {BEHAVIORS}
SELECT user_id || ',' || item_id || ',' || category_id || ',' || behavior || ',~' || CAST(floor(epoch(ts)) AS BIGINT) AS line
FROM behaviors WHERE behavior = 'error'""",
    "parse_sensor_csv": f"WITH {SENSORS} SELECT id, ts, vc FROM sensors",
    "parse_threshold_json": f"""WITH {SENSORS}
SELECT id, vc AS threshold_vc FROM sensors WHERE event_type NOT IN ('error', 'view')""",
    "map_project": """SELECT 'pv' AS key, CAST(1 AS BIGINT) AS one, event_id AS item_id FROM events
WHERE event_type = 'view'""",
    "map_with_lifecycle": """SELECT event_id AS item_id,
  'user=' || user_id || ' item=' || event_id || ' behavior=' || event_type AS text FROM events""",
    "filter_pv": f"WITH {BEHAVIORS} SELECT * FROM behaviors WHERE behavior = 'view'",
    "flatmap_tokenize": f"WITH {TOKENS} SELECT doc_id, word, CAST(1 AS BIGINT) AS one FROM tokens",
    "key_partition_stats": f"WITH {SENSORS} SELECT id, count(*) AS n FROM sensors GROUP BY id",
    "format_window_text": f"""WITH {BEHAVIORS}, w AS ({windows('behaviors', 'behavior', 10, 'count(*) AS n')})
SELECT {window_text('behavior')} AS text FROM w""",
    "epoch_convert": """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s,
  CAST(floor(epoch(ts)) AS BIGINT) * 1000 AS epoch_ms, date_trunc('second', ts) AS ts FROM events""",
    "process_element": f"WITH {SENSORS} SELECT id AS key, ts AS record_ts, event_id, vc FROM sensors",
    "union_streams": f"""WITH {BEHAVIORS} SELECT * FROM behaviors WHERE behavior = 'view'
UNION ALL SELECT * FROM behaviors WHERE behavior = 'click' UNION ALL SELECT * FROM behaviors WHERE behavior = 'view'""",
    "connect_comap": f"""WITH {SENSORS} SELECT event_type AS value FROM events
UNION ALL SELECT id || ':' || vc FROM sensors""",
    "gate_forward": gate("last_open IS NOT NULL AND (last_end IS NULL OR last_open >= last_end)"),
    "gate_forward_extend": gate("latest_end > arrival"),
    "dynamic_threshold_alert": f"""WITH {SENSORS}, tagged AS (
  SELECT id, arrival, 0 AS rank, event_id, NULL AS vc, vc % 40 AS threshold FROM sensors WHERE event_type = 'signup'
  UNION ALL SELECT id, arrival, 1, event_id, vc, NULL FROM sensors),
known AS (
  SELECT *, last_value(threshold IGNORE NULLS) OVER (PARTITION BY id ORDER BY arrival, rank, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rule,
    coalesce(last_value(vc IGNORE NULLS) OVER (PARTITION BY id ORDER BY arrival, rank, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev FROM tagged)
SELECT event_id, id, vc, abs(vc - prev) AS diff FROM known WHERE rank = 1 AND rule <> 0 AND abs(vc - prev) > rule""",
    "side_output_main": f"WITH {SENSORS} SELECT event_id, id, ts, vc, arrival FROM sensors",
    "side_output_alarm": f"""WITH {SENSORS} SELECT id || ' level ' || vc || ' is over 100' AS alarm
FROM sensors WHERE vc > 100""",
    "rolling_sum": f"""WITH {BEHAVIORS} SELECT behavior, ts, item_id, CAST(1 AS BIGINT) AS one,
  CAST(sum(1) OVER (PARTITION BY behavior ORDER BY ts, item_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running
FROM behaviors""",
    "rolling_reduce": f"""WITH {SENSORS} SELECT event_id, id, arrival, CAST(vc AS BIGINT) AS vc,
  CAST(sum(vc) OVER (PARTITION BY id ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running
FROM sensors""",
    "rolling_min": f"""WITH {SENSORS} SELECT event_id, id, arrival, ts, vc,
  min(ts) OVER (PARTITION BY id ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING) AS min_ts FROM sensors""",
    "rolling_max": f"""WITH {SENSORS} SELECT event_id, id, arrival, ts, vc,
  max(vc) OVER (PARTITION BY id ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING) AS max_vc FROM sensors""",
    "pv_total": "SELECT count(*) AS pv FROM events WHERE event_type = 'view'",
    "pv_total_running": """SELECT ts, event_id AS item_id, row_number() OVER (ORDER BY ts, event_id) AS pv
FROM events WHERE event_type = 'view'""",
    "uv_total": "SELECT count(DISTINCT user_id) AS uv FROM events WHERE event_type = 'view'",
    "uv_running": """WITH seen AS (
  SELECT ts, event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth
  FROM events WHERE event_type = 'view')
SELECT ts, event_id AS item_id, user_id,
  CAST(sum(CASE WHEN nth = 1 THEN 1 ELSE 0 END) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS uv
FROM seen""",
    "channel_behavior_count": f"""WITH {MARKETING}
SELECT channel || '_' || behavior AS channel_behavior, count(*) AS n FROM marketing GROUP BY ALL""",
    "channel_behavior_running": f"""WITH {MARKETING}
SELECT channel || '_' || behavior AS channel_behavior, ts, event_id,
  row_number() OVER (PARTITION BY channel, behavior ORDER BY ts, event_id) AS n FROM marketing""",
    "pv_per_user": """SELECT user_id, ts, event_id AS item_id,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events WHERE event_type = 'view'""",
    "count_average": f"""WITH {SENSORS}, placed AS (
  SELECT id, vc, row_number() OVER (PARTITION BY id ORDER BY arrival, event_id) AS pos FROM sensors)
SELECT id, (pos - 1) // 2 AS block, count(*) AS n, avg(vc) AS avg FROM placed GROUP BY ALL HAVING count(*) = 2""",
    "buffer_release": f"""WITH {SENSORS}, placed AS (
  SELECT *, row_number() OVER (ORDER BY arrival, event_id) AS pos FROM sensors)
SELECT event_id, id, ts, vc, arrival, (pos - 1) // 3 AS batch_no FROM placed
WHERE pos <= (SELECT count(*) FROM sensors) // 3 * 3""",
    "tumbling_count": f"WITH {SENSORS} {windows('sensors', 'id', 5, 'count(*) AS n')}",
    "sliding_count": f"""WITH {BEHAVIORS}, spread AS (
  SELECT user_id, {bucket(5)} - to_hours(CAST(5 * i AS BIGINT)) AS window_start
  FROM behaviors, range(10) r(i) WHERE behavior = 'view')
SELECT user_id, window_start, window_start + INTERVAL '50 hours' AS window_end, count(*) AS n FROM spread GROUP BY ALL""",
    "session_count": f"""WITH {BEHAVIORS}, flagged AS (
  SELECT user_id, ts, item_id, CASE WHEN ts > lag(ts) OVER o + INTERVAL '5 hours' THEN 1 ELSE 0 END AS anew
  FROM behaviors WHERE behavior = 'view' WINDOW o AS (PARTITION BY user_id ORDER BY ts, item_id)),
numbered AS (
  SELECT *, sum(anew) OVER (PARTITION BY user_id ORDER BY ts, item_id ROWS UNBOUNDED PRECEDING) AS s FROM flagged)
SELECT user_id, count(*) AS n, min(ts) AS session_start, max(ts) + INTERVAL '5 hours' AS session_end
FROM numbered GROUP BY user_id, s""",
    "count_window_tumbling": """WITH placed AS (
  SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos
  FROM events WHERE event_type = 'view')
SELECT user_id, pos // 5 AS firing, CAST(5 AS BIGINT) AS n FROM placed WHERE pos % 5 = 0""",
    "count_window_sliding": """WITH placed AS (
  SELECT user_id, row_number() OVER o AS pos, count(*) OVER (o ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS n
  FROM events WHERE event_type = 'view' WINDOW o AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, pos // 2 AS firing, n FROM placed WHERE pos % 2 = 0""",
    "window_reduce_sum": f"WITH {BEHAVIORS} {windows('behaviors', 'behavior', 10, 'CAST(sum(1) AS BIGINT) AS n')}",
    "window_aggregate_count": f"""WITH {BEHAVIORS}, w AS ({windows('behaviors', 'behavior', 10, 'count(*) AS n')})
SELECT window_start, n FROM w""",
    "window_avg": f"WITH {SENSORS} {windows('sensors', 'id', 15, 'avg(vc) AS avg')}",
    "window_minmax": f"""WITH {SENSORS}
{windows('sensors', 'id', 10, 'CAST(min(vc) AS DOUBLE) AS min, CAST(max(vc) AS DOUBLE) AS max')}""",
    "window_minmax_incremental": f"""WITH {SENSORS}, w AS (
  {windows('sensors', 'id', 10, 'CAST(min(vc) AS DOUBLE) AS min, CAST(max(vc) AS DOUBLE) AS max')})
SELECT id, min, max, {STAMP.format('window_start')} AS start_text, {STAMP.format('window_end')} AS end_text FROM w""",
    "window_count_text": f"""WITH {BEHAVIORS}, w AS (
  {windows('behaviors', 'user_id', 10, 'count(*) AS n', "behavior = 'view'")})
SELECT {window_text('user_id')} AS text FROM w""",
    "watermark_ascending": f"""WITH {SENSORS} SELECT event_id, ts, max(ts) OVER (ORDER BY ts, event_id
  ROWS UNBOUNDED PRECEDING) - INTERVAL '1 millisecond' AS watermark FROM sensors""",
    "watermark_bounded": f"""WITH {SENSORS} SELECT event_id, ts, max(ts) OVER (ORDER BY ts, event_id
  ROWS UNBOUNDED PRECEDING) - INTERVAL '2 hours' AS watermark FROM sensors""",
    "watermark_per_record": f"WITH {WM} SELECT event_id, ts, arrival, wm_after AS watermark FROM wm",
    "watermark_per_batch": f"""WITH {SENSORS}, blocks AS (
  SELECT {bucket(10, 'arrival')} AS block_start, max(ts) AS top FROM sensors GROUP BY ALL)
SELECT block_start, max(top) OVER (ORDER BY block_start ROWS UNBOUNDED PRECEDING) - INTERVAL '2 hours' AS watermark
FROM blocks""",
    "watermark_min_over_inputs": f"""WITH {SENSORS}, tops AS (
  SELECT event_id, ts, arrival, event_id % 2 AS input,
    max(CASE WHEN event_id % 2 = 0 THEN ts END) OVER o AS a, max(CASE WHEN event_id % 2 = 1 THEN ts END) OVER o AS b
  FROM sensors WINDOW o AS (ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING))
SELECT event_id, ts, arrival, input, CASE WHEN a IS NULL OR b IS NULL THEN NULL
  ELSE least(a, b) - INTERVAL '2 hours' END AS watermark FROM tops""",
    "late_drop": f"""WITH {classified(0)} SELECT id, window_start, window_end, count(*) AS n FROM classified, closing
WHERE row_class = 'on_time' AND window_end - INTERVAL '1 millisecond' <= final GROUP BY ALL""",
    "late_refire": f"""WITH {classified(2)}, kept AS (
  SELECT *, row_number() OVER (PARTITION BY id, window_start ORDER BY arrival, event_id) AS pos
  FROM classified WHERE row_class <> 'late')
SELECT id, window_start, window_end, 'first' AS firing, count(*) AS n FROM kept, closing
WHERE row_class = 'on_time' AND window_end - INTERVAL '1 millisecond' <= final GROUP BY ALL
UNION ALL SELECT id, window_start, window_end, 'refire', pos FROM kept WHERE row_class = 'refire'""",
    "late_side_output": f"""WITH {classified(2)}
SELECT event_id, id, ts, vc, arrival FROM classified WHERE row_class = 'late'""",
    "timer_per_event": f"""WITH {WM}, timers AS (
  SELECT DISTINCT id, ts + INTERVAL '5 hours' AS fire_time,
    greatest(ts + INTERVAL '5 hours', coalesce(wm_before + INTERVAL '1 millisecond', ts + INTERVAL '5 hours')) AS due
  FROM wm),
marks AS (SELECT DISTINCT wm_after AS watermark FROM wm)
SELECT DISTINCT t.id, t.fire_time, m.watermark FROM timers t ASOF JOIN marks m ON m.watermark >= t.due""",
    "timer_processing": f"""WITH {SENSORS} SELECT DISTINCT id, arrival + INTERVAL '5 hours' AS fire_time,
  arrival + INTERVAL '5 hours' <= (SELECT max(arrival) FROM sensors) AS fired FROM sensors""",
    "timer_one_per_key": f"""WITH RECURSIVE {WM}, {EVENT_ROWS},
{walk('rows_', "(r.base + INTERVAL '5 hours')", "true", EVENT_FINAL)}""",
    "timer_one_per_key_processing": f"""WITH RECURSIVE {WM}, {CLOCK_ROWS},
{walk('rows_', "(r.base + INTERVAL '5 hours')", "true", CLOCK_FINAL)}""",
    "rising_alert_event": f"""WITH RECURSIVE {WM}, {EVENT_ROWS},
{walk('rows_', "(r.base + INTERVAL '5 hours')", "NOT coalesce(r.vc <= r.prev, false)", EVENT_FINAL)}""",
    "rising_alert_processing": f"""WITH RECURSIVE {WM}, {CLOCK_ROWS},
{walk('rows_', "(r.base + INTERVAL '10 hours')", "true", CLOCK_FINAL,
      start="(r.prev <> 0 AND r.vc > r.prev)", clear="(r.prev <> 0 AND r.vc < r.prev)")}""",
    "jump_alert": f"""WITH {SENSORS}, last AS (
  SELECT *, coalesce(lag(vc) OVER (PARTITION BY id ORDER BY arrival, event_id), 0) AS prev FROM sensors)
SELECT event_id, id, vc, abs(vc - prev) AS diff FROM last WHERE abs(vc - prev) > 1.7""",
    "jump_alert_self_cleaning": f"""WITH {WM}, last AS (
  SELECT *, lag(vc) OVER o AS pv, lag(ts) OVER o + INTERVAL '60 hours' AS timer, lag(wm_before) OVER o AS set_at
  FROM wm WINDOW o AS (PARTITION BY id ORDER BY rn)),
seen AS (
  SELECT *, CASE WHEN pv IS NULL OR coalesce(wm_before >= timer AND (set_at IS NULL OR wm_before > set_at), false)
    THEN 0 ELSE pv END AS prev FROM last)
SELECT event_id, id, vc, abs(vc - prev) AS diff FROM seen WHERE abs(vc - prev) > 10""",
    "last_value_keyed": f"""WITH {SENSORS} SELECT event_id, id, vc, arrival,
  coalesce(lag(vc) OVER (PARTITION BY id ORDER BY arrival, event_id), 0) AS last FROM sensors""",
    "last_value_global": f"""WITH {SENSORS} SELECT event_id, id, vc, arrival,
  coalesce(lag(vc) OVER (ORDER BY arrival, event_id), 0) AS last FROM sensors""",
    "ttl_count": f"""WITH {SENSORS}, flagged AS (
  SELECT id, ts, event_id, CASE WHEN ts >= lag(ts) OVER o + INTERVAL '10 hours' THEN 1 ELSE 0 END AS anew
  FROM sensors WINDOW o AS (PARTITION BY id ORDER BY ts, event_id)),
runs AS (SELECT *, sum(anew) OVER (PARTITION BY id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM flagged)
SELECT id, ts, event_id, row_number() OVER (PARTITION BY id, run ORDER BY ts, event_id) AS n FROM runs""",
    "metric_counter": f"""WITH {TOKENS}
SELECT 'MyGroup' AS metric_group, 'MapCounter' AS metric, count(*) AS value FROM tokens""",
    "metric_counter_weighted": f"""WITH {TOKENS}
SELECT 'MyGroup' AS metric_group, 'MapCounter' AS metric, CAST(2 * count(*) AS BIGINT) AS value FROM tokens""",
    "histogram_last_n": histogram(1000),
    "histogram_last_500": histogram(500),
    "meter_rate": f"""WITH {SENSORS} SELECT {bucket(1)} AS window_start, count(*) AS n, count(*) / 3600.0::DOUBLE AS rate
FROM sensors GROUP BY ALL""",
    "meter_trailing_rates": f"""WITH {SENSORS}, steps AS (SELECT {bucket(1)} AS at, count(*) AS n FROM sensors GROUP BY ALL)
SELECT a.at AS step_start, CAST(sum(CASE WHEN b.at = a.at THEN b.n END) AS DOUBLE) AS rate_1,
  sum(CASE WHEN b.at > a.at - INTERVAL '5 hours' THEN b.n END) / 5.0::DOUBLE AS rate_5, sum(b.n) / 15.0::DOUBLE AS rate_15
FROM steps a JOIN steps b ON b.at <= a.at AND b.at > a.at - INTERVAL '15 hours' GROUP BY a.at""",
    "meter_exponential_rates": f"""WITH {SENSORS},
counts AS (SELECT {bucket(1)} AS seen, CAST(count(*) AS DOUBLE) AS n FROM sensors GROUP BY ALL),
ends AS (SELECT min(seen) AS lo, max(seen) AS hi FROM counts),
steps AS (SELECT unnest(generate_series(lo, hi, INTERVAL '1 hour')) AS step_start FROM ends),
aged AS (SELECT step_start, n, seen = lo AS first_one, epoch(step_start - seen) / 3600.0::DOUBLE AS age
  FROM steps JOIN counts ON seen <= step_start AND seen > step_start - INTERVAL '420 hours', ends)
SELECT step_start, """ + ", ".join(
        f"""round(coalesce(sum(CASE WHEN age < {28 * k} THEN n * exp(-age / {k}.0::DOUBLE)
  * CASE WHEN first_one THEN 1.0::DOUBLE ELSE 1.0::DOUBLE - exp(-1.0::DOUBLE / {k}.0::DOUBLE) END END), 0), 6) AS rate_{k}"""
        for k in (1, 5, 15)) + """
FROM steps LEFT JOIN aged USING (step_start) GROUP BY step_start""",
    "delay_stats": f"""WITH {SENSORS}, delays AS (
  SELECT {bucket(5)} AS window_start, CAST(epoch(arrival) - epoch(ts) AS BIGINT) AS d FROM sensors)
SELECT window_start, count(*) AS n, max(d) AS max_delay, round(avg(d), 6) AS avg_delay,
  round(quantile_cont(d, 0.5), 6) AS p50_delay, round(quantile_cont(d, 0.95), 6) AS p95_delay FROM delays GROUP BY ALL""",
    "sink_queue_payload": f"WITH {BEHAVIORS} SELECT {PAYLOAD} AS value FROM behaviors",
    "sink_jdbc_rows": """SELECT CAST(user_id AS INTEGER) AS user_id, CAST(event_id AS VARCHAR) AS item_id,
  event_type AS behavior FROM events""",
    "sink_kv_latest": """SELECT CAST(user_id AS VARCHAR) AS key, CAST(count(*) AS VARCHAR) AS value
FROM events WHERE event_type = 'view' GROUP BY user_id""",
    "sink_doc_upsert": """WITH last AS (
  SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back
  FROM events)
SELECT CAST(user_id AS VARCHAR) AS doc_id, '{"userID":"' || user_id || '","itemId":"' || event_id ||
  '","behavior":"' || event_type || '"}' AS source FROM last WHERE back = 1""",
}

for _kind, _field, _sign in (("min", "ts", "<"), ("max", "vc", ">")):
    # The record a running extreme comes from: no earlier row is as good.
    ORACLES[f"rolling_{_kind}_by"] = f"""WITH {SENSORS}, best AS (
  SELECT id, arrival, event_id, {_kind}({_field}) OVER o AS top,
    arg_{_kind}(event_id, {_field}) OVER o AS any_event
  FROM sensors WINDOW o AS (PARTITION BY id ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING)),
firsts AS (
  SELECT id, {_field} AS top, event_id, ts, vc,
    row_number() OVER (PARTITION BY id, {_field} ORDER BY arrival, event_id) AS nth FROM sensors)
SELECT b.id, b.arrival, b.event_id, f.event_id AS best_event_id, f.ts AS best_ts, f.vc AS best_vc
FROM best b JOIN firsts f ON f.id = b.id AND f.top = b.top AND f.nth = 1"""

# Streams end in the answer of the bounded query, for what the last watermark closes.
CLOSED = "(SELECT max(ts) - INTERVAL '6 hours' FROM sensors)"

ORACLES |= {
    "src_file_stream": ORACLES["src_text_lines"],
    "src_replay": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "stream_word_count": ORACLES["word_count"],
    "restartable_word_count": ORACLES["word_count"],
    "stream_uv": ORACLES["uv_total"],
    "stateful_count": f"WITH {TOKENS} SELECT word AS key, count(*) AS n FROM tokens GROUP BY word",
    "state_lookup": ORACLES["key_partition_stats"],
    "stream_dynamic_threshold": ORACLES["dynamic_threshold_alert"],
    "stateful_threshold": ORACLES["dynamic_threshold_alert"],
    "stream_jump_alert": ORACLES["jump_alert"],
    "stream_last_value": ORACLES["last_value_keyed"],
    "stream_rolling_sum": f"""WITH {SENSORS} SELECT event_id, event_type AS id, arrival, CAST(1 AS BIGINT) AS value,
  row_number() OVER (PARTITION BY event_type ORDER BY arrival, event_id) AS running FROM sensors""",
    "buffer_restart": f"""WITH {SENSORS}, placed AS (
  SELECT CAST(event_id % 16 AS INTEGER) AS shard, event_id, vc,
    row_number() OVER (PARTITION BY event_id % 16 ORDER BY arrival, event_id) AS pos,
    count(*) OVER (PARTITION BY event_id % 16) AS n FROM sensors)
SELECT shard, event_id, vc FROM placed WHERE pos <= n // 3 * 3""",
    "stream_kv_upsert": f"""WITH {SENSORS} SELECT id AS key, CAST(count(*) AS VARCHAR) AS value
FROM sensors WHERE event_type = 'view' GROUP BY id""",
    "metric_gauge": f"WITH {SENSORS} SELECT vc AS last_vc FROM sensors ORDER BY arrival DESC, event_id DESC LIMIT 1",
    "metric_watermark": f"WITH {SENSORS} SELECT max(ts) - INTERVAL '6 hours' AS watermark FROM sensors",
    "uv_approx": """WITH least AS (
  SELECT substr(md5(CAST(user_id AS VARCHAR)), 1, 3) AS b, min(substr(md5(CAST(user_id AS VARCHAR)), 4, 12)) AS h
  FROM events WHERE event_type = 'view' AND user_id IS NOT NULL GROUP BY 1),
sums AS (SELECT count(*) AS full_, 4096 - count(*) AS empty_, coalesce(sum(CAST('0x' || h AS BIGINT)), 0) AS minima FROM least)
SELECT CAST(round(CASE WHEN empty_ * 20 >= 4096 THEN 4096.0::DOUBLE * ln(4096.0::DOUBLE / greatest(empty_, 1))
  ELSE 4095.0::DOUBLE * full_ * 281474976710656.0::DOUBLE / CAST(minima + empty_ * 281474976710656 AS DOUBLE) END) AS BIGINT) AS uv
FROM sums""",
    "sink_custom": ORACLES["sink_jdbc_rows"],
    "stream_tumbling_count": f"""WITH {SENSORS}, w AS ({windows('sensors', 'id', 5, 'count(*) AS n')})
SELECT * FROM w WHERE window_end <= {CLOSED}""",
    "stream_sliding_count": f"""WITH {SENSORS}, spread AS (
  SELECT id, {bucket(5)} - to_hours(CAST(5 * i AS BIGINT)) AS window_start
  FROM sensors, range(10) r(i) WHERE event_type = 'view'),
w AS (SELECT id, window_start, window_start + INTERVAL '50 hours' AS window_end, count(*) AS n FROM spread GROUP BY ALL)
SELECT * FROM w WHERE window_end <= (SELECT max(ts) - INTERVAL '6 hours' FROM sensors WHERE event_type = 'view')""",
    "stream_session_count": f"""WITH {SENSORS}, flagged AS (
  SELECT id, ts, event_id, CASE WHEN ts > lag(ts) OVER o + INTERVAL '5 hours' THEN 1 ELSE 0 END AS anew
  FROM sensors WHERE event_type = 'view' WINDOW o AS (PARTITION BY id ORDER BY ts, event_id)),
numbered AS (
  SELECT *, sum(anew) OVER (PARTITION BY id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM flagged),
sessions AS (
  SELECT id, count(*) AS n, min(ts) AS session_start, max(ts) + INTERVAL '5 hours' AS session_end
  FROM numbered GROUP BY id, s)
SELECT * FROM sessions
WHERE session_end <= (SELECT max(ts) - INTERVAL '6 hours' FROM sensors WHERE event_type = 'view')""",
    "stream_timer_per_event": f"""WITH {SENSORS} SELECT DISTINCT id, ts + INTERVAL '5 hours' AS fire_time
FROM sensors WHERE ts + INTERVAL '5 hours' <= {CLOSED}""",
}
