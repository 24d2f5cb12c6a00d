"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Views ``events``, ``documents``, ... are registered by the checker. Window
starts are computed with integer microsecond arithmetic (epoch aligned, floor
modulo), the way Spark aligns ``window``. Column names match ``plans.queries``.
"""

from __future__ import annotations

from eddyline.operators.windows import duration_us
from eddyline.plans import params as P

SV = "SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS id, ts, value AS vc, event_type FROM events"
# epoch milliseconds truncated like Timestamp.getTime (DuckDB epoch_ms rounds)
SV_MS = "SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS id, epoch_us(ts) // 1000 AS ts, value AS vc FROM events"

LINES = (
    "SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS line_no, unnest(l) AS value FROM ("
    "SELECT doc_id, CASE WHEN text = '' THEN []::VARCHAR[] "
    r"ELSE regexp_split_to_array(regexp_replace(text, '\r?\n\z', ''), '\r?\n') END AS l FROM documents)"
)


def _jsplit(col: str, sep: str) -> str:
    """Java ``String.split`` on a literal one-character separator."""
    body = f"regexp_replace({col}, '(?:\\Q{sep}\\E)+\\z', '')"
    return (
        f"CASE WHEN {col} = '' THEN [''] WHEN {body} = '' THEN []::VARCHAR[] "
        f"ELSE string_split({body}, '{sep}') END"
    )


WORDS = (
    "SELECT doc_id, line_no, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS word FROM ("
    f"SELECT doc_id, line_no, {_jsplit('value', ' ')} AS w FROM ({LINES}))"
)

UTF16_LEN = r"CAST(length(text) + length(regexp_replace(text, '[^\x{10000}-\x{10FFFF}]', '', 'g')) AS BIGINT)"


def _start_us(ts: str, size: str, offset: str | None = None) -> str:
    s = duration_us(size)
    o = duration_us(offset) if offset else 0
    x = f"epoch_us({ts})"
    return f"({x} - ((({x} - ({o})) % {s}) + {s}) % {s})"


def _ts(us: str) -> str:
    return f"make_timestamp(CAST({us} AS BIGINT))"


def _java_ts_text(ts: str) -> str:
    frac = f"(epoch_us({ts}) % 1000000)"
    return (
        f"strftime({ts}, '%Y-%m-%d %H:%M:%S') || '.' || CASE WHEN {frac} = 0 THEN '0' "
        f"ELSE rtrim(lpad(CAST({frac} AS VARCHAR), 6, '0'), '0') END"
    )


DAY_US = duration_us(P.TUMBLE)
TUMBLED = f"SELECT *, {_start_us('ts', P.TUMBLE)} AS ws FROM ({SV})"


def _tumble_agg(aggs: str, keys: str = "id") -> str:
    sel = f"{keys}, " if keys else ""
    grp = f"{keys}, ws" if keys else "ws"
    return (
        f"SELECT {sel}{_ts('ws')} AS win_start, {_ts(f'ws + {DAY_US}')} AS win_end, {aggs} "
        f"FROM ({TUMBLED}) GROUP BY {grp}"
    )


def _sliding(size: str, slide: str, offset: str | None = None, aggs: str = "count(*) AS cnt, round(sum(vc), 2) AS sum_vc") -> str:
    s, sl = duration_us(size), duration_us(slide)
    n = -(-s // sl)
    last = _start_us("ts", slide, offset)
    return (
        f"SELECT id, {_ts('st')} AS win_start, {_ts(f'st + {s}')} AS win_end, {aggs} "
        f"FROM (SELECT *, {last} - k * {sl} AS st FROM ({SV}), range(0, {n}) t(k)) "
        f"WHERE epoch_us(ts) >= st AND epoch_us(ts) < st + {s} GROUP BY id, st"
    )


def _session(gap_sql: str, aggs: str = "count(*) AS cnt") -> str:
    return (
        f"WITH b AS (SELECT seq, id, ts, vc, epoch_us(ts) AS x, {gap_sql} AS g FROM ({SV})), "
        "f AS (SELECT *, CASE WHEN x <= max(x + g) OVER (PARTITION BY id ORDER BY x, seq "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS nf FROM b), "
        "s AS (SELECT *, sum(nf) OVER (PARTITION BY id ORDER BY x, seq ROWS UNBOUNDED PRECEDING) AS sid FROM f) "
        f"SELECT id, {_ts('min(x)')} AS win_start, {_ts('max(x + g)')} AS win_end, {aggs} "
        "FROM s GROUP BY id, sid"
    )


RUN_W = "WINDOW w AS (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
RANKED = f"SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq) AS rn FROM ({SV})"


def _late(lateness: str) -> str:
    hour = duration_us(P.LATE_SIZE)
    bound = duration_us(P.LATE_BOUND)
    lat = duration_us(lateness)
    arrival = f"event_id + (event_id * {P.ARRIVAL_MULT}) % {P.ARRIVAL_MOD}"
    return (
        f"WITH a AS (SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS id, ts, value AS vc, {arrival} AS arrival "
        "FROM events), "
        "w AS (SELECT *, epoch_us(max(ts) OVER (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) "
        f"- {bound} AS wm, {_start_us('ts', P.LATE_SIZE)} AS ws FROM a), "
        f"c AS (SELECT *, COALESCE(ws + {hour} <= wm, false) AS late, "
        f"COALESCE(ws + {hour} + {lat} <= wm, false) AS dropped FROM w)"
    )


def _late_on_time(lateness: str) -> str:
    hour = duration_us(P.LATE_SIZE)
    return (
        _late(lateness)
        + f" SELECT id, {_ts('ws')} AS win_start, {_ts(f'ws + {hour}')} AS win_end, round(sum(vc), 2) AS sum_vc, "
        "count(*) AS cnt FROM c WHERE NOT late GROUP BY id, ws"
    )


def _allowed_lateness() -> str:
    return (
        _late(P.LATE_LATENESS)
        + ", o AS (SELECT id, ws, sum(vc) AS s, count(*) AS n FROM c WHERE NOT late GROUP BY id, ws), "
        "k AS (SELECT id, ws, row_number() OVER (PARTITION BY id, ws ORDER BY arrival, seq) AS firing, "
        "sum(vc) OVER (PARTITION BY id, ws ORDER BY arrival, seq ROWS UNBOUNDED PRECEDING) AS ls "
        "FROM c WHERE late AND NOT dropped) "
        f"SELECT id, {_ts('ws')} AS win_start, CAST(0 AS BIGINT) AS firing, round(s, 2) AS sum_vc, n AS cnt FROM o "
        f"UNION ALL SELECT k.id, {_ts('k.ws')} AS win_start, k.firing, round(COALESCE(o.s, 0) + k.ls, 2) AS sum_vc, "
        "COALESCE(o.n, 0) + k.firing AS cnt FROM k LEFT JOIN o ON k.id = o.id AND k.ws = o.ws"
    )


def _evicted(kept_sql: str) -> str:
    return (
        f"SELECT id, {_ts('ws')} AS win_start, round(sum(vc), 2) AS sum_vc, count(*) AS cnt "
        f"FROM ({kept_sql}) GROUP BY id, ws"
    )


def _max_rec(fields: str, out: str) -> str:
    return f"struct_extract(max({{{fields}}}) OVER w, '{out}')"


EVICT_TIME_US = duration_us(P.EVICT_TIME)
REC_LAST = "'f': vc, 't': seq, 'ts': ts, 'vc': vc"
REC_FIRST = "'f': vc, 't': -seq, 'ts': ts, 'vc': vc"

ORACLE: dict[str, str] = {
    "rolling_reduce_udf": f"SELECT seq, id, last_value(ts) OVER w AS ts, max(vc) OVER w AS vc FROM ({SV}) {RUN_W}",
    "window_avg_udaf": (
        f"SELECT id, {_ts('ws')} AS win_start, round(avg(vc), 6) AS avg_vc FROM ({TUMBLED}) GROUP BY id, ws"
    ),
    "document_lines": LINES,
    "split_words": WORDS,
    "word_pairs": f"SELECT word, CAST(1 AS BIGINT) AS one FROM ({WORDS})",
    "word_count": f"SELECT word, CAST(count(*) AS BIGINT) AS cnt FROM ({WORDS}) GROUP BY word",
    "word_count_key_expr": (
        f"SELECT substring(word, 1, 1) AS initial, CAST(count(*) AS BIGINT) AS cnt FROM ({WORDS}) GROUP BY 1"
    ),
    "process_split_comma": (
        "SELECT doc_id, line_no, CAST(generate_subscripts(p, 1) - 1 AS INTEGER) AS pos, unnest(p) AS part FROM ("
        f"SELECT doc_id, line_no, {_jsplit('value', ',')} AS p FROM ({LINES}))"
    ),
    "process_split_fn": (
        "SELECT doc_id, line_no, CAST(generate_subscripts(p, 1) - 1 AS INTEGER) AS pos, unnest(p) AS part FROM ("
        f"SELECT doc_id, line_no, {_jsplit('value', ',')} AS p FROM ({LINES}))"
    ),
    "process_side_output_fn": (
        f"SELECT seq, id, round(vc - {P.ALERT}, 2) AS excess, ts FROM ({SV}) WHERE vc > {P.ALERT}"
    ),
    "process_key_sum": (
        "SELECT doc_id, line_no, pos, word, "
        f"row_number() OVER (PARTITION BY word ORDER BY doc_id, line_no, pos) AS cnt FROM ({WORDS})"
    ),
    "text_length": f"SELECT doc_id, {UTF16_LEN} AS len_utf16 FROM documents",
    "parse_sensor_csv": SV_MS,
    "rich_map_parse": SV_MS,
    "sensor_to_json": (
        "SELECT seq, '{\"id\":\"' || id || '\",\"ts\":' || CAST(ts AS VARCHAR) || ',\"vc\":' || CAST(vc AS VARCHAR) "
        f"|| '}}' AS json FROM ({SV_MS})"
    ),
    "sensor_to_doc": (
        "SELECT seq, 'sensor1' AS index, '{\"ts\":\"' || CAST(ts AS VARCHAR) || '\",\"vc\":\"' || CAST(vc AS VARCHAR) "
        f"|| '\"}}' AS doc FROM ({SV_MS})"
    ),
    "sensor_to_kv": f"SELECT seq, id AS key, CAST(vc AS VARCHAR) AS value FROM ({SV_MS})",
    "sensor_to_string": (
        "SELECT seq, 'WaterSensor{id=''' || id || ''', ts=' || CAST(ts AS VARCHAR) || ', vc=' || CAST(vc AS VARCHAR) "
        f"|| '}}' AS text FROM ({SV_MS})"
    ),
    "rolling_sum": f"SELECT seq, id, first_value(ts) OVER w AS ts, round(sum(vc) OVER w, 2) AS vc FROM ({SV}) {RUN_W}",
    "rolling_max": f"SELECT seq, id, first_value(ts) OVER w AS ts, max(vc) OVER w AS vc FROM ({SV}) {RUN_W}",
    "rolling_max_by_last": (
        f"SELECT seq, id, {_max_rec(REC_LAST, 'ts')} AS ts, "
        f"{_max_rec(REC_LAST, 'vc')} AS vc FROM ({SV}) {RUN_W}"
    ),
    "rolling_max_by_first": (
        f"SELECT seq, id, {_max_rec(REC_FIRST, 'ts')} AS ts, "
        f"{_max_rec(REC_FIRST, 'vc')} AS vc FROM ({SV}) {RUN_W}"
    ),
    "rolling_reduce": f"SELECT seq, id, last_value(ts) OVER w AS ts, max(vc) OVER w AS vc FROM ({SV}) {RUN_W}",
    "final_max": f"SELECT id, arg_min(ts, seq) AS ts, max(vc) AS vc FROM ({SV}) GROUP BY id",
    "final_max_by": (
        "SELECT id, struct_extract(max({'f': vc, 't': seq, 'ts': ts, 'vc': vc}), 'ts') AS ts, "
        f"struct_extract(max({{'f': vc, 't': seq, 'ts': ts, 'vc': vc}}), 'vc') AS vc FROM ({SV}) GROUP BY id"
    ),
    "final_reduce": f"SELECT id, arg_max(ts, seq) AS ts, max(vc) AS vc FROM ({SV}) GROUP BY id",
    "union_all": (
        f"SELECT *, 'click' AS src FROM ({SV}) WHERE event_type = 'click' UNION ALL "
        f"SELECT *, 'view' AS src FROM ({SV}) WHERE event_type = 'view' UNION ALL "
        f"SELECT *, 'all' AS src FROM ({SV})"
    ),
    "connect_comap": (
        f"SELECT 1 AS side, id AS value FROM ({SV}) UNION ALL "
        f"SELECT 2 AS side, CAST({UTF16_LEN} AS VARCHAR) AS value FROM documents"
    ),
    "tumbling_sum": _tumble_agg("count(*) AS cnt, round(sum(vc), 2) AS sum_vc"),
    "tumbling_offset_sum": (
        f"SELECT id, {_ts('ws')} AS win_start, {_ts(f'ws + {DAY_US}')} AS win_end, count(*) AS cnt, "
        f"round(sum(vc), 2) AS sum_vc FROM (SELECT *, {_start_us('ts', P.TUMBLE, P.TUMBLE_OFFSET)} AS ws "
        f"FROM ({SV})) GROUP BY id, ws"
    ),
    "sliding_sum": _sliding(P.SLIDE_SIZE, P.SLIDE_STEP),
    "sliding_offset_sum": _sliding(P.SLIDE_OFF_SIZE, P.SLIDE_OFF_STEP, P.SLIDE_OFF_OFFSET),
    "sliding_min_udf": _sliding(P.SLIDE_OFF_SIZE, P.SLIDE_OFF_STEP, P.SLIDE_OFF_OFFSET, "min(vc) AS min_vc"),
    "count_sliding_max_udf": (
        f"SELECT id, rn // {P.COUNT_SLIDE} AS fire, n_elems, max_vc FROM (SELECT id, rn, "
        f"max(vc) OVER s AS max_vc, count(*) OVER s AS n_elems FROM ({RANKED}) "
        f"WINDOW s AS (PARTITION BY id ORDER BY rn ROWS BETWEEN {P.COUNT_SIZE - 1} PRECEDING AND CURRENT ROW)) "
        f"WHERE rn % {P.COUNT_SLIDE} = 0"
    ),
    "trigger_purging_fn": (
        f"SELECT id, {_ts('ws')} AS win_start, (rn - 1) // {P.TRIGGER_EVERY} AS firing, count(*) AS cnt, round(sum(vc), 2) AS sum_vc "
        f"FROM (SELECT *, row_number() OVER (PARTITION BY id, ws ORDER BY ts) AS rn FROM "
        f"(SELECT *, {_start_us('ts', P.TRIGGER_SIZE)} AS ws FROM ({SV}))) "
        f"GROUP BY id, ws, firing HAVING count(*) = {P.TRIGGER_EVERY}"
    ),
    "session_count": _session(str(duration_us(P.SESSION_GAP))),
    "session_dynamic_count": _session(
        f"CASE WHEN event_type = 'purchase' THEN {duration_us(P.DYN_GAP_PURCHASE)} "
        f"ELSE {duration_us(P.DYN_GAP_OTHER)} END"
    ),
    "session_reduce_udf": _session(
        str(duration_us(P.SESSION_GAP)),
        "arg_min(seq, {'v': vc, 'o': seq}) AS seq, arg_min(ts, {'v': vc, 'o': seq}) AS ts, min(vc) AS vc",
    ),
    "session_avg_udaf": _session(
        f"CASE WHEN event_type = 'purchase' THEN {duration_us(P.DYN_GAP_PURCHASE)} "
        f"ELSE {duration_us(P.DYN_GAP_OTHER)} END",
        "round(avg(vc), 6) AS avg_vc",
    ),
    "window_all_sum": _tumble_agg("count(*) AS cnt, round(sum(vc), 2) AS sum_vc", keys=""),
    "window_meta": (
        f"SELECT id, {_ts('ws')} AS win_start, {_ts(f'ws + {DAY_US}')} AS win_end, "
        f"{_ts(f'ws + {DAY_US} - 1000')} AS max_ts, count(*) AS cnt FROM ({TUMBLED}) GROUP BY id, ws"
    ),
    "window_reduce_sum": f"SELECT id, {_ts('ws')} AS win_start, round(sum(vc), 2) AS sum_vc FROM ({TUMBLED}) GROUP BY id, ws",
    "tumbling_agg_label": (
        f"SELECT {_java_ts_text(_ts('ws'))} || ':' || id AS label, count(*) AS cnt FROM ({TUMBLED}) GROUP BY id, ws"
    ),
    "window_avg": f"SELECT id, {_ts('ws')} AS win_start, round(avg(vc), 6) AS avg_vc FROM ({TUMBLED}) GROUP BY id, ws",
    "window_fold_concat": (
        f"SELECT id, {_ts('ws')} AS win_start, string_agg(event_type, '' ORDER BY seq) AS folded "
        f"FROM ({TUMBLED}) GROUP BY id, ws"
    ),
    "tumbling_process_count": (
        f"SELECT {_java_ts_text(_ts('ws'))} || ':' || id AS label, count(*) AS cnt FROM ({TUMBLED}) GROUP BY id, ws"
    ),
    "tumbling_process_fn": (
        f"SELECT {_java_ts_text(_ts('ws'))} || ':' || id AS label, count(*) AS cnt FROM ({TUMBLED}) GROUP BY id, ws"
    ),
    "tumbling_apply_count": (
        f"SELECT {_java_ts_text(_ts('ws'))} || ':(' || id || ')' AS label, count(*) AS cnt "
        f"FROM ({TUMBLED}) GROUP BY id, ws"
    ),
    "window_count_text": (
        "SELECT id, 'Window: TimeWindow{start=' || CAST(ws // 1000 AS VARCHAR) || ', end=' || "
        f"CAST((ws + {DAY_US}) // 1000 AS VARCHAR) || '}}count: ' || CAST(count(*) AS VARCHAR) AS text "
        f"FROM ({TUMBLED}) GROUP BY id, ws"
    ),
    "window_min_record": (
        f"SELECT id, {_ts('ws')} AS win_start, "
        "struct_extract(min({'v': vc, 'o': seq, 'seq': seq, 'ts': ts, 'vc': vc}), 'seq') AS seq, "
        "struct_extract(min({'v': vc, 'o': seq, 'seq': seq, 'ts': ts, 'vc': vc}), 'ts') AS ts, "
        "struct_extract(min({'v': vc, 'o': seq, 'seq': seq, 'ts': ts, 'vc': vc}), 'vc') AS vc "
        f"FROM ({TUMBLED}) GROUP BY id, ws"
    ),
    "window_reduce_udf": (
        f"SELECT id, {_ts('ws')} AS win_start, "
        "struct_extract(min({'v': vc, 'o': seq, 'seq': seq, 'ts': ts, 'vc': vc}), 'seq') AS seq, "
        "struct_extract(min({'v': vc, 'o': seq, 'seq': seq, 'ts': ts, 'vc': vc}), 'ts') AS ts, "
        "struct_extract(min({'v': vc, 'o': seq, 'seq': seq, 'ts': ts, 'vc': vc}), 'vc') AS vc "
        f"FROM ({TUMBLED}) GROUP BY id, ws"
    ),
    "window_fold_expr": (
        f"SELECT id, {_ts('ws')} AS win_start, list_reduce(list(CAST(round(vc * 100) AS BIGINT) ORDER BY seq), "
        f"lambda a, x: (a * 31 + x) % 1000003, 0::BIGINT) AS folded FROM ({TUMBLED}) GROUP BY id, ws"
    ),
    "window_key_avg": f"SELECT id, round(avg(vc), 6) AS avg_vc FROM ({TUMBLED}) GROUP BY id, ws",
    "window_end_count": f"SELECT id, {_ts(f'ws + {DAY_US}')} AS win_end, count(*) AS cnt FROM ({TUMBLED}) GROUP BY id, ws",
    "count_tumbling_sum": (
        f"SELECT id, (rn - 1) // {P.COUNT_SIZE} AS win_idx, max(seq) AS fire_seq, round(sum(vc), 2) AS sum_vc "
        f"FROM ({RANKED}) GROUP BY id, (rn - 1) // {P.COUNT_SIZE} HAVING count(*) = {P.COUNT_SIZE}"
    ),
    "count_sliding_sum": (
        "SELECT id, fire_rn, sum_vc, n_elems FROM (SELECT id, rn AS fire_rn, "
        f"round(sum(vc) OVER s, 2) AS sum_vc, count(*) OVER s AS n_elems FROM ({RANKED}) "
        f"WINDOW s AS (PARTITION BY id ORDER BY rn ROWS BETWEEN {P.COUNT_SIZE - 1} PRECEDING AND CURRENT ROW)) "
        f"WHERE fire_rn % {P.COUNT_SLIDE} = 0"
    ),
    "global_count_trigger": (
        "SELECT id, fire_seq, sum_vc FROM (SELECT id, rn, seq AS fire_seq, "
        f"round(sum(vc) OVER (PARTITION BY id ORDER BY rn ROWS UNBOUNDED PRECEDING), 2) AS sum_vc FROM ({RANKED})) "
        f"WHERE rn % {P.GLOBAL_EVERY} = 0"
    ),
    "global_count_purge": (
        f"SELECT id, max(seq) AS fire_seq, round(sum(vc), 2) AS sum_vc FROM ({RANKED}) "
        f"GROUP BY id, (rn - 1) // {P.GLOBAL_EVERY} HAVING count(*) = {P.GLOBAL_EVERY}"
    ),
    "evict_count_sum": _evicted(
        f"SELECT * FROM ({TUMBLED}) QUALIFY row_number() OVER (PARTITION BY id, ws ORDER BY seq DESC) <= {P.EVICT_KEEP}"
    ),
    "evict_delta_sum": _evicted(
        f"SELECT * FROM (SELECT *, last_value(vc) OVER (PARTITION BY id, ws ORDER BY seq "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS lastv FROM ({TUMBLED})) "
        f"WHERE NOT (abs(lastv - vc) >= {P.EVICT_DELTA})"
    ),
    "evict_time_sum": _evicted(
        f"SELECT * FROM (SELECT *, max(epoch_us(ts)) OVER (PARTITION BY id, ws) AS mx FROM ({TUMBLED})) "
        f"WHERE epoch_us(ts) > mx - {EVICT_TIME_US}"
    ),
    "late_dropped_sum": _late_on_time("0 seconds"),
    "allowed_lateness_sum": _allowed_lateness(),
    "late_side_output": _late(P.LATE_LATENESS) + " SELECT seq, id, ts, vc FROM c WHERE dropped",
    "kv_upsert_latest": (
        "SELECT CAST(user_id AS VARCHAR) AS key, CAST(arg_max(value, event_id) AS VARCHAR) AS value "
        "FROM events GROUP BY user_id"
    ),
    "jdbc_upsert_latest": (
        "SELECT CAST(user_id AS VARCHAR) AS id, epoch_us(arg_max(ts, event_id)) // 1000 AS ts, arg_max(value, event_id) AS vc "
        "FROM events GROUP BY user_id"
    ),
}
