"""Registered queries: one per operator of the inventory, over the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names equal those of the matching SQL in ``plans.oracle``. Doubles that are sums
are rounded to cents (the table's values have two decimals), averages to six
places, so both engines agree despite different summation orders.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.fixed import INDEX_NAME
from eddyline.functions.text import (
    java_split,
    parse_sensor,
    sensor_to_doc,
    sensor_to_json,
    sensor_to_kv,
    sensor_to_string,
    utf16_length,
)
from eddyline.operators import count_windows as cw
from eddyline.operators import evictors as ev
from eddyline.operators import keyed, late
from eddyline.operators import sliding_fns as sf_
from eddyline.operators import user_windows as uw
from eddyline.operators import window_fns as wf
from eddyline.operators import windows as win
from eddyline.operators.combine import connect_comap, union_all
from eddyline.operators.prefix import Running, running
from eddyline.operators import udaf
from eddyline.operators.process import process
from eddyline.operators.process_fns import AlertFunction, SplitFunction
from eddyline.operators.rich_map import SensorLineParser, rich_map
from eddyline.operators.udf_reduce import latest_max_reducer, rolling_reduce_fn
from eddyline.operators.windows import duration_us
from eddyline.plans import params as P
from eddyline.sinks.writers import latest_per_key
from eddyline.streaming import stateful as st
from eddyline.streaming.bounded import run_bounded
from eddyline.sources.tables import document_lines, epoch_millis, sensor_lines, sensor_view, table

Query = Callable[[SparkSession, str], DataFrame]


def _r2(c):
    return F.round(c, 2)


# ---------------------------------------------------------------- words


def _words(spark, sf) -> DataFrame:
    """(doc_id, line_no, pos, word): one row per word, lines split on one space."""
    lines = document_lines(spark, sf)
    return lines.select("doc_id", "line_no", F.posexplode(java_split("value", " ")).alias("pos", "word"))


def q_document_lines(spark, sf):
    return document_lines(spark, sf)


def q_split_words(spark, sf):
    return _words(spark, sf)


def q_word_pairs(spark, sf):
    return keyed.word_pairs(_words(spark, sf))


def q_word_count(spark, sf):
    return keyed.keyed_sum(keyed.word_pairs(_words(spark, sf)), "word", "one").withColumnRenamed("one", "cnt")


def q_word_count_key_expr(spark, sf):
    pairs = keyed.word_pairs(_words(spark, sf))
    return pairs.groupBy(keyed.key_expr("substring(word, 1, 1)").alias("initial")).agg(F.sum("one").alias("cnt"))


def q_process_split_fn(spark, sf):
    """The same split as a user process function: 0 to n rows per element."""
    lines = document_lines(spark, sf)
    make = functools.partial(SplitFunction, ("doc_id", "line_no"), ",")
    return process(lines, make, "doc_id long, line_no int, pos int, part string").main


def q_process_side_output_fn(spark, sf):
    """A process function's side output: readings above a limit with their excess and time."""
    rows = sensor_view(spark, sf).select("seq", "id", "ts", "vc")
    alerts = "seq long, id string, excess double, ts timestamp_ntz"
    out = process(rows, functools.partial(AlertFunction, P.ALERT), "seq long, id string, vc double", {"alerts": alerts}, ts="ts")
    return out.side("alerts").select("seq", "id", _r2("excess").alias("excess"), "ts")


def q_process_split_comma(spark, sf):
    lines = document_lines(spark, sf)
    return lines.select("doc_id", "line_no", F.posexplode(java_split("value", ",")).alias("pos", "part"))


def q_process_key_sum(spark, sf):
    """process -> (part, 1) -> keyBy(part).sum(1): the running count of each word
    in arrival order (doc, line, position)."""
    w = _words(spark, sf)
    out = running(w, ["word"], ["doc_id", "line_no", "pos"], [Running("cnt", "count", F.lit(1))])
    return out.select("doc_id", "line_no", "pos", "word", "cnt")


def q_text_length(spark, sf):
    return table(spark, sf, "documents").select("doc_id", utf16_length("text").alias("len_utf16"))


# ---------------------------------------------------------------- sensor records


def q_parse_sensor_csv(spark, sf):
    parsed, _ = parse_sensor(sensor_lines(spark, sf), keep=("seq",))
    return parsed


def q_rich_map_parse(spark, sf):
    return rich_map(
        sensor_lines(spark, sf),
        lambda: SensorLineParser(keep=("seq",)),
        "seq long, id string, ts long, vc double",
    )


def _sensor_ms(spark, sf):
    s = sensor_view(spark, sf)
    return s.select("seq", "id", epoch_millis("ts").alias("ts"), "vc")


def q_sensor_to_json(spark, sf):
    return _sensor_ms(spark, sf).select("seq", sensor_to_json().alias("json"))


def q_sensor_to_doc(spark, sf):
    s = _sensor_ms(spark, sf)
    return s.select("seq", F.lit(INDEX_NAME).alias("index"), F.to_json(sensor_to_doc()).alias("doc"))


def q_sensor_to_kv(spark, sf):
    s = _sensor_ms(spark, sf)
    return s.select("seq", sensor_to_kv().alias("_kv")).select("seq", "_kv.key", "_kv.value")


def q_sensor_to_string(spark, sf):
    return _sensor_ms(spark, sf).select("seq", sensor_to_string().alias("text"))


# ---------------------------------------------------------------- keyed aggregates


def _sv(spark, sf):
    return sensor_view(spark, sf).select("seq", "id", "ts", "vc")


def q_rolling_sum(spark, sf):
    out = keyed.keyed_sum(_sv(spark, sf), "id", "vc", order="seq", emit="rolling", carry=("ts",))
    return out.select("seq", "id", "ts", _r2("vc").alias("vc"))


def q_rolling_max(spark, sf):
    return keyed.keyed_max(_sv(spark, sf), "id", "vc", "seq", carry=("ts",))


def q_rolling_max_by_last(spark, sf):
    return keyed.keyed_max_by(_sv(spark, sf), "id", "vc", "seq", record=("ts", "vc"), first=False)


def q_rolling_max_by_first(spark, sf):
    return keyed.keyed_max_by(_sv(spark, sf), "id", "vc", "seq", record=("ts", "vc"), first=True)


def q_rolling_reduce(spark, sf):
    return keyed.keyed_reduce_latest_max(_sv(spark, sf), "id", "vc", "seq", latest=("ts",))


def q_rolling_reduce_udf(spark, sf):
    """The same reducer as ``rolling_reduce`` given as a Python function."""
    out = rolling_reduce_fn(_sv(spark, sf), "id", "seq", ["ts", "vc"], latest_max_reducer("vc", ("ts",)))
    return out.select("seq", "id", "ts", "vc")


def q_final_max(spark, sf):
    return keyed.keyed_max(_sv(spark, sf), "id", "vc", "seq", emit="final", carry=("ts",))


def q_final_max_by(spark, sf):
    return keyed.keyed_max_by(_sv(spark, sf), "id", "vc", "seq", record=("ts", "vc"), emit="final")


def q_final_reduce(spark, sf):
    return keyed.keyed_reduce_latest_max(_sv(spark, sf), "id", "vc", "seq", latest=("ts",), emit="final")


# ---------------------------------------------------------------- union / connect


def q_union_all(spark, sf):
    s = sensor_view(spark, sf)
    return union_all(
        s.filter(F.col("event_type") == "click").withColumn("src", F.lit("click")),
        s.filter(F.col("event_type") == "view").withColumn("src", F.lit("view")),
        s.withColumn("src", F.lit("all")),
    )


def q_connect_comap(spark, sf):
    """Side 1: sensor ids as they are; side 2: document text -> its length. The
    result is shown as the printed value (one text column, no null-padded columns)."""
    tagged = connect_comap(
        sensor_view(spark, sf),
        table(spark, sf, "documents"),
        lambda d: F.col("id"),
        lambda d: utf16_length("text"),
    )
    return tagged.select("side", F.coalesce("str_value", F.col("int_value").cast("string")).alias("value"))


# ---------------------------------------------------------------- time windows


def _sums():
    return [win.Pane("cnt", "count", F.lit(1)), win.Pane("sum_vc", "sum", "vc")]


def q_tumbling_sum(spark, sf):
    return win.window_agg(
        _sv(spark, sf), ["id"], win.tumbling("ts", P.TUMBLE), F.count(F.lit(1)).alias("cnt"), _r2(F.sum("vc")).alias("sum_vc")
    )


def q_tumbling_offset_sum(spark, sf):
    return win.window_agg(
        _sv(spark, sf),
        ["id"],
        win.tumbling("ts", P.TUMBLE, P.TUMBLE_OFFSET),
        F.count(F.lit(1)).alias("cnt"),
        _r2(F.sum("vc")).alias("sum_vc"),
    )


def q_sliding_sum(spark, sf):
    out = win.sliding_agg(_sv(spark, sf), ["id"], "ts", P.SLIDE_SIZE, P.SLIDE_STEP, _sums())
    return out.withColumn("sum_vc", _r2("sum_vc"))


def q_sliding_offset_sum(spark, sf):
    out = win.sliding_agg(_sv(spark, sf), ["id"], "ts", P.SLIDE_OFF_SIZE, P.SLIDE_OFF_STEP, _sums(), P.SLIDE_OFF_OFFSET)
    return out.withColumn("sum_vc", _r2("sum_vc"))


def q_session_count(spark, sf):
    return win.session_windows(_sv(spark, sf), ["id"], "ts", P.SESSION_GAP, F.count(F.lit(1)).alias("cnt"), order="seq")


def q_session_dynamic_count(spark, sf):
    s = sensor_view(spark, sf)
    gap = F.when(F.col("event_type") == "purchase", F.lit(P.DYN_GAP_PURCHASE)).otherwise(F.lit(P.DYN_GAP_OTHER))
    return win.session_windows(s, ["id"], "ts", gap, F.count(F.lit(1)).alias("cnt"), order="seq")


def q_window_all_sum(spark, sf):
    return win.window_agg(
        _sv(spark, sf), [], win.tumbling("ts", P.TUMBLE), F.count(F.lit(1)).alias("cnt"), _r2(F.sum("vc")).alias("sum_vc")
    )


def q_window_meta(spark, sf):
    out = win.window_agg(_sv(spark, sf), ["id"], win.tumbling("ts", P.TUMBLE), F.count(F.lit(1)).alias("cnt"))
    return out.select("id", "win_start", "win_end", win.max_timestamp("win_end").alias("max_ts"), "cnt")


def _tumbled(spark, sf, *aggs):
    return win.window_agg(_sv(spark, sf), ["id"], win.tumbling("ts", P.TUMBLE), *aggs)


def q_window_reduce_sum(spark, sf):
    return _tumbled(spark, sf, _r2(F.sum("vc")).alias("sum_vc")).select("id", "win_start", "sum_vc")


def q_tumbling_agg_label(spark, sf):
    out = _tumbled(spark, sf, F.count(F.lit(1)).alias("cnt"))
    return out.select(wf.label("win_start", "id").alias("label"), "cnt")


def q_window_avg(spark, sf):
    return _tumbled(spark, sf, F.round(F.avg("vc"), 6).alias("avg_vc")).select("id", "win_start", "avg_vc")


def q_window_avg_udaf(spark, sf):
    """Average through a user aggregate function (create/add/merge/result)."""
    s = _sv(spark, sf)
    s = s.withColumn("win_start", win.tumbling("ts", P.TUMBLE).start)
    out = udaf.aggregate(s, ["id", "win_start"], "vc", udaf.AverageFunction(), "double", "avg_vc")
    return out.select("id", "win_start", F.round("avg_vc", 6).alias("avg_vc"))


def q_window_fold_concat(spark, sf):
    s = sensor_view(spark, sf)
    w = win.tumbling("ts", P.TUMBLE)
    wf.check_fold_allowed(w)
    s = s.withColumn("win_start", w.start)
    return wf.fold_concat_by(s, ["id", "win_start"], "seq", "event_type").select("id", "win_start", "folded")


def q_window_fold_expr(spark, sf):
    """A fold given as expressions: a checksum over a window's values (in cents) in order. Its steps
    ``acc * 31 + x`` are linear maps, so they compose."""
    modulus = 1000003
    cents = lambda x: F.round(x["vc"] * 100).cast("long") % modulus
    out = wf.window_fold_composed(
        _sv(spark, sf), ["id"], win.tumbling("ts", P.TUMBLE), "seq",
        lambda x: F.struct(F.lit(31).cast("long").alias("a"), cents(x).alias("b")),
        lambda f, g: F.struct((f["a"] * g["a"] % modulus).alias("a"), ((f["b"] * g["a"] + g["b"]) % modulus).alias("b")),
        lambda f: f["b"], ["vc"],
    )
    return out.select("id", "win_start", "folded")


def q_count_sliding_max_udf(spark, sf):
    """A user function without an inverse over sliding count windows."""
    out = sf_.count_sliding_aggregate(_sv(spark, sf), ["id"], ["seq"], P.COUNT_SIZE, P.COUNT_SLIDE, "vc", udaf.ReduceFunction(max), "double", "max_vc")
    return out.select("id", "fire", "n_elems", "max_vc")


def q_sliding_min_udf(spark, sf):
    """The same over sliding time windows with an offset."""
    out = sf_.sliding_aggregate(
        _sv(spark, sf), ["id"], "ts", P.SLIDE_OFF_SIZE, P.SLIDE_OFF_STEP, "vc", udaf.ReduceFunction(min), "double", "min_vc", P.SLIDE_OFF_OFFSET
    )
    return out.select("id", "win_start", "win_end", "min_vc")


def q_window_reduce_udf(spark, sf):
    """A user reducer per window: the minimum record, as Python."""
    out = wf.window_reduce(_sv(spark, sf), ["id"], "ts", lambda ts: win.tumbling(ts, P.TUMBLE), ["seq", "ts", "vc"], wf.smaller_record("vc", "seq"))
    return out.select("id", "win_start", "seq", "ts", "vc")


def q_session_reduce_udf(spark, sf):
    """A user reducer on merging windows: each session's minimum record, as Python."""
    out = wf.window_reduce(_sv(spark, sf), ["id"], "ts", None, ["seq", "ts", "vc"], wf.smaller_record("vc", "seq"), gap=P.SESSION_GAP, order="seq")
    return out.select("id", "win_start", "win_end", "seq", "ts", "vc")


def q_session_avg_udaf(spark, sf):
    """A user aggregate function on sessions with a gap by element."""
    s = sensor_view(spark, sf)
    gap = F.when(F.col("event_type") == "purchase", F.lit(P.DYN_GAP_PURCHASE)).otherwise(F.lit(P.DYN_GAP_OTHER))
    out = uw.session_aggregate(s, ["id"], "ts", gap, "vc", udaf.AverageFunction(), "double", "avg_vc", order="seq")
    return out.select("id", "win_start", "win_end", F.round("avg_vc", 6).alias("avg_vc"))


def q_trigger_purging_fn(spark, sf):
    """A user trigger over a table: the stream's processor, run to a final watermark."""
    s = sensor_view(spark, sf)
    s = s.select("seq", F.col("id").alias("key"), F.timestamp_micros(uw.micros(s, F.col("ts"))).alias("ts"), F.col("vc").alias("value"))
    trigger = st.PurgingTrigger(st.CountTrigger(P.TRIGGER_EVERY))
    processor = st.TriggeredWindowProcessor(duration_us(P.TRIGGER_SIZE) // 1000, trigger)
    schema = (
        "key string, win_start_ms long, win_end_ms long, sum_value double, cnt long, "
        "watermark_ms long, proc_time_ms long, key_total long, firing long"
    )
    out = run_bounded(s, "ts", lambda rows: rows.groupBy("key").transformWithState(processor, schema, "Update", "EventTime"))
    start = F.timestamp_add("MICROSECOND", F.col("win_start_ms") * 1000, F.expr(uw.EPOCH))
    return out.select(F.col("key").alias("id"), start.alias("win_start"), "firing", "cnt", _r2("sum_value").alias("sum_vc"))


def q_tumbling_process_count(spark, sf):
    out = _tumbled(spark, sf, F.count(F.lit(1)).alias("cnt"))
    return out.select(wf.label("win_start", "id").alias("label"), "cnt")


def q_tumbling_process_fn(spark, sf):
    """The process-window function run as Python over each window's elements."""
    w = win.tumbling("ts", P.TUMBLE)
    s = _sv(spark, sf).withColumn("win_start", w.start).withColumn("win_end", w.end)
    return wf.apply_window(s, ["id"], wf.count_label_process("id"), "label string, cnt long", ["seq"])


def q_tumbling_apply_count(spark, sf):
    out = _tumbled(spark, sf, F.count(F.lit(1)).alias("cnt"))
    return out.select(wf.label("win_start", "id", tuple_key=True).alias("label"), "cnt")


def q_window_count_text(spark, sf):
    out = _tumbled(spark, sf, F.count(F.lit(1)).alias("cnt"))
    text = wf.window_count_text(win.window_text("win_start", "win_end"), F.col("cnt"))
    return out.select("id", text.alias("text"))


def q_window_min_record(spark, sf):
    out = _tumbled(spark, sf, wf.min_record("vc", "seq", ("seq", "ts", "vc")).alias("_m"))
    return out.select("id", "win_start", *[F.col("_m").getField(c).alias(c) for c in ("seq", "ts", "vc")])


def q_window_key_avg(spark, sf):
    return _tumbled(spark, sf, F.round(F.avg("vc"), 6).alias("avg_vc")).select("id", "avg_vc")


def q_window_end_count(spark, sf):
    return _tumbled(spark, sf, F.count(F.lit(1)).alias("cnt")).select("id", "win_end", "cnt")


# ---------------------------------------------------------------- count / global windows, triggers


def q_count_tumbling_sum(spark, sf):
    out = cw.count_tumbling(_sv(spark, sf), "id", "seq", P.COUNT_SIZE, F.sum("vc").alias("sum_vc"))
    return out.select("id", "win_idx", "fire_seq", _r2("sum_vc").alias("sum_vc"))


def q_count_sliding_sum(spark, sf):
    out = cw.count_sliding(_sv(spark, sf), "id", "seq", P.COUNT_SIZE, P.COUNT_SLIDE, "vc")
    return out.select("id", "fire_rn", _r2("sum_vc").alias("sum_vc"), "n_elems")


def q_global_count_trigger(spark, sf):
    out = cw.global_count_trigger(_sv(spark, sf), "id", "seq", P.GLOBAL_EVERY, "vc")
    return out.select("id", "fire_seq", _r2("sum_vc").alias("sum_vc"))


def q_global_count_purge(spark, sf):
    out = cw.global_count_trigger(_sv(spark, sf), "id", "seq", P.GLOBAL_EVERY, "vc", purge=True)
    return out.select("id", "fire_seq", _r2("sum_vc").alias("sum_vc"))


# ---------------------------------------------------------------- evictors


def _with_tumble(spark, sf):
    s = _sv(spark, sf)
    w = win.tumbling("ts", P.TUMBLE)
    return s.withColumn("win_start", w.start)


def _evicted_sum(df):
    return df.groupBy("id", "win_start").agg(_r2(F.sum("vc")).alias("sum_vc"), F.count(F.lit(1)).alias("cnt"))


def q_evict_count_sum(spark, sf):
    return _evicted_sum(ev.evict_count(_with_tumble(spark, sf), ["id", "win_start"], "seq", P.EVICT_KEEP))


def q_evict_delta_sum(spark, sf):
    kept = ev.evict_delta(
        _with_tumble(spark, sf), ["id", "win_start"], "seq", "vc", lambda last, x: F.abs(last - x), P.EVICT_DELTA
    )
    return _evicted_sum(kept)


def q_evict_time_sum(spark, sf):
    return _evicted_sum(ev.evict_time(_with_tumble(spark, sf), ["id", "win_start"], "ts", P.EVICT_TIME))


# ---------------------------------------------------------------- late data (L1-L3)


def _classified(spark, sf, lateness):
    s = sensor_view(spark, sf).select("seq", "id", "ts", "vc")
    s = s.withColumn("arrival", F.col("seq") + (F.col("seq") * P.ARRIVAL_MULT) % P.ARRIVAL_MOD)
    return late.classify(s, "ts", ["arrival", "seq"], P.LATE_SIZE, P.LATE_BOUND, lateness)


def q_late_dropped_sum(spark, sf):
    out = late.on_time_windows(_classified(spark, sf, "0 seconds"), "id", "vc")
    return out.select("id", "win_start", "win_end", _r2("sum_vc").alias("sum_vc"), "cnt")


def q_allowed_lateness_sum(spark, sf):
    out = late.allowed_lateness(_classified(spark, sf, P.LATE_LATENESS), "id", "vc", ["arrival", "seq"])
    return out.select("id", "win_start", "firing", _r2("sum_vc").alias("sum_vc"), "cnt")


def q_late_side_output(spark, sf):
    return late.side_output(_classified(spark, sf, P.LATE_LATENESS)).select("seq", "id", "ts", "vc")


# ---------------------------------------------------------------- sinks' payloads


def _latest_per_key(spark, sf):
    return latest_per_key(_sensor_ms(spark, sf), "id", "seq", ("ts", "vc"))


def q_kv_upsert_latest(spark, sf):
    return _latest_per_key(spark, sf).select(F.col("id").alias("key"), F.col("vc").cast("string").alias("value"))


def q_jdbc_upsert_latest(spark, sf):
    return _latest_per_key(spark, sf)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
