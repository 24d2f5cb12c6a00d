"""Ordered per-key prefix scans ("rolling" values) that stay parallel on hot keys.

A plain ``Window.partitionBy(key).orderBy(seq)`` puts every row of a key into one
task; one key holding a third of the data would then serialise a third of the
job. ``running`` instead splits each *hot* key into ranges of its ordering
columns and scans them in parallel:

1. One light job places boundaries: every task samples its rows (the i-th row with
   probability ``min(1, SAMPLE / i)`` and the inverse as its weight, so the row count need
   not be known). The samples are merged like a quantile sketch, in a tree: those of ``FAN``
   tasks are sorted together and thinned to ``POINTS * P`` rows at equal distances of
   weight, then (on large inputs) those of ``FAN`` such groups, at last all. So neither a task
   nor the driver sees more than a fixed number of rows, however many tasks there are
   (``P`` = shuffle partitions), and each thinning moves a boundary by at most 1 / POINTS of a part. The rows
   at the P-1 weighted quantiles of (keys, ordering columns) are the boundaries. Quantiles of rows, not of
   values: an outlier moves no boundary, and rows bunched at one value of the first
   ordering column are split by the others.
2. A key with more than one task's share of the rows (``rows / P``, by the sample's weights) is
   hot and is cut at the boundaries inside it; at most P-1 boundaries, so the table that carries them back is broadcast, bounded by
   construction. All other keys keep bucket 0. A row's bucket depends on the row and the
   fetched boundaries only, so a re-run task gets the same rows. Where a task's share would be more than
   ``ROWS_A_TASK`` rows, the rows are dealt to more parts than P (the boundaries stay), so that tasks sort
   smaller pieces, however large the input is. A scan with no key is one key cut
   into P ranges; with no hot key the scan is a plain partitioned window.
3. Local running aggregate over ``(key, bucket)`` ordered by the ordering columns: the only
   shuffle of the data.
4. The totals of the hot buckets (at most 2P rows) are a grouped aggregate over the same shuffle
   files (the plan reuses the exchange, the source is scanned once and not sorted again); they are
   scanned per key to an offset per bucket, broadcast back and combined with the local value.

Every aggregate used here is a monoid (sum, count, max, min, first, last, xor), so
``combine(offset, local)`` equals the scan over the whole key. Sums of doubles may differ in the
last digits with the number of shuffle partitions, as the order of additions does.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline.session import target_parallelism

KINDS = ("sum", "count", "max", "min", "first", "last", "xor")
# rows of a task that are certainly sampled; later rows are sampled ever more thinly
SAMPLE = 32
SAMPLE_SEED = 17
# tasks (then groups of tasks) whose samples are merged in one place, and the rows they are
# thinned to, per shuffle partition
FAN = 256
POINTS = 8
ROWS_A_TASK = 500_000  # rows that a task should sort
SIZE_MARGIN = 64  # pruned columns, compression
NAN = float("nan")  # one object, so that keys that are NaN meet in a dict


@dataclass(frozen=True)
class Running:
    """One running aggregate: output column ``name`` = ``kind`` of ``value``
    over the key's rows up to this one, or over all of them when ``whole``."""

    name: str
    kind: str
    value: Column | str
    whole: bool = False

    def col(self) -> Column:
        return F.col(self.value) if isinstance(self.value, str) else self.value


def _plain(df: DataFrame, name: str) -> Column:
    """The column in a type that survives the way through the driver unchanged, with the
    same order (timestamps as microseconds, dates as days)."""
    dt, c = df.schema[name].dataType, F.col(name)
    if isinstance(dt, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)")
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dt, T.DateType):
        return F.unix_date(c)
    return c


def _null_safe_on(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[l].eqNullSafe(right[r]) for l, r in pairs])


@dataclass
class Buckets:
    """Rows with their bucket (``_b``) and hot flag (``_hot``), the key columns the
    scan uses (``["_gk"]`` for a global scan) and whether any key is split."""

    df: DataFrame
    keys: list[str]
    any_hot: bool
    dealt: bool = False  # partitioned by (keys, bucket) already
    parts: int | None = None  # parts to deal the rows to, if more than the shuffle partitions


INTERNAL = ("_b", "_hot", "_gk")


def _sort_key(row) -> list:
    """Order of collected rows as Spark sorts them: nulls first, NaN last."""
    return [(0, 0) if v is None else (2, 0) if v != v else (1, v) for v in row]


def _thinned(rows: DataFrame, names: list[str], group: Column, points: int) -> DataFrame:
    """At most ``points`` rows per group at equal distances of weight; each carries the weight
    of the distances that end in it."""
    rows = rows.withColumn("_task", group)
    within = Window.partitionBy("_task")
    up_to = within.orderBy(*names).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_sum", F.sum("_w").over(up_to)).withColumn("_all", F.sum("_w").over(within))
    step = F.greatest(F.col("_all") / F.lit(float(points)), F.lit(1.0))
    # the first distance ends half a step in, so that what is rounded off cancels out
    crossed = F.floor(F.col("_sum") / step + 0.5) - F.floor((F.col("_sum") - F.col("_w")) / step + 0.5)
    return rows.where(crossed > 0).select("_task", *names, (crossed * step).alias("_w"))


def _sample(work: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Step 1: weighted rows (``_k*``, ``_o*``, ``_w``), at most POINTS * P of them."""
    names = [f"_k{i}" for i in range(len(keys))] + [f"_o{i}" for i in range(len(order))]
    rows = work.select(*[_plain(work, c).alias(n) for c, n in zip([*keys, *order], names)])
    place = F.monotonically_increasing_id()
    position = place.bitwiseAND(F.lit((1 << 33) - 1))  # within the task
    rows = rows.withColumn("_task", F.shiftright(place, 33))
    rows = rows.withColumn("_w", F.greatest(F.lit(1.0), (position + 1) / F.lit(float(SAMPLE))))
    rows = rows.where(F.rand(SAMPLE_SEED) * F.col("_w") < 1)
    points = POINTS * target_parallelism(work.sparkSession)
    for _ in range(_groupings(work)):
        rows = _thinned(rows, names, F.floor(F.col("_task") / FAN), points)
    return _thinned(rows, names, F.col("_task") * 0, points).select(*names, "_w")


def _groupings(work: DataFrame) -> int:
    """How often tasks are merged FAN to one before all meet: by the optimizer's size of the
    input, taken generously (a frame of unknown size counts as very large). It decides how much
    meets in the last merge, never the result."""
    session = work.sparkSession._jsparkSession.sessionState()
    size = int(work._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    tasks = SIZE_MARGIN * size // max(1, session.conf().filesMaxPartitionBytes())
    return 0 if tasks <= FAN else 1 if tasks <= FAN * FAN else 2


def _boundaries(work: DataFrame, keys: list[str], order: list[str], hot_rows: float | None) -> tuple[list, T.StructType, int | None]:
    """At most P-1 sampled rows (keys, ordering columns) that cut the sorted data into
    parts of about equal row counts (``hot_rows`` rows each, if given), inside keys that are larger;
    and the number of parts to deal the rows to, if more than P."""
    sample = _sample(work, keys, order)
    schema = T.StructType(sample.schema.fields[:-1])
    rows = sorted(((tuple(r)[:-1], r[-1]) for r in sample.collect()), key=lambda x: _sort_key(x[0]))
    total = sum(w for _, w in rows)
    p = target_parallelism(work.sparkSession)
    parts = max(p, math.ceil(total / ROWS_A_TASK))
    step = max(total / p, 1.0) if hot_rows is None else float(hot_rows)
    of_key: dict[tuple, float] = {}
    group = [tuple(NAN if v is not None and v != v else v for v in r[: len(keys)]) for r, _ in rows]
    for key, (_, w) in zip(group, rows):
        of_key[key] = of_key.get(key, 0.0) + w
    cuts, upto = [], 0.0
    for key, (row, w) in zip(group, rows):
        crossed = (upto + w) // step > upto // step
        upto += w
        if crossed and upto < total and of_key[key] > step:
            cuts.append(row)
    return cuts, schema, parts if parts > p else None


def _with_bucket(df: DataFrame, row: Column, most: int) -> DataFrame:
    """``df`` with ``_b``, the number of boundaries in ``_bounds`` (ordered, at most ``most`` of them) that are
    below ``row``: a binary search with a projection for each step, so that it is compiled."""
    out = df.withColumn("_row", row).withColumn("_b", F.lit(0).cast("long"))
    for power in reversed(range(most.bit_length())):
        at = (F.col("_b") + ((1 << power) - 1)).cast("int")
        below = F.get(F.col("_bounds"), at) < F.col("_row")  # null beyond the end, and where there are no bounds
        out = out.withColumn("_b", F.col("_b") + F.when(below, 1 << power).otherwise(0))
    return out.drop("_row")


def assign_buckets(df: DataFrame, keys: list[str], order: list[str], hot_rows: float | None = None) -> Buckets:
    """Steps 1-2: the bucket of each row (0 unless its key is hot)."""
    spark = df.sparkSession
    work = df
    if not keys:
        # one key, but not a literal: the optimizer would make the join below a nested loop
        work = work.withColumn("_gk", F.pmod(F.hash(order[0]), F.lit(1)))
        keys = ["_gk"]
    cuts, schema, parts = _boundaries(work, keys, order, hot_rows)
    per_key: dict[tuple, list[tuple]] = {}
    for row in cuts:  # in order of (keys, ordering columns)
        key = tuple(NAN if v is not None and v != v else v for v in row[: len(keys)])
        per_key.setdefault(key, []).append(row[len(keys) :])
    if not per_key:
        staged = work.withColumn("_b", F.lit(0).cast("long")).withColumn("_hot", F.lit(False))
        return Buckets(staged, keys, False, parts=parts)
    fields = schema.fields
    bounds = T.ArrayType(T.StructType(fields[len(keys) :]))
    hot_names = [f"_hk{i}" for i in range(len(keys))]
    hot_schema = T.StructType(
        [T.StructField(h, f.dataType) for h, f in zip(hot_names, fields)] + [T.StructField("_bounds", bounds)]
    )
    hot = F.broadcast(spark.createDataFrame([(*k, b) for k, b in per_key.items()], hot_schema))
    on = reduce(lambda a, b: a & b, [_plain(work, k).eqNullSafe(F.col(h)) for k, h in zip(keys, hot_names)])
    joined = work.join(hot, on, "left")
    row = F.struct(*[_plain(work, o).alias(f.name) for o, f in zip(order, fields[len(keys) :])])
    staged = _with_bucket(joined, row, max(map(len, per_key.values()))).withColumn("_hot", F.col("_bounds").isNotNull())
    return Buckets(staged.drop(*hot_names, "_bounds"), keys, True, parts=parts)


def _local(a: Running) -> Column:
    v = a.col()
    if a.kind == "first":
        return F.first(v, ignorenulls=False)
    if a.kind == "last":
        return F.last(v, ignorenulls=False)
    return {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min, "xor": F.bit_xor}[a.kind](v)


def running(
    df: DataFrame | None,
    keys: list[str],
    order: list[str],
    aggs: list[Running],
    inclusive: bool = True,
    hot_rows: float | None = None,
    keep_buckets: bool = False,
    buckets: Buckets | None = None,
) -> DataFrame:
    """Add one column per ``Running`` spec, computed over the rows of the same
    ``keys`` that come before this row in ``order`` (and the row itself when
    ``inclusive``). ``order`` must be unique within a key for a deterministic
    result. ``keys=[]`` scans the whole frame in order, still in parallel.

    ``hot_rows`` overrides the hot-key threshold (tests use it to force splits).
    ``keep_buckets`` keeps the ``_b``/``_hot`` columns; a second scan over that
    output, given as ``buckets=Buckets(output, keys, any_hot, dealt=True)``, then needs no
    new shuffle (its window partitioning is the first one's).
    """
    for a in aggs:
        if a.kind not in KINDS:
            raise ValueError(f"unknown running kind {a.kind!r}")
    if buckets is None:
        if df.isStreaming:
            raise ValueError(
                "running() is the batch form; on a stream use the keyed operators (they switch to "
                "transformWithState) or a processor from eddyline.streaming.stateful"
            )
        buckets = assign_buckets(df, keys, order, hot_rows)
    staged, keys = buckets.df, buckets.keys
    cols = [c for c in staged.columns if c not in INTERNAL]

    # 3. local scan within (key, bucket)
    if not buckets.dealt:
        if buckets.parts:
            staged = staged.repartition(buckets.parts, *keys, "_b")
        elif buckets.any_hot:
            staged = staged.repartition(*keys, "_b")
    by_bucket = Window.partitionBy(*keys, "_b").orderBy(*order)
    up_to = by_bucket.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = up_to if inclusive else by_bucket.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = by_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    local = staged
    if any(a.kind == "last" and not a.whole for a in aggs):  # whether the bucket has rows up to here
        local = local.withColumn("_lcnt", F.count(F.lit(1)).over(seen))
    for a in aggs:
        local = local.withColumn(f"_l_{a.name}", _local(a).over(all_rows if a.whole else seen))

    names = {a.name for a in aggs}
    extra = [F.col("_b"), F.col("_hot")] if keep_buckets else []
    if not buckets.any_hot:
        # every key is in one bucket: the local scan is the whole answer
        return local.select(*[F.col(c) for c in cols if c not in names], *[F.col(f"_l_{a.name}").alias(a.name) for a in aggs], *extra)

    # 4. totals of the buckets, a grouped aggregate over the same shuffle files -> offsets of the hot ones (<= 2P rows)
    place = F.struct(*order)
    totals = []
    for a in aggs:
        if a.kind in ("first", "last"):  # with the place, so that a key's first or last can be told
            one = F.min_by if a.kind == "first" else F.max_by
            t = F.struct(F.col("_b").alias("at"), one(F.struct(a.col().alias("v")), place)["v"].alias("v"))
        else:
            t = _local(a)
        totals.append(t.alias(f"_t_{a.name}"))
    # Every column of the rows is asked for (the comparison always holds), or else this branch
    # would be pruned to a shuffle of its own and the source be read twice.
    hashable = [f.name for f in staged.schema.fields if "map<" not in f.dataType.simpleString()]
    totals = staged.groupBy(*keys, "_b").agg(*totals, F.max("_hot").alias("_split"), F.max(F.xxhash64(*hashable)).alias("_rows"))
    totals = totals.filter(F.col("_split") & (F.col("_rows") <= F.lit((1 << 63) - 1))).drop("_split", "_rows")
    w_prev = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    w_key = Window.partitionBy(*keys)
    off_exprs = [F.count(F.lit(1)).over(w_prev).alias("_nprev")]
    for a in aggs:
        t = F.col(f"_t_{a.name}")
        fold = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min, "first": F.min, "last": F.max, "xor": F.bit_xor}[a.kind](t)
        off_exprs.append(fold.over(w_key if a.whole else w_prev).alias(f"_p_{a.name}"))
    off_names = [f"_ok{i}" for i in range(len(keys))]
    offsets = totals.select(*[F.col(k).alias(o) for k, o in zip(keys, off_names)], F.col("_b").alias("_ob"), *off_exprs)
    if not any(a.whole for a in aggs):
        offsets = offsets.filter(F.col("_nprev") > 0)
    offsets = F.broadcast(offsets)
    on = _null_safe_on(local, offsets, list(zip(keys, off_names))) & (local["_b"] == offsets["_ob"]) & local["_hot"]
    out = local.join(offsets, on, "left")

    results = []
    for a in aggs:
        lv, pv = F.col(f"_l_{a.name}"), F.col(f"_p_{a.name}")
        has_prev = F.coalesce(F.col("_nprev"), F.lit(0)) > 0
        if a.whole:  # the key's total where the key is split, else the bucket is the key
            split = pv.getField("v") if a.kind in ("first", "last") else pv
            r = F.when(F.col("_nprev").isNull(), lv).otherwise(split)
        elif a.kind in ("sum", "count", "xor"):
            both = pv.bitwiseXOR(lv) if a.kind == "xor" else pv + lv
            r = F.when(~has_prev, lv).when(lv.isNull(), pv).when(pv.isNull(), lv).otherwise(both)
        elif a.kind == "max":
            r = F.greatest(pv, lv)
        elif a.kind == "min":
            r = F.least(pv, lv)
        elif a.kind == "first":
            r = F.when(has_prev, pv.getField("v")).otherwise(lv)
        else:
            r = F.when(F.col("_lcnt") > 0, lv).otherwise(pv.getField("v"))
        results.append(r.alias(a.name))
    extra = [out["_b"], out["_hot"]] if keep_buckets else []
    return out.select(*[out[c] for c in cols if c not in names], *results, *extra)


def row_number(df: DataFrame, keys: list[str], order: list[str], name: str = "rn", hot_rows: float | None = None) -> DataFrame:
    """1-based position of each row within its key, in ``order`` (hot keys split)."""
    return running(df, keys, order, [Running(name, "count", F.lit(1))], hot_rows=hot_rows)
