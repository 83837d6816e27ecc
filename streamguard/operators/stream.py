"""Skew-safe ordered windows over device streams.

A device stream is every row of one key (e.g. one ``gocb_ref`` in one file)
in time order.  ``Window.partitionBy(device)`` sends a whole device to one
task, and one device may carry a third of all rows.  Everything here splits a
stream into *segments* by position instead:

* ``segmented`` cuts every key of more than ``target_rows`` rows at quantiles
  of its own order column (splitters from a mergeable sketch of that key), so
  bursts, heavy tails and outliers move the cuts, not the sizes; a value that
  many rows share becomes a segment of its own.  Pieces that are still too
  large are cut again.  Smaller keys are one segment.  ``_seg`` grows with the
  order column within a key, so (key, _seg, order) is the stream order.
* ``windowed`` evaluates look-back window features (lag, rolling frames of at
  most ``lookback`` rows) per (key, _seg).  Keys of one segment are done then.
  In the others, only the first ``lookback`` rows of a segment can see the
  segment edge; they are recomputed on a side table holding the first and last
  ``lookback`` rows of every segment of those keys (the rows they need are
  always in it) and patched back with a join on (key, _seg), which
  keeps the partitioning of the big side.  The side table is windowed in blocks
  of ``EDGE_BLOCK`` neighbouring segments, each with a halo copy of the last
  rows of the block before.
* ``runs`` numbers runs that start at flagged rows (running count, position
  in run, first value of run): within-segment windows plus carries from a
  per-segment table (one row per segment), whose sums over many keys are a
  two-level scan (``blocked_sums``): within blocks, and over the blocks.

The big data is shuffled once, on (key, _seg); side tables scale with the
number of segments, not rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import cut_lineage

SEG = "_seg"
LP = "_lp"
CNT = "_cnt"
# Segment number used for rows whose time is null: they sort after every timed row.
NULL_SEG = 1 << 62
# Rows per segment aimed at (sized for executor memory); a segment holds twice as many at most, but for one value's rows.
DEFAULT_TARGET_ROWS = 2_000_000
# Segments that one round makes of a key, sizes of its sketch (rank error about 0.13 %) and of its grid of quantiles.
FANOUT, SKETCH, GRID = 256, 4000, 1024
# Splitters that may be broadcast (8 bytes each); beyond, they are joined by key.
BROADCAST_SPLITTERS = 1_000_000
# Segments of one key whose edge rows share a task (at least the look-back), and rows of a block of a prefix scan.
EDGE_BLOCK = 1024
SCAN_BLOCK = 500_000

_UNB = Window.unboundedPreceding
_UNF = Window.unboundedFollowing

# Frames read by both the main path and a side table are persisted once, so the
# big data is shuffled and windowed a single time; ``release`` drops them after
# the result is written or checkpointed.
_PERSISTED: list[DataFrame] = []


def shared(df: DataFrame) -> DataFrame:
    """Persist and materialize now, so later plans see the frame's hash partitioning
    (with ``canChangeCachedPlanOutputPartitioning`` off) and add no exchange."""
    df = _kept(df)
    df.count()
    return df


def _kept(df: DataFrame) -> DataFrame:
    from pyspark import StorageLevel
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    _PERSISTED.append(df)
    return df


def release() -> None:
    while _PERSISTED:
        _PERSISTED.pop().unpersist()


def add_segment(df: DataFrame, time_col: str | Column, width: float, name: str = SEG) -> DataFrame:
    """Segments of one fixed width (infinite: a single one)."""
    t = F.col(time_col) if isinstance(time_col, str) else time_col
    if math.isinf(width):
        seg = F.when(t.isNull(), F.lit(NULL_SEG)).otherwise(F.lit(0).cast("bigint"))
    else:
        seg = F.coalesce(F.floor(t / F.lit(width)).cast("bigint"), F.lit(NULL_SEG))
    return df.withColumn(name, seg)


def _splitters(df: DataFrame, keys: Sequence[str], col: str, target_rows: int, limit: int) -> DataFrame | None:
    """(keys, _seg, _q, _own): where to cut each segment of more than ``limit`` rows; None if there is none.

    ``_q`` are quantiles, ascending and distinct: a row lies behind those below
    its value.  ``_own`` are the values of ``_q`` that hold two quantiles or the
    end: they get a segment of their own.
    """
    pk = [*keys, SEG]
    v = F.col(col).cast("double")
    timed = df.filter(v.isNotNull())
    size = timed.groupBy(*pk).agg(F.count(F.lit(1)).alias("_n"), F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    size = size.filter((F.col("_n") > limit) & (F.col("_lo") < F.col("_hi")))
    large_segments = size.count()
    if not large_segments:
        return None
    # each large segment has more than ``limit`` rows of its own, so their table is small against the rows
    size = cut_lineage(size)
    known = F.broadcast(size) if large_segments <= BROADCAST_SPLITTERS else size
    large = _join_null_safe(timed.select(*pk, v.alias("_v")).filter(~F.isnan("_v")), known, pk)
    sketch = large.groupBy(*pk, "_n", "_hi").agg(F.kll_sketch_agg_double("_v", F.lit(SKETCH)).alias("_s"))
    ranks = F.array(*[F.lit(i / GRID) for i in range(1, GRID)])
    grid = sketch.withColumn("_g", F.kll_sketch_get_quantile_double("_s", ranks))
    pieces = F.least(F.greatest(F.ceil(F.col("_n") / target_rows), F.lit(2)), F.lit(FANOUT)).cast("int")
    picked = grid.withColumn("_m", pieces).withColumn(
        "_g", F.transform(F.sequence(F.lit(1), F.col("_m") - 1), lambda i: F.element_at("_g", F.round(i * GRID / F.col("_m")).cast("int"))))
    twice = F.filter("_g", lambda x, i: (x == F.col("_hi")) | ((i > 0) & (x == F.get("_g", i - 1))))
    return cut_lineage(picked.select(*pk, F.array_distinct("_g").alias("_q"), F.array_distinct(twice).alias("_own")))


def _join_null_safe(df: DataFrame, side: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equality join on ``on`` in which null keys meet; the columns of ``side`` besides ``on`` are added."""
    renamed = side.withColumnsRenamed({c: f"_k_{c}" for c in on})
    cond = F.lit(True)
    for c in on:
        cond = cond & df[c].eqNullSafe(renamed[f"_k_{c}"])
    return df.join(renamed, cond, how).drop(*[f"_k_{c}" for c in on])


def _count_below(values: str, x: Column, inclusive: bool) -> Column:
    """How many of the ascending ``values`` lie below ``x`` (or equal it), in log steps."""
    def step(at, width):
        probe = F.get(values, (at + width - 1).cast("int"))
        ahead = (probe <= x) if inclusive else (probe < x)
        return F.when((at + width <= F.size(values)) & ahead, at + width).otherwise(at)
    widths = F.array(*[F.lit(1 << i) for i in range(FANOUT.bit_length(), -1, -1)])
    return F.aggregate(widths, F.lit(0), step)


def segmented(df: DataFrame, keys: Sequence[str], time_col: str,
              target_rows: int | None = DEFAULT_TARGET_ROWS, reuse: bool = False) -> DataFrame:
    """Adds ``_seg`` (replacing any present one): segments of at most about ``target_rows`` rows by position.

    ``reuse=True`` keeps an existing ``_seg`` when the caller knows it was cut on
    the same keys and time order (e.g. packets -> full-mode features), which
    lets the planner reuse the partitioning.  Rows without a value form the
    key's last segment.
    """
    if SEG in df.columns:
        if reuse:
            return df
        df = df.drop(SEG, LP, CNT)
    keys = list(keys)
    x = F.col(time_col).cast("double")
    out = add_segment(df, time_col, math.inf)
    limit = target_rows
    while target_rows:
        cuts = _splitters(out, keys, time_col, target_rows, limit)
        if cuts is None:
            break
        held = cuts.agg(F.sum(F.size("_q") + F.size("_own"))).first()[0]
        side = F.broadcast(cuts) if held <= BROADCAST_SPLITTERS else cuts
        out = _join_null_safe(out, side, [*keys, SEG], "left")
        sub = _count_below("_q", x, False) + _count_below("_own", x, True)
        seg = F.when(F.col(SEG) == NULL_SEG, F.col(SEG)).otherwise(F.col(SEG) * (2 * FANOUT) + F.coalesce(sub, F.lit(0)))
        out = out.withColumn(SEG, seg.cast("bigint")).drop("_q", "_own")
        limit = 2 * target_rows
    return out


def windowed(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
             build: Callable[[DataFrame, WindowSpec], DataFrame], lookback: int) -> DataFrame:
    """Apply ``build(df, w)`` as if ``w`` were ``partitionBy(keys).orderBy(order)``.

    ``build`` may only look back at most ``lookback`` rows (lag / rowsBetween(-k, 0)
    chains whose total reach is <= lookback).  ``df`` must carry ``_seg``.
    Adds ``_lp`` (1-based position in segment) and ``_cnt`` (segment size).
    """
    keys = list(keys)
    pk = keys + [SEG]
    base_cols = [c for c in df.columns if c not in (LP, CNT)]
    w_seg = Window.partitionBy(*pk).orderBy(*order)
    m = (df.select(*base_cols)
         .withColumn(LP, F.row_number().over(w_seg))
         .withColumn(CNT, F.count(F.lit(1)).over(w_seg.rowsBetween(_UNB, _UNF))))
    m = _kept(build(m, w_seg))
    # materializes the frame, like ``shared``: the most segments that one key has
    cut = m.select(*pk).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("_segments")).filter(F.col("_segments") > 1)
    most = cut.agg(F.max("_segments")).first()[0] or 1
    new_cols = [c for c in m.columns if c not in base_cols and c not in (LP, CNT)]
    if most == 1:  # no row sees an edge
        return m.select(*base_cols, LP, CNT, *new_cols)

    # Edge rows: first and last `lookback` rows of every segment of a cut key.  Any
    # row among the first `lookback` of a segment finds its true predecessors here.
    k = F.lit(lookback)
    edge = m.filter((F.col(LP) <= k) | (F.col(LP) > F.col(CNT) - k)).select(*base_cols, LP)
    edge = _join_null_safe(edge, cut, keys).drop("_segments")
    block = max(EDGE_BLOCK, lookback)
    if most <= block:
        edge = build(edge, Window.partitionBy(*keys).orderBy(*order))
    else:
        edge = build(_with_halo(m, edge, keys, block, lookback), Window.partitionBy(*keys, "_block").orderBy(*order))
        edge = edge.filter(~F.col("_copy"))
    fix = (edge.filter(F.col(LP) <= k)
           .groupBy(*pk)
           .agg(F.array_sort(F.collect_list(F.struct(F.col(LP), *[F.col(c) for c in new_cols])))
                .alias("_fix")))
    out = m.join(fix, on=pk, how="left")
    head = F.col(LP) <= k
    patched = [
        F.when(head & F.col("_fix").isNotNull(), F.element_at(F.col("_fix"), F.col(LP)).getField(c)).otherwise(F.col(c)).alias(c)
        for c in new_cols
    ]
    return out.select(*base_cols, LP, CNT, *patched)


def _with_halo(m: DataFrame, edge: DataFrame, keys: Sequence[str], block: int, lookback: int) -> DataFrame:
    """The edge rows with their ``_block`` of segments, the last ``lookback`` rows of a block copied to the next one.

    A block has at least as many rows as segments, so no look-back passes the
    block before.
    """
    pk = [*keys, SEG]
    seg = m.groupBy(*pk).agg(F.count(F.lit(1)).alias("_size"))
    place = Window.partitionBy(*keys).orderBy(SEG)  # a row per segment of a key
    seg = seg.withColumn("_block", F.floor((F.row_number().over(place) - 1) / block))
    rest = Window.partitionBy(*keys, "_block").orderBy(F.col(SEG).desc()).rowsBetween(_UNB, -1)
    seg = seg.withColumn("_later", F.coalesce(F.sum("_size").over(rest), F.lit(0)))
    own = _join_null_safe(edge, seg, pk).withColumn("_copy", F.lit(False))
    after = F.col("_later") + F.col("_size") - F.col(LP)
    halo = own.filter(after < lookback).withColumn("_block", F.col("_block") + 1).withColumn("_copy", F.lit(True))
    return own.unionByName(halo).drop("_size", "_later")


def blocked_sums(df: DataFrame, group: Sequence[str], order: Sequence[str], col: str, out: str,
                 block_rows: int | None = None) -> DataFrame:
    """Sum of ``col`` over the rows before, in ``order`` within ``group``: a scan in two levels.

    Rows are dealt into ranges of (group, order) of about ``block_rows``; a
    window within each range, and one over the ranges' sums, give the total.
    """
    group, order = list(group), list(order)
    parts = max(1, -(-df.count() // (block_rows or SCAN_BLOCK)))
    keys = [F.col(c) for c in group + order]
    if parts == 1:
        w = Window.partitionBy(*group).orderBy(*order).rowsBetween(_UNB, -1)
        return df.withColumn(out, F.coalesce(F.sum(col).over(w), F.lit(0)))
    ranged = cut_lineage(df.repartitionByRange(parts, *keys).withColumn("_range", F.spark_partition_id()))
    sums = ranged.groupBy(*group, "_range").agg(F.sum(col).alias("_sum"))
    over = Window.partitionBy(*group).orderBy("_range").rowsBetween(_UNB, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(over), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*group, "_range").orderBy(*order).rowsBetween(_UNB, -1)
    rows = ranged.withColumn("_in", F.coalesce(F.sum(col).over(inside), F.lit(0)))
    return _join_null_safe(rows, sums, [*group, "_range"]).withColumn(out, F.col("_in") + F.col("_before")).drop("_in", "_before", "_range")


def runs(df: DataFrame, keys: Sequence[str], order: Sequence[Column], flag: Column,
         value: Column, prefix: str, offset_keys: Sequence[str] | None = None,
         offset_order: Sequence[str] | None = None) -> DataFrame:
    """Runs of a stream that start at rows where ``flag`` is 1.

    Adds ``{prefix}_id`` (running count of flags; with ``offset_keys`` the count
    continues across keys inside each offset group, ordered by ``offset_order``),
    ``{prefix}_pos`` (0-based position since the run start; rows before the
    first flag belong to a run that starts at the key's first row) and
    ``{prefix}_start`` (``value`` at the run start).  ``df`` must carry ``_seg``.
    """
    keys = list(keys)
    pk = keys + [SEG]
    w = Window.partitionBy(*pk).orderBy(*order)
    upto = w.rowsBetween(_UNB, Window.currentRow)
    windowed_before = LP in df.columns  # then its frame is kept already, and read by column
    if not windowed_before:
        df = df.withColumn(LP, F.row_number().over(w))
    f = F.coalesce(flag.cast("int"), F.lit(0))
    hit = F.struct(F.col(LP).alias("lp"), value.alias("v"))
    flagged = df.withColumn("_f", f).withColumn("_hit", F.when(F.col("_f") == 1, hit))
    # both over the same window in one pass of the rows
    df = flagged.select("*", F.sum("_f").over(upto).alias("_cs"), F.last("_hit", ignorenulls=True).over(upto).alias("_lc")).drop("_hit")
    flagged = flagged.drop("_hit")
    if not windowed_before:
        flagged = df = shared(df)

    seg = flagged.groupBy(*pk).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("_f").alias("_s"),
        F.max(F.when(F.col("_f") == 1, hit)).alias("_last"),
        F.min(hit).getField("v").alias("_first_v"),
    )
    wd = Window.partitionBy(*keys).orderBy(SEG)
    before = wd.rowsBetween(_UNB, -1)
    seg = (seg.withColumn("_pos0", F.coalesce(F.sum("_n").over(before), F.lit(0)))
           .withColumn("_lastg", F.when(F.col("_last").isNotNull(), F.struct(
               (F.col("_pos0") + F.col("_last.lp") - 1).alias("g"), F.col("_last.v").alias("v"))))
           .withColumn("_carry", F.last("_lastg", ignorenulls=True).over(before))
           .withColumn("_dev_first", F.first("_first_v").over(wd.rowsBetween(_UNB, _UNF))))
    if offset_keys:  # over all keys of a group: a row per key and segment, too many for one window
        seg = blocked_sums(seg, offset_keys, [*(offset_order or []), SEG], "_s", "_off")
    else:
        seg = seg.withColumn("_off", F.coalesce(F.sum("_s").over(before), F.lit(0)))
    seg = seg.select(*pk, "_pos0", "_carry", "_dev_first", "_off")

    out = df.join(seg, on=pk, how="left")
    start_g = (F.when(F.col("_lc").isNotNull(), F.col("_pos0") + F.col("_lc.lp") - 1)
               .when(F.col("_carry").isNotNull(), F.col("_carry.g"))
               .otherwise(F.lit(0)))
    start_v = (F.when(F.col("_lc").isNotNull(), F.col("_lc.v"))
               .when(F.col("_carry").isNotNull(), F.col("_carry.v"))
               .otherwise(F.col("_dev_first")))
    out = (out.withColumn(f"{prefix}_id", (F.col("_off") + F.col("_cs")).cast("bigint"))
           .withColumn(f"{prefix}_pos", (F.col("_pos0") + F.col(LP) - 1 - start_g).cast("bigint"))
           .withColumn(f"{prefix}_start", start_v))
    return out.drop("_f", "_cs", "_lc", "_pos0", "_carry", "_dev_first", "_off")


def position(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "_pos") -> DataFrame:
    """0-based position of each row in its key's stream, without a per-key window."""
    r = runs(df, keys, order, F.lit(0), F.lit(None).cast("int"), "_p")
    return r.withColumnRenamed("_p_pos", name).drop("_p_id", "_p_start")


def segment_by_key(df: DataFrame, keys: Sequence[str], col: str,
                   target_rows: int = DEFAULT_TARGET_ROWS) -> DataFrame:
    """``segmented`` for orders over values (ranks) rather than time."""
    return segmented(df, keys, col, target_rows)


def prefix_sums(df: DataFrame, keys: Sequence[str], order: Sequence[Column], cols: Sequence[str],
                suffix: str = "_before") -> DataFrame:
    """Sum of each column over the rows strictly before, in ``order``, within each key.

    Within-segment window plus a carry from a per-segment totals table.
    ``df`` must carry ``_seg`` (monotone in ``order``).
    """
    keys = list(keys)
    pk = keys + [SEG]
    w = Window.partitionBy(*pk).orderBy(*order).rowsBetween(_UNB, -1)
    out = df.select("*", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"_in_{c}") for c in cols])
    tot = df.groupBy(*pk).agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    wk = Window.partitionBy(*keys).orderBy(SEG).rowsBetween(_UNB, -1)
    tot = tot.select(*pk, *[F.coalesce(F.sum(f"_t_{c}").over(wk), F.lit(0)).alias(f"_c_{c}") for c in cols])
    out = out.join(tot, on=pk, how="left")
    return out.select(*[F.col(c) for c in df.columns],
                      *[(F.col(f"_in_{c}") + F.col(f"_c_{c}")).alias(f"{c}{suffix}") for c in cols])
