"""The segmented stream machinery equals plain windows; exact quantiles equal numpy."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from streamguard.functions.quantiles import exact_quantiles
from streamguard.operators import stream
from streamguard.sources.packets import packets


def test_packets_do_not_depend_on_segment_size(spark):
    a = {r["packet_id"]: tuple(r) for r in packets(spark, SF_SMALL, target_rows=None).drop("_seg").collect()}
    b = {r["packet_id"]: tuple(r) for r in packets(spark, SF_SMALL, target_rows=4).drop("_seg").collect()}
    assert a == b


def test_prefix_sums_match_window(spark):
    df = spark.range(0, 500).select((F.col("id") % 7).alias("k"), (F.col("id") * 37 % 101).cast("double").alias("v"),
                                    F.lit(1).alias("c"))
    seg = stream.segment_by_key(df, ["k"], "v", target_rows=5)
    got = stream.prefix_sums(seg, ["k"], [F.col("v"), F.col("c")], ["c"])
    w = Window.partitionBy("k").orderBy("v", "c").rowsBetween(Window.unboundedPreceding, -1)
    exp = df.withColumn("e", F.coalesce(F.sum("c").over(w), F.lit(0)))
    g = sorted((r["k"], r["v"], r["c_before"]) for r in got.collect())
    e = sorted((r["k"], r["v"], r["e"]) for r in exp.collect())
    # equal values may be ordered either way; compare multisets of (key, value, count-before) per value group
    assert [x[:2] for x in g] == [x[:2] for x in e]
    assert sorted(x[2] for x in g) == sorted(x[2] for x in e)


def test_position_is_row_number(spark):
    df = spark.range(0, 300).select((F.col("id") % 3).alias("k"), (F.col("id") * 7 % 300).cast("double").alias("t"),
                                    F.col("id"))
    seg = stream.segmented(df, ["k"], "t", 7)
    got = stream.position(seg, ["k"], [F.col("t"), F.col("id")], "pos")
    w = Window.partitionBy("k").orderBy("t", "id")
    exp = df.withColumn("pos", F.row_number().over(w) - 1)
    assert sorted(map(tuple, got.select("id", "pos").collect())) == sorted(map(tuple, exp.select("id", "pos").collect()))


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    vals = rng.normal(size=3000)
    df = spark.createDataFrame([(int(i % 3), float(v)) for i, v in enumerate(vals)], "g int, v double")
    q = {r["g"]: (r["q0"], r["q1"], r["q2"]) for r in exact_quantiles(df, "v", ["g"], [0.25, 0.5, 0.99]).collect()}
    for g in range(3):
        exp = np.quantile(vals[np.arange(3000) % 3 == g], [0.25, 0.5, 0.99])
        assert np.allclose(q[g], exp, rtol=0, atol=1e-12)
    whole = exact_quantiles(df, "v", [], [0.5]).collect()[0]["q0"]
    assert abs(whole - np.median(vals)) < 1e-12


def test_constant_columns_are_exactly_constant(spark):
    """Merged partial variances of a constant column are float noise; prepare must drop it."""
    from streamguard.operators import stats as ST
    df = spark.range(0, 5000, numPartitions=8).select(F.lit(1.0).alias("c"), (F.col("id") % 3).cast("double").alias("x"))
    v = ST.variances(df, ["c", "x"])
    assert v["c"] == 0.0 and v["x"] > 0
    kept, med, mom = ST.prepare(df, ["c", "x"])
    assert kept == ["x"]
    z = ST.standardize(df, ST.moments(df, ["c"]), ["c"])
    assert {r[0] for r in z.select("c").distinct().collect()} == {0.0}


def _sizes(df, keys=("k",)):
    return {tuple(r)[:-1]: r["count"] for r in df.groupBy(*keys, stream.SEG).count().collect()}


def _odd_times(spark):
    """A burst, a heavy tail, two lumps far apart with an outlier, a hot value, a two-packet and a null-time device."""
    rng = np.random.default_rng(3)
    burst = np.concatenate([rng.uniform(0, 1e6, 300), rng.uniform(500, 500.001, 5000)])
    tail = np.exp(rng.normal(0, 6, 4000))
    lumps = np.concatenate([np.arange(2000.0), 2.0 ** 40 + np.arange(2000.0), [2.0 ** 62]])
    hot = np.concatenate([rng.uniform(0, 10, 1500), np.full(3000, 4.0), np.full(700, 10.0)])
    rows = [(k, float(v)) for k, x in (("burst", burst), ("tail", tail), ("lumps", lumps), ("hot", hot)) for v in x]
    rows += [("two", 1.0), ("two", 2.0), ("none", None), ("none", None), (None, 5.0), *[(None, float(i)) for i in range(900)]]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, k string, v double")


def test_segments_hold_equal_numbers_of_rows(spark):
    df = _odd_times(spark)
    seg = stream.segmented(df, ["k"], "v", 100)
    got = seg.collect()
    assert sorted(r["id"] for r in got) == sorted(r["id"] for r in df.collect())
    sizes = _sizes(seg)
    values = {}
    for r in got:
        values.setdefault((r["k"], r[stream.SEG]), set()).add(r["v"])
    assert all(n <= 200 or len(values[s]) == 1 for s, n in sizes.items())
    assert len([s for s in sizes if s[0] == "two"]) == 1 and sizes[("none", stream.NULL_SEG)] == 2
    for k in ("burst", "tail", "lumps", "hot", None):  # _seg grows with the value, and there are no crumbs
        by = sorted((r["v"], r[stream.SEG]) for r in got if r["k"] == k)
        assert [s for _, s in by] == sorted(s for _, s in by)
        assert len({s for _, s in by}) <= 4 * len(by) / 100 + 4


def test_few_segments_when_keys_are_small(spark):
    seg = stream.segmented(_odd_times(spark), ["k"], "v", 10_000)
    assert {s for _, s in _sizes(seg)} == {0, stream.NULL_SEG}


def _lagged(d, w):
    return d.withColumn("p1", F.lag("v", 1).over(w)).withColumn("p5", F.lag("id", 5).over(w)).withColumn(
        "s3", F.sum("id").over(w.rowsBetween(-3, 0)))


def test_windows_over_segments_equal_plain_ones(spark, monkeypatch):
    """Edge rows windowed in blocks of segments with halo rows, segments of one row included."""
    df = _odd_times(spark).filter("k in ('hot', 'tail', 'two')")
    order = [F.col("v").asc_nulls_last(), F.col("id")]
    want = sorted(map(tuple, _lagged(df, Window.partitionBy("k").orderBy(*order)).select("id", "p1", "p5", "s3").collect()))
    for block in (1024, 5):
        monkeypatch.setattr(stream, "EDGE_BLOCK", block)
        seg = stream.segmented(df, ["k"], "v", 20)
        got = stream.windowed(seg, ["k"], order, _lagged, 5)
        assert sorted(map(tuple, got.select("id", "p1", "p5", "s3").collect())) == want
        stream.release()


def test_edge_blocks_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(stream, "EDGE_BLOCK", 8)
    seg = stream.segmented(_odd_times(spark).filter("k = 'tail'"), ["k"], "v", 20)
    w = Window.partitionBy("k", stream.SEG).orderBy("v", "id")
    m = seg.withColumn(stream.LP, F.row_number().over(w)).withColumn(stream.CNT, F.count("*").over(Window.partitionBy("k", stream.SEG)))
    edge = m.filter((F.col(stream.LP) <= 3) | (F.col(stream.LP) > F.col(stream.CNT) - 3))
    blocks = stream._with_halo(m, edge, ["k"], 8, 3).groupBy("_block").count().collect()
    assert len(blocks) > 10 and max(r["count"] for r in blocks) <= 8 * 6 + 3


def test_scan_of_many_devices_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(stream, "SCAN_BLOCK", 20_000)
    df = spark.range(200_000).select((F.col("id") % 2).alias("f"), F.format_string("d%06d", F.col("id")).alias("dev"),
                                     F.lit(0).alias(stream.SEG), (F.col("id") % 3).alias("s"))
    seen = []
    monkeypatch.setattr(stream, "cut_lineage", lambda d, f=stream.cut_lineage: seen.append(f(d)) or seen[-1])
    got = stream.blocked_sums(df, ["f"], ["dev", stream.SEG], "s", "off")
    w = Window.partitionBy("f").orderBy("dev").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("off", F.coalesce(F.sum("s").over(w), F.lit(0)))
    assert got.select("dev", "off").exceptAll(want.select("dev", "off")).count() == 0 and got.count() == 200_000
    assert max(r["count"] for r in seen[0].groupBy("_range").count().collect()) <= 2 * 20_000


def test_features_do_not_depend_on_segments(spark):
    """F1-F23 with segments of a few rows equal those of whole devices."""
    from streamguard.operators import features as FE
    from streamguard.sources import ingest
    out = []
    for rows in (None, 6):
        p = packets(spark, SF_SMALL, target_rows=rows).withColumn("conf_rev", F.lit(1).cast("bigint"))
        full = FE.engineer_full(ingest.typed_packets(p), rows)
        cols = ["packet_id", "inter_arrival", "jitter_rolling_std", "sqNum_delta", "stNum_change", "event_id",
                "msgs_since_last_event", "time_since_last_event"]
        out.append(sorted([tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in full.select(*cols).collect()]))
        stream.release()
    assert out[0] == out[1]


def _joins(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join")


def test_streams_of_one_segment_need_no_edge_rows(spark):
    """Only keys that were cut repair their edges; the features are those of plain windows for both kinds."""
    rows = [(k, i, float(i * 7 % 31)) for k, n in (("a", 40), ("b", 3), ("c", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, i long, x double")
    build = lambda d, w: d.withColumn("prev", F.lag("x", 2).over(w))
    want = {(r.k, r.i): r.prev for r in build(df, Window.partitionBy("k").orderBy("i")).collect()}
    whole = stream.windowed(stream.segmented(df, ["k"], "i"), ["k"], [F.col("i")], build, 2)
    cut = stream.windowed(stream.segmented(df, ["k"], "i", 10), ["k"], [F.col("i")], build, 2)
    assert _joins(whole) == 0 and _joins(cut) > 0
    for got in (whole, cut):
        assert {(r.k, r.i): r.prev for r in got.collect()} == want
    stream.release()


def test_exact_quantiles_count_the_values_once(spark):
    """The rows below a bracket and those per value come from one pass; two for the brackets and the values."""
    df = spark.createDataFrame([(g, float(i % 7)) for g in ("a", "b") for i in range(500)], "g string, x double")
    q = exact_quantiles(df, "x", ["g"], [0.25, 0.5])
    assert q._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 2
    want = np.quantile([float(i % 7) for i in range(500)], [0.25, 0.5]).tolist()
    assert {r.g: [r.q0, r.q1] for r in q.collect()} == {"a": want, "b": want}


def test_carried_values_of_runs_share_one_window(spark):
    df = spark.createDataFrame([("a", i, i % 3 == 0) for i in range(9)], "k string, i int, f boolean")
    out = stream.runs(stream.segmented(df, ["k"], "i"), ["k"], [F.col("i")], F.col("f"), F.col("i"), "r")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert any("AS _cs" in line and "AS _lc" in line for line in plan.split("\n"))
    assert [(r.r_id, r.r_pos, r.r_start) for r in out.orderBy("i").collect()] == [(1 + i // 3, i % 3, i - i % 3) for i in range(9)]
    stream.release()


def test_shared_tables_are_written_in_the_order_of_their_streams(spark, tmp_path):
    from streamguard.plans import context
    events = spark.range(40).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) AS ts", "id % 8 AS user_id",
                                        "IF(id % 3 = 0, 'signup', 'view') AS event_type", "CAST(id AS DOUBLE) AS value", "'{\"k\": 3}' AS props")
    events.write.parquet(f"{tmp_path}/events.parquet")
    full = context.full(spark, str(tmp_path))
    assert full.count() == 40
    assert all("/attack_type=" in f and "/split=" in f and f.index("/attack_type=") < f.index("/split=") for f in full.inputFiles())
