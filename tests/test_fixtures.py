"""Micro-fixtures for the semantics that are easy to get wrong."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import typed_rows
from streamguard.functions import parsing as P
from streamguard.operators import features as FE
from streamguard.operators import stats as ST
from streamguard.sources import ingest

COLS = "packet_id long, attack_type string, split string, gocb_ref string, time_s double, t string, " \
       "st_num long, sq_num long, ttl_ms long, length long, boolean_raw string, bit_string string, attack int"


def row(pid, dev, ts, st, sq, boolean="True", bit="80", t="2024-01-01 00:00:00", ttl=2000, attack=0):
    return (pid, "replay", "train", dev, float(ts), t, st, sq, ttl, 150, boolean, bit, attack)


def feats(spark, rows, target=None):
    return FE.engineer_full(typed_rows(spark, rows, COLS), target_rows=target)


def by_id(df, *cols):
    return {r["packet_id"]: tuple(r[c] for c in cols) for r in df.select("packet_id", *cols).collect()}


def test_n1_event_id_runs_over_the_file(spark):
    rows = [row(1, "a", 1, 1, 0), row(2, "a", 2, 2, 0), row(3, "b", 1, 5, 0), row(4, "b", 2, 6, 0)]
    got = by_id(feats(spark, rows), "event_id")
    assert [got[i][0] for i in (1, 2, 3, 4)] == [0, 1, 1, 2]


def test_n2_first_row(spark):
    got = feats(spark, [row(1, "a", 1, 1, 0)]).collect()[0]
    assert got["sq_inc_violation_when_no_event"] == 1.0
    for c in ("sqNum_jump", "st_change", "ttl_violation", "heartbeat_within_tol"):
        assert got[c] == 0.0, c
    assert got["inter_arrival"] is None


def test_n3_null_flags_count_as_change(spark):
    rows = [row(1, "a", 1, 1, 0, bit=None), row(2, "a", 2, 1, 1, bit=None)]
    got = by_id(feats(spark, rows), "status_bit_change")
    assert got[1][0] is None and got[2][0] == 1.0


def test_n4_eda_first_row_counts(spark):
    rows = [row(1, "a", 1, 1, 0), row(2, "a", 2, 1, 1), row(3, "a", 3, 2, 0)]
    t = typed_rows(spark, rows, COLS)
    eda = ST.rule_violations(t).collect()[0]
    assert eda["st_changes"] == 2
    f = feats(spark, rows).agg(F.sum("st_change")).collect()[0][0]
    assert f == 1.0


def test_n5_popcount(spark):
    df = spark.createDataFrame([("80",), ("0xF",), ("80.0",), (None,)], "b string")
    got = [r[0] for r in df.select(P.popcount_hex("b")).collect()]
    assert got == [1.0, 4.0, None, None]


def test_n6_bad_time_is_null(spark):
    df = spark.createDataFrame([("x",), ("2024-01-01 00:00:01",)], "t string")
    got = [r[0] for r in df.select(P.epoch_seconds("t")).collect()]
    assert got[0] is None and got[1] == 1704067201.0


def test_boolean_parsing(spark):
    vals = ["True", "no, ON", "1,0,yes,1", "", "maybe"]
    df = spark.createDataFrame([(v,) for v in vals], "b string")
    got = [tuple(r) for r in df.select(*P.boolean_flags("b")).collect()]
    assert got == [(1.0, None, None), (0.0, 1.0, None), (1.0, 0.0, 1.0), (None, None, None), (None, None, None)]


def test_jitter_needs_three_gaps(spark):
    rows = [row(1, "a", 0, 1, 0), row(2, "a", 1, 1, 1), row(3, "a", 3, 1, 2), row(4, "a", 7, 1, 3)]
    got = by_id(feats(spark, rows), "jitter_rolling_std")
    assert got[1][0] is None and got[2][0] is None and got[3][0] is None
    assert math.isclose(got[4][0], 1.5275252, rel_tol=1e-6)


@pytest.mark.parametrize("target", [None, 1, 2, 3])
def test_segment_edges_are_exact(spark, target):
    """Tiny segments force every edge case of the segment patching; results must not change."""
    rows = [row(i, "a" if i % 3 else "b", i * 1.5 + (i % 2), 1 + i // 4, i % 5, boolean="True,no" if i % 4 else "x",
                bit=None if i % 7 == 0 else "40") for i in range(1, 40)]
    cols = ["inter_arrival", "jitter_rolling_std", "status_bit_change", "event_id", "msgs_since_last_event",
            "time_since_last_event", "t_change", "sq_inc_violation_when_no_event"]
    base = by_id(feats(spark, rows, None), *cols)
    got = by_id(feats(spark, rows, target), *cols)
    assert got == base


def test_hex_of_any_width(spark):
    from pyspark.sql import functions as F
    from streamguard.functions import parsing as P
    rows = [("0000000000000080",), ("ffffffffffffffff",), ("0x0",), ("1" + "0" * 20,), ("xyz",), (None,), ("0" * 40 + "1f",), ("f" * 31,)]
    got = [r[0] for r in spark.createDataFrame(rows, "h string").select(P.hex_int(F.col("h"))).collect()]
    assert [None if x is None else int(x) for x in got] == [128, 2 ** 64 - 1, 0, 16 ** 20, None, None, 31, 16 ** 31 - 1]


def test_quantiles_rank_values_not_rows(spark):
    import numpy as np
    from pyspark.sql import functions as F
    from streamguard.functions.quantiles import exact_quantiles
    df = spark.range(300_000).select((F.col("id") % 7 == 0).cast("double").alias("flag"), F.exp(F.col("id") / 20_000.0).alias("tail"))
    probs = [0.01, 0.5, 0.857, 0.99]
    for c in ("flag", "tail"):
        x = np.array([r[0] for r in df.select(c).collect()])
        got = exact_quantiles(df, c, [], probs, accuracy=2_000).first()
        assert np.allclose(list(got), np.quantile(x, probs), rtol=1e-12)


def test_knn_returns_every_test_point(spark):
    from streamguard.operators.neighbors import knn_assign
    import random
    rng = random.Random(3)
    train = spark.createDataFrame([(i, [rng.random(), rng.random() * 1e-6], i % 3) for i in range(60)], "packet_id long, v array<double>, y int")
    test = spark.createDataFrame([(1000 + i, [rng.random() * 1e6, rng.random()]) for i in range(9)], "packet_id long, v array<double>")
    got = knn_assign(train, test, "packet_id", "v", "y").collect()
    assert sorted(r.packet_id for r in got) == list(range(1000, 1009)) and all(r.pred is not None for r in got)


def test_typing_reads_each_text_once(spark):
    hexes = ["0", "000", "0x1F", "Ff ", "123456789abcdef", "0" * 20 + "fedcba9876543210f", "f" * 31, "f" * 32, "", "xyz", "12.5", None]
    rows = [(i, "IED1", float(i), "true, OFF ,maybe,1" if i % 2 else None, h) for i, h in enumerate(hexes)]
    out = ingest.typed_packets(spark.createDataFrame(rows, "packet_id long, gocb_ref string, time_s double, boolean_raw string, bit_string string"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 1
    text = [None if h is None else h.strip().lower().replace("0x", "") for h in hexes]
    value = [int(t, 16) if t and all(c in "0123456789abcdef" for c in t) else None for t in text]
    got = out.orderBy("packet_id").collect()
    assert [None if r.bitstring_int is None else int(r.bitstring_int) for r in got] == [None if v is None or v >= 16 ** 31 else v for v in value]
    assert [r.bitstring_bitcount for r in got] == [None if v is None else v.bit_count() for v in value]
    assert [(r.boolean_1, r.boolean_2, r.boolean_3) for r in got] == [(1.0, 0.0, None) if i % 2 else (None,) * 3 for i in range(len(hexes))]
