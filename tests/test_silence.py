"""Silent devices by event-time timers, against a plain union of intervals."""

import numpy as np
import pytest

from streamguard.streaming import silence as SI

SCHEMA = "attack_type string, split string, gocb_ref string, base_time double, ttl_ms double"


def _plain(rows, watermark):
    """Periods that end before ``watermark`` (ms), one message after another."""
    out = []
    for dev in sorted({r[2] for r in rows}):
        period = None
        for t, ttl in sorted((r[3], r[4]) for r in rows if r[2] == dev and r[3] is not None and r[4] is not None):
            if period and t <= period[2]:
                period = (dev, period[1], max(period[2], t + ttl / 1000.0), period[3] + 1)
            else:
                out.append(period)
                period = (dev, t, t + ttl / 1000.0, 1)
        out.append(period)
    return sorted(p for p in out if p and np.ceil(p[2] * 1000) < watermark)


def _run(spark, path, watermark, files=None):
    stream = spark.readStream.schema(SCHEMA)
    if files:
        stream = stream.option("maxFilesPerTrigger", files)
    out = SI.run_once(spark, stream.parquet(str(path)), watermark)
    return sorted((r.gocb_ref, r.alive_from, r.silent_from, r.n_messages) for r in out.collect())


def _messages(n=600, seed=1):
    rng = np.random.default_rng(seed)
    t = np.sort(rng.choice(np.arange(0, 40_000), n)) / 10.0
    # one device sends most of the messages
    dev = np.where(rng.random(n) < 0.7, "hot", rng.choice(["b", "c", "d"], n))
    return [("replay", "train", str(d), float(x), float(rng.choice([500, 2_000, 9_000]))) for d, x in zip(dev, t)]


@pytest.mark.parametrize("batches", [1, 4])
def test_periods_do_not_depend_on_order_or_batches(spark, tmp_path, batches):
    rows = _messages() + [("replay", "train", "b", None, 500.0), ("replay", "train", "b", 3.0, None)]
    size = -(-len(rows) // batches)
    for k in range(batches):
        part = rows[k * size:(k + 1) * size]
        np.random.default_rng(k).shuffle(part)
        spark.createDataFrame([tuple(r) for r in part], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path))
    got = _run(spark, tmp_path, "60 seconds", 1 if batches > 1 else None)
    last = max(r[3] for r in rows if r[3] is not None)
    assert got == _plain(rows, int(last * 1000) - 60_000)


def test_a_silent_device_is_reported_once_and_late_messages_are_dropped(spark, tmp_path):
    def put(*rows):
        spark.createDataFrame([("replay", "train", d, t, 1000.0) for d, t in rows], SCHEMA).coalesce(1).write.mode(
            "append").parquet(str(tmp_path))
    put(("a", 0.0), ("a", 0.5), ("b", 0.0), ("b", 100.0))   # watermark 90: a is over at 1.5, b's first at 1.0
    put(("c", 200.0))                                      # watermark 190
    put(("a", 1.2), ("c", 201.0))                          # a's message lies before the watermark
    assert _run(spark, tmp_path, "10 seconds", 1) == [("a", 0.0, 1.5, 2), ("b", 0.0, 1.0, 1), ("b", 100.0, 101.0, 1)]


def test_a_period_that_ends_at_the_watermark_stays_open(spark, tmp_path):
    rows = [("replay", "train", "a", 0.0, 5000.0), ("replay", "train", "a", 15.0, 1.0)]
    spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").parquet(str(tmp_path / "x"))
    assert _run(spark, tmp_path / "x", "10 seconds") == []
    rows[1] = ("replay", "train", "a", 15.002, 1.0)
    spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").parquet(str(tmp_path / "y"))
    assert _run(spark, tmp_path / "y", "10 seconds") == [("a", 0.0, 5.0, 1)]


def test_no_messages(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "none"))
    assert _run(spark, tmp_path / "none", "10 seconds") == []


def test_union_of_intervals():
    got = SI.merged(np.array([5.0, 0.0, 1.0, 6.0, 3.0]), np.array([6.0, 2.0, 1.5, 6.5, 3.0]), np.ones(5, dtype=np.int64))
    assert [list(x) for x in got] == [[0.0, 3.0, 5.0], [2.0, 3.0, 6.5], [2, 1, 2]]
