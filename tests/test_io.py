"""Capture CSV round trip (S1, S3, S7) and schema helpers."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from streamguard import schema
from streamguard.sources import ingest
from streamguard.sources.packets import packets
from streamguard.sources.sinks import write_table


def test_capture_csv_round_trip(spark):
    p = packets(spark, SF_SMALL).drop("_seg")
    back = {v: k for k, v in schema.CAPTURE_COLUMNS.items()}
    raw = p.select(*[F.col(c).cast("string").alias(back[c]) for c in p.columns if c in back])
    root = tempfile.mkdtemp(prefix="sg-io-", dir="/tmp")
    files = {}
    for (a, s) in [("replay", "train"), ("masquerade", "test")]:
        path = os.path.join(root, f"{a}_{s}")
        write_table(raw.filter((F.col("gocbRef").isNotNull())), path, fmt="csv")
        files[(a, s)] = path
    loaded = ingest.typed_packets(ingest.load_captures(spark, files))
    typed = ingest.typed_packets(p)
    assert loaded.count() == 2 * typed.count()
    a = typed.select("packet_id", "st_num", "sq_num", "ttl_ms", "boolean_1", "bitstring_bitcount", "base_time")
    b = loaded.filter(F.col("attack_type") == "replay").select(*a.columns)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_ids_are_unique_over_files(spark):
    root = tempfile.mkdtemp(prefix="sg-io-", dir="/tmp")
    back = {v: k for k, v in schema.CAPTURE_COLUMNS.items()}
    files = {}
    for a in ("replay", "masquerade"):
        path = os.path.join(root, a)
        rows = spark.createDataFrame([("1", "x"), ("2", "y"), (None, "z")], "packet_id string, gocb_ref string")
        write_table(rows.coalesce(1).select(F.col("packet_id").alias(back["packet_id"]), F.col("gocb_ref").alias(back.get("gocb_ref", "gocbRef"))), path, fmt="csv")
        files[(a, "train")] = path
    got = ingest.conform(ingest.load_captures(spark, files)).select("attack_type", "packet_id").collect()
    assert len({r.packet_id for r in got}) == 6 and all(r.packet_id is not None for r in got)
    assert sorted(r.packet_id for r in got if r.attack_type == "replay")[:2] == [1, 2]


def _capture(lines):
    path = tempfile.mkdtemp(prefix="sg-io-", dir="/tmp") + "/a.csv"
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


HEADER = '"No.","gocbRef","Length","stNum","Length","Info","Info"'


def test_repeated_header_names_keep_their_places(spark):
    path = _capture([HEADER, '1,a,150,7,151,x,y', '2,"b, c",160,8,,"say ""hi""",z'])
    assert ingest.positional_header(spark, path) == ["No.", "gocbRef", "Length", "stNum", "Length.1", "Info", "Info.1"]
    got = ingest.typed_packets(ingest.load_captures(spark, {("replay", "train"): path}))
    rows = [(r.packet_id, r.gocb_ref, r.length, r.st_num, r.data_length) for r in got.orderBy("packet_id").collect()]
    assert rows == [(1, "a", 150, 7, 151), (2, "b, c", 160, 8, None)]


def test_broken_lines_are_kept_and_counted(spark):
    path = _capture([HEADER, '1,a,150,7,151,x,y', '2,b,160', '3,c,170,9,171,x,y,z,w', ',d,180,10,181,x,y', 'four,e,1,2,3,x,y'])
    loaded = ingest.load_captures(spark, {("replay", "train"): path, ("replay", "test"): _capture([HEADER])})
    assert [tuple(r) for r in ingest.broken_lines(loaded).collect()] == [("replay", "train", 5, 2, 2)]
    rows = {r.gocb_ref: (r.packet_id, r.length, r[ingest.BROKEN]) for r in ingest.conform(loaded).collect()}
    assert rows["a"] == (1, 150, None) and rows["b"] == (2, 160, "2,b,160") and rows["c"][1] == 170 and rows["c"][2]
    assert sorted(x[0] for x in rows.values()) == [1, 2, 3, 4, 5]


def test_ids_of_many_captures_are_close(spark):
    files = {("replay", "train"): _capture([HEADER, *[f"{i},a,1,1,1,x,y" for i in (3, 1, 2)]]),
             ("replay", "test"): _capture([HEADER, "9,b,1,1,1,x,y", ",b,1,1,1,x,y"]),
             ("injection", "train"): _capture([HEADER, "0,c,1,1,1,x,y", ",c,1,1,1,x,y"])}
    got = ingest.load_captures(spark, files).select("packet_id", ingest.FILE_RANK, ingest.FILE_NO).collect()
    assert sorted(tuple(r) for r in got if r[2] is not None) == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (13, 1, 9), (14, 2, 0)]
    assert sorted(tuple(r)[:2] for r in got if r[2] is None) == [(15, 1), (16, 2)]


def test_used_fields_and_mode_lists(spark):
    t = ingest.typed_packets(packets(spark, SF_SMALL))
    fields = ingest.used_fields([ingest.project_mode(t, "core"), ingest.project_mode(t, "full", advanced=True)])
    assert fields == sorted(fields) and "source" in fields and "frame_len" in fields
    assert schema.mode_features("core") == schema.CORE_NUMERIC
    assert "attack" not in schema.mode_features("full")
