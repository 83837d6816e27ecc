"""Capture ingest: read, tag, project and type message tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema
from ..functions import parsing as P
from ..operators import stream
from ..session import cut_lineage


#: Holds a line that does not have the header's number of fields, as it stands in the file.
BROKEN = "_broken"
#: A row's file, in the order of the files' paths, and its number in it.
FILE_RANK, FILE_NO = "_file", "_no"


def positional_header(spark: SparkSession, path: str) -> list[str]:
    """The header's fields by position; a repeated name gets ``.1``, ``.2`` ... from its second place on.

    Read as data, so that Spark does not rename repeated or empty names.
    """
    row = spark.read.option("header", False).option("inferSchema", False).csv(path).first()
    seen: dict[str, int] = {}
    names = []
    for i, name in enumerate(row or []):
        name = (name or f"_c{i}").strip().lstrip("\ufeff")
        names.append(name if name not in seen else f"{name}.{seen[name]}")
        seen[name] = seen.get(name, 0) + 1
    return names


def read_capture(spark: SparkSession, path: str, attack_type: str, split: str) -> DataFrame:
    """One capture (a CSV file or a folder of its parts); every field read as text by its position.

    A line with too few or too many fields stays as a row with ``_broken`` set
    to the line; fields it has keep their places.  All files of a folder share
    the header of the first.  An empty file gives no rows and no columns.
    """
    header = positional_header(spark, path)
    fields = T.StructType([*[T.StructField(h, T.StringType()) for h in header], T.StructField(BROKEN, T.StringType())])
    # the header is skipped, not matched: names are by position; all fields are parsed, or short lines would pass unseen
    df = (spark.read.schema(fields).option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", BROKEN).option("columnPruning", False).csv(path))
    keep = [F.col(f"`{h}`").alias(schema.CAPTURE_COLUMNS[h]) for h in header if h in schema.CAPTURE_COLUMNS]
    return df.select(*keep, F.lit(attack_type).alias("attack_type"), F.lit(split).alias("split"), F.col(BROKEN),
                     F.col("_metadata.file_path").alias("_path"))


def load_captures(spark: SparkSession, files: Mapping[tuple[str, str], str]) -> DataFrame:
    """S3 reader part: union of every (attack_type, split) -> path capture.

    ``_file`` is the capture's place in ``files`` and ``_no`` the message number
    in it, the order of the rows.  ``packet_id`` is unique over all captures
    and close: each capture's numbers follow the largest of the one before.
    Rows without a number (broken lines among them) get ids behind all others,
    in the order of their files.
    """
    parts = []
    for i, ((a, s), path) in enumerate(files.items()):
        part = read_capture(spark, path, a, s)
        no = F.col("packet_id").try_cast("long") if "packet_id" in part.columns else F.lit(None).cast("long")
        parts.append(part.withColumn(FILE_RANK, F.lit(i)).withColumn(FILE_NO, no))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    top = {r[FILE_RANK]: (r["m"], r["n"]) for r in out.groupBy(FILE_RANK).agg(  # a row per capture
        F.max(FILE_NO).alias("m"), F.count(F.when(F.col(FILE_NO).isNull(), 1)).alias("n")).collect()}
    offset, offsets = 0, []
    for i in range(len(parts)):
        offsets += [F.lit(i), F.lit(offset)]
        offset += (top[i][0] or 0) + 1 if i in top else 0
    numbered = F.col(FILE_NO) + F.create_map(*offsets)[F.col(FILE_RANK)]
    if any(n for _, n in top.values()):
        out = _number_the_rest(out, numbered, offset)
    else:
        out = out.withColumn("packet_id", numbered)
    return out.drop("_path")


def _number_the_rest(df: DataFrame, numbered, start: int) -> DataFrame:
    """``packet_id``: ``numbered`` where it is set, else ids from ``start`` on, by file and place.

    Rows are counted by reading task: a task's place in the table of counts
    gives its first id, and the rows follow in the order they are read.
    """
    place = F.monotonically_increasing_id()  # the reading task in the high bits, the row in it in the low ones
    rows = cut_lineage(df.withColumn("_set", numbered).withColumn("_place", place))
    free = rows.filter(F.col("_set").isNull()).withColumn("_task", F.shiftright("_place", 33))
    counts = free.groupBy(FILE_RANK, "_task").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(FILE_RANK, "_task").rowsBetween(Window.unboundedPreceding, -1)  # a row per reading task
    counts = counts.withColumn("_from", F.coalesce(F.sum("_n").over(before), F.lit(0)) + F.lit(start))
    inside = Window.partitionBy(FILE_RANK, "_task").orderBy("_place")
    free = free.withColumn("_at", F.row_number().over(inside) - 1).join(counts.drop("_n"), [FILE_RANK, "_task"])
    free = free.withColumn("packet_id", F.col("_from") + F.col("_at")).drop("_task", "_at", "_from")
    done = rows.filter(F.col("_set").isNotNull()).withColumn("packet_id", F.col("_set"))
    return done.unionByName(free, allowMissingColumns=True).drop("_set", "_place")


def broken_lines(captures: DataFrame) -> DataFrame:
    """Per capture: rows, broken lines, rows without a message number."""
    return captures.groupBy("attack_type", "split").agg(
        F.count(F.lit(1)).alias("n"), F.count(BROKEN).alias("broken"),
        F.count(F.when(F.col(FILE_NO).isNull(), 1)).alias("unnumbered"))


def write_captures(packets: DataFrame, root: str, header: Mapping[str, str] | None = None) -> dict[tuple[str, str], str]:
    """The packets as capture CSVs, one folder per (attack_type, split), with the captures' headers.

    Like a capture, a file has ``Length`` twice: the message's and, as the
    second, the frame's (``Length.1`` once read).  Message numbers restart in
    every file only if the packets' do.
    """
    back = {v: k for k, v in schema.CAPTURE_COLUMNS.items()}
    named = [c for c in packets.columns if c in back]
    # one text column with the header's own spelling: a writer of named columns cannot repeat a name
    quoted = [F.concat(F.lit('"'), F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), '"', '""'), F.lit('"')) for c in named]
    quoted = [F.when(F.col(c).isNull(), F.lit("")).otherwise(q) for c, q in zip(named, quoted, strict=True)]
    line = F.concat_ws(",", *quoted, F.coalesce(F.col("length").cast("string"), F.lit("")))
    title = ",".join([*['"' + back[c] + '"' for c in named], '"Length"'])
    out = {}
    for a, s in sorted((r[0], r[1]) for r in packets.select("attack_type", "split").distinct().collect()):  # a row per capture
        path = f"{root}/{a}_{s}"
        rows = packets.filter((F.col("attack_type") == a) & (F.col("split") == s)).select(line.alias("value"))
        rows = rows.mapInPandas(_titled(title), "value string")
        rows.write.text(path)
        out[(a, s)] = path
    return out


def _titled(title: str):
    def run(batches):
        import pandas as pd
        first = True
        for b in batches:
            yield pd.concat([pd.DataFrame({"value": [title]}), b]) if first else b
            first = False
        if first:
            yield pd.DataFrame({"value": [title]})
    return run


def conform(df: DataFrame) -> DataFrame:
    """Fixed schema: every raw column present and typed; bad values -> null."""
    cols = []
    optional = {c: t for c, t in schema.OPTIONAL_TYPES.items() if c in df.columns}
    for name, typ in (schema.RAW_TYPES | optional).items():
        if name in df.columns:
            src = F.col(name)
            if isinstance(typ, (T.DoubleType, T.LongType, T.IntegerType)):
                if isinstance(df.schema[name].dataType, T.NumericType):
                    c = src.cast(typ)
                else:
                    c = P.finite(P.to_number(src)).try_cast(typ)
            else:
                c = src.cast(typ)
            cols.append(c.alias(name))
        else:
            cols.append(F.lit(None).cast(typ).alias(name))
    if "packet_id" not in df.columns:
        cols[0] = F.monotonically_increasing_id().alias("packet_id")
    extra = [c for c in df.columns if c in (stream.SEG, FILE_RANK, FILE_NO, BROKEN)]
    return df.select(*cols, *extra)


def project_mode(df: DataFrame, mode: str = "core", advanced: bool = False) -> DataFrame:
    """Keep the mode's allow-list (plus keys); Parquet reads only these."""
    fields = schema.CORE_FIELDS if mode == "core" else schema.ALLOWED_FIELDS
    if advanced:
        fields = fields + schema.ADVANCED_FIELDS
    keep = ["packet_id", "attack_type", "split"] + [c for c in fields if c not in ("attack_type", "split")]
    keep += [c for c in df.columns if c == stream.SEG]
    return df.select(*[c for c in keep if c in df.columns])


def standardize(df: DataFrame) -> DataFrame:
    """C1-C9 on a conformed frame: flags, bit-string numbers, base time, key, finite values."""
    t_text = F.col("t").cast("string")
    base = F.coalesce(F.col("epoch_time"), F.col("arrival_time"), F.col("time_s"), P.epoch_seconds(t_text))
    key = F.coalesce(F.col("gocb_ref"), F.lit("nan")) if df.schema["gocb_ref"].nullable else F.col("gocb_ref")
    rest = [F.col(c) for c in df.columns if c != "gocb_ref"]
    # texts that several columns are made of get a column first: the optimizer keeps them apart, so each is parsed once
    out = df.select(*rest, key.alias("gocb_ref"), P.boolean_parts("boolean_raw").alias("_parts"), base.alias("_base"),
                    P.to_number("bit_string").alias("_number"), P.hex_text("bit_string").alias("_hex"))
    out = out.select("*", P.significant("_hex").alias("_digits"))
    out = out.select(
        *rest, "gocb_ref",
        *[f.alias(f"boolean_{i + 1}") for i, f in enumerate(P.part_flags("_parts"))],  # finite or null
        P.finite("_number").alias("bitstring_numeric"),
        P.popcount("_hex").alias("bitstring_bitcount"),
        P.hex_value("_digits").alias("bitstring_int"),
        P.finite("_base").alias("base_time"),
    )
    return out


def typed_packets(df: DataFrame) -> DataFrame:
    """Raw capture-shaped rows -> typed rows, keeping the packets' segment column."""
    return standardize(conform(df))


def tag_multiclass(df: DataFrame) -> DataFrame:
    """Five-class label, ``normal`` for benign rows, else the attack type."""
    return df.withColumn(
        "label", F.when(F.col("attack") == 0, F.lit("normal")).otherwise(F.lower(F.col("attack_type"))))


def used_fields(frames: Sequence[DataFrame]) -> list[str]:
    """Sorted distinct union of column names."""
    return sorted({c for df in frames for c in df.columns})


# Expected class counts of the published capture (per split).
EXPECTED_COUNTS = {
    "train": {"normal": 27958, "injection": 100, "masquerade": 100, "poisoning": 2000, "replay": 100},
    "test": {"normal": 27952, "injection": 100, "masquerade": 100, "poisoning": 2000, "replay": 100},
}
