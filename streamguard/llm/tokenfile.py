"""Token ids in Parquet list columns (operator 9).

Documents are range-partitioned and sorted by id, tokenized, and written as
one file per range: a list column of ids (dictionary-encoded: a vocabulary is
small against the tokens), the numeric columns delta-encoded (Parquet v2
pages), with row groups and pages of fixed size and the page indexes that
Parquet's writer adds.  A reader that wants some documents, or only lengths
and places, reads just those pages (``read_index``, ``read_tokens``).  Each
row knows how many ids lie before it in its file; per-file totals, a table as
long as the number of files, give its place in the whole.

Defined results: null and empty texts hold the end id alone; a null doc_id
sorts first; repeated rows follow each other; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .tokens import KEPT, encoder, with_end
from .wordhash import Texts

ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 16 << 20, 128 << 10, 2_000


def write_tokens(docs: DataFrame, path: str, tokenizer: str, cuts: str = "word") -> None:
    """Write (part, row, doc_id, n_tokens, before, ids) in ascending doc_id order under ``path``."""
    def run(batches):
        part, row, before = TaskContext.get().partitionId(), 0, 0
        for table in common.by_chunk(batches, "text", keep=KEPT):
            ids, bounds = with_end(*encoder(tokenizer, cuts).encode(Texts(common.column(table, "text"))))
            n = len(bounds) - 1
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, part, np.int32)), pa.array(np.arange(row, row + n)), common.column(table, "doc_id"), pa.array(np.diff(bounds)), pa.array(before + bounds[:-1]),
                                              pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32)))], names=["part", "row", "doc_id", "n_tokens", "before", "ids"])
            row, before = row + n, before + int(bounds[-1])
    ordered = common.plain_ids(docs, "doc_id", "text").repartitionByRange(common.shards_for(docs), "doc_id").sortWithinPartitions("doc_id")
    (ordered.mapInArrow(common.tidy(run), "part int, row long, doc_id long, n_tokens long, before long, ids array<int>").write
     .option("compression", "zstd").option("parquet.writer.version", "v2")
     .option("parquet.block.size", str(ROW_GROUP_BYTES)).option("parquet.page.size", str(PAGE_BYTES)).option("parquet.page.row.count.limit", str(PAGE_ROWS))
     .option("parquet.enable.dictionary", "true").option("parquet.enable.dictionary#doc_id", "false").option("parquet.enable.dictionary#before", "false").option("parquet.enable.dictionary#row", "false")
     .parquet(path))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(part, row, doc_id, start, n_tokens): only the numeric columns are read."""
    rows = spark.read.parquet(path).select("part", "row", "doc_id", "n_tokens", "before")
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = files.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("_place"))
    return rows.join(places, "part").select("part", "row", "doc_id", (F.col("_place") + F.col("before")).alias("start"), "n_tokens")


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """(part, row, doc_id, ids) of the documents with ids from ``first`` to ``last``; the filter reaches the pages."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.where(F.col("doc_id") <= last)
    return rows.select("part", "row", "doc_id", "ids")


def _crc(batches):
    for b in batches:
        lists = b.column("ids")
        raw = memoryview(lists.flatten().to_numpy(zero_copy_only=False).astype("<i4").tobytes())
        edge = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))]) * 4
        crc = [zlib.crc32(raw[x:y]) for x, y in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("part"), b.column("row"), pa.array(crc, pa.int64())], names=["part", "row", "ids_crc32"])


def round_trip(docs: DataFrame, tokenizer: str, cuts: str = "word") -> DataFrame:
    """Write the token files into the shared folder and report every document from them."""
    spark = docs.sparkSession
    path = common.new_path(spark, "tokens")
    write_tokens(docs, path, tokenizer, cuts)
    sums = read_tokens(spark, path).drop("doc_id").mapInArrow(common.tidy(_crc), "part int, row long, ids_crc32 long")
    return read_index(spark, path).join(sums, ["part", "row"]).select("doc_id", "start", "n_tokens", "ids_crc32")
