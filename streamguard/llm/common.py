"""Shared tables, task-sized shards and Arrow batch chunks for the operators of this package."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Bytes of input text that one shard of packed hashes stands for.
SHARD_BYTES = 8 << 20
#: Text bytes that a task holds at once; one longer text makes a chunk of its own.
CHUNK_BYTES = 1 << 20
BATCH_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Tests and other local sessions may leave it unset and call
    ``setCheckpointDir`` instead; a cluster session with neither is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return configured.rstrip("/")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches to Python end at BATCH_BYTES, not only at a number of rows: texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"


def cut(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: lineage ends there."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_measured(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, dict]:
    """``cut``, and aggregates of the rows (``rows``, their number, and ``metrics``) taken while they are written."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    wanted = [F.count(F.lit(1)).alias("rows"), *(c.alias(k) for k, c in metrics.items())]
    out = cut(df.observe(seen, *wanted), name)
    return out, dict(seen.get)


def remove(df: DataFrame) -> None:
    """Delete the files of a table made by ``cut`` once its successor is written."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def input_bytes(df: DataFrame) -> int:
    """Bytes that ``df`` reads, as the optimizer knows them from its files; measured where it does not."""
    known = int(str(df._jdf.queryExecution().analyzed().stats().sizeInBytes()))
    if known < 1 << 50:
        return known
    texts = [F.coalesce(F.octet_length(f"`{n}`"), F.lit(0)) for n, t in df.dtypes if t in ("string", "binary")]
    row = df.agg(F.count("*").alias("n"), F.sum(sum(texts, F.lit(0))).alias("b")).first()
    return 16 * row.n + (row.b or 0)


def shards_for(df: DataFrame, shard_bytes: int = SHARD_BYTES) -> int:
    """Number of shards, following the input size, never below the session's shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, least, -(-input_bytes(df) // shard_bytes))


#: What a Python worker keeps between tasks: one table at a time, by name.
_kept: dict = {}


def kept(name: str, key, build: Callable):
    """The worker's table ``name`` for ``key``, built once and kept for the worker's next tasks."""
    if _kept.get(name, (None,))[0] != key:
        _kept.clear()
        _kept[name] = (key, build())
    return _kept[name][1]


def give_back() -> None:
    """Return freed memory to the system; an idle worker otherwise keeps what its largest chunk took."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def tidy(fn: Callable) -> Callable:
    """A ``mapInArrow`` function whose worker gives its memory back at the end of each task."""
    def run(batches):
        yield from fn(batches)
        give_back()
    return run


def by_chunk(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES, keep: str | None = None) -> Iterator[pa.Table]:
    """Regroup Arrow batches into tables of about ``limit`` text bytes (at least one row each).

    Workers serve one operator after another: what they still keep for others than ``keep`` goes first.
    """
    for name in [n for n in _kept if n != keep]:
        del _kept[name]
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        at = 0
        for i, n in enumerate(lengths.tolist()):
            if size and size + n > limit:
                if i > at:
                    held.append(batch.slice(at, i - at))
                yield pa.Table.from_batches(held)
                held, size, at = [], 0, i
            size += n + 16
        if at < batch.num_rows:
            held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def column(table: pa.Table, name: str) -> pa.Array:
    """One contiguous array of a column."""
    got = table.column(name).combine_chunks()
    return pa.concat_arrays(got.chunks) if isinstance(got, pa.ChunkedArray) else got


def map_chunks(df: DataFrame, fn: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str, text: str = "text", limit: int = CHUNK_BYTES, keep: str | None = None) -> DataFrame:
    """``mapInArrow`` over chunks of bounded text size."""
    def run(batches):
        for table in by_chunk(batches, text, limit, keep):
            yield from fn(table)
    return df.mapInArrow(tidy(run), schema)


def squeeze(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace ``text`` by a zstd-compressed binary column ``z``: long texts shuffle at less than half their size.

    A null text becomes an empty one.
    """
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != text)
    names = [f.name for f in df.schema.fields if f.name != text]

    def run(batches):
        import zstandard
        pack = zstandard.ZstdCompressor(level=1)
        for b in batches:
            z = [pack.compress((t or "").encode()) for t in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(z, pa.binary())], names=[*names, "z"])
    return df.mapInArrow(tidy(run), f"{out}, z binary")


def unsqueeze(z: pa.Array) -> list[bytes]:
    import zstandard
    unpack = zstandard.ZstdDecompressor()
    return [unpack.decompress(x) if x else b"" for x in z.to_pylist()]


def plain_ids(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, whatever else the table carries."""
    return df.select(*[F.col(f"`{n}`") for n in names])
