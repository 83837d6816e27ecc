"""Best-fit packing by large-item matching (operator 5).

Texts become token ids with an end id; a longer one than ``capacity`` is cut
into full pieces with the remainder first.  Lengths are whole numbers up to
the capacity, so the plan needs only how many pieces have each length: a
table of at most ``capacity`` numbers, whatever the corpus.  Lengths above a
third of the capacity are matched greedily, at most two in a sequence (the
longest with the longest that still fits); shorter ones then go, longest
first, into the tightest gap that holds them.  Runs of equal sequences are
planned at once, so the plan's size and time follow the capacity, not the
number of pieces.  Each piece finds its place from its rank among the pieces
of its length.

Defined results: null and empty texts are one piece with the end id alone;
repeated rows are packed each; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .ranking import prefix_sums
from .tokens import KEPT, encoder, with_end
from .wordhash import Texts

CAPACITY = 1024


def pieces(docs: DataFrame, tokenizer: str, cuts: str = "blank", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every piece of every text."""
    def run(table: pa.Table):
        ids, bounds = with_end(*encoder(tokenizer, cuts).encode(Texts(common.column(table, "text"))))
        n = np.diff(bounds)
        head = np.where(n <= capacity, n, np.where(n % capacity == 0, capacity, n % capacity))
        count = 1 + (n - head) // capacity
        row = np.repeat(np.arange(len(n)), count)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        start = np.where(piece == 0, 0, head[row] + (piece - 1) * capacity)
        length = np.where(piece == 0, head[row], capacity)
        lo = bounds[row] + start
        raw = memoryview(ids.astype("<u4").tobytes())
        crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(lo.tolist(), (lo + length).tolist(), strict=True)]
        out = [common.column(table, "doc_id").take(pa.array(row)), pa.array(piece), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            out.append(pa.ListArray.from_arrays(pa.array(np.append(lo, len(ids)).astype(np.int32)), pa.array(ids.view(np.int32))))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(out, names=names)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    narrow = common.plain_ids(docs, "doc_id", "text")
    return common.map_chunks(narrow, lambda t: (b.set_column(1, "piece", b.column(1).cast(pa.int32())) for b in run(t)), schema, keep=KEPT)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Slots (length, first rank, end rank, first sequence, items per sequence, offset) for counts per length."""
    left = dict(counts)
    done: list[tuple[int, tuple]] = []  # (sequences, ((length, items), ...)): no gap that could still be used
    open_: dict[int, list[tuple[int, tuple]]] = {}  # by gap

    def put(n: int, items: tuple, gap: int) -> None:
        if n:
            open_.setdefault(gap, []).append((n, items))

    third = capacity // 3
    large = sorted((s for s in left if s > third), reverse=True)
    for a in large:
        for b in large:
            if not left[a]:
                break
            if b > a or a + b > capacity or not left[b]:
                continue
            n = left[a] // 2 if a == b else min(left[a], left[b])
            put(n, ((a, 2),) if a == b else ((a, 1), (b, 1)), capacity - a - b)
            left[a] -= n
            left[b] -= n
        put(left[a], ((a, 1),), capacity - a)
        left[a] = 0
    for s in sorted((s for s in left if 0 < s <= third), reverse=True):
        while left[s]:
            gap = min((g for g in open_ if g >= s and open_[g]), default=None)
            if gap is None:
                k = capacity // s
                put(left[s] // k, ((s, k),), capacity - k * s)
                rest = left[s] % k
                put(1 if rest else 0, ((s, rest),), capacity - rest * s)
                left[s] = 0
                continue
            n, items = open_[gap].pop()
            k = gap // s
            full = min(n, left[s] // k)
            put(full, (*items, (s, k)), gap - k * s)
            left[s] -= full * k
            if full < n:
                rest = left[s]  # fewer than k remain
                put(1 if rest else 0, (*items, (s, rest)), gap - rest * s)
                put(n - full - (1 if rest else 0), items, gap)
                left[s] = 0
    done = [x for group in open_.values() for x in group]
    slots, next_rank, sequence = [], dict.fromkeys(counts, 0), 0
    for n, items in done:
        offset = 0
        for s, k in items:
            slots.append((s, next_rank[s], next_rank[s] + n * k, sequence, k, offset))
            next_rank[s] += n * k
            offset += s * k
        sequence += n
    return slots


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to every piece (any table with a length and a doc_id, piece order)."""
    spark = parts.sparkSession
    parts = common.cut(parts, "pieces")
    counts = {r.length: r.n for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    slots = np.array(sorted(plan(counts, capacity)), np.int64).reshape(-1, 6)
    shared = spark.sparkContext.broadcast(slots)
    ranked = prefix_sums(parts.withColumn("_one", F.lit(1)), ["doc_id", "piece"], "_one", "_rank", group=["length"]).drop("_one")
    names = [c for c in ranked.columns if c != "_rank"]

    def place(batches):
        table = shared.value
        key = table[:, 0] << 44 | table[:, 1]
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            slot = table[np.searchsorted(key, length << 44 | rank, side="right") - 1]
            item = rank - slot[:, 1]
            each = np.maximum(slot[:, 4], 1)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(slot[:, 3] + item // each), pa.array(slot[:, 5] + item % each * length)], names=[*names, "sequence_id", "offset"])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields if f.name != "_rank")
    return ranked.mapInArrow(common.tidy(place), f"{fields}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, doc_ids, ids): whole training sequences from packed pieces with ids (at most ``capacity`` each)."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.col("parts.doc_id").alias("doc_ids"), F.flatten("parts.ids").alias("ids"))
