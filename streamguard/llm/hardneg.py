"""Hard negatives by Four-Russians scoring of bit-sliced vectors (operator 12).

Components become whole numbers, floor(256 x).  A candidate is stored as bit
planes: for every plane (two's complement, the sign plane last) one bit per
dimension, packed into a byte per group of eight dimensions.  For a block of
anchors and a group, a table holds the sums of all 256 subsets of the
anchors' eight components (each entry is one addition to an earlier one).  A
plane's part of all inner products is then one table row per group and
candidate, and the planes are combined by shifting and adding, the sign plane
negatively: the full exact score, without a multiplication.

All anchors (the stated query set) meet all rows in blocks: candidates are
dealt once into blocks of rows; blocks of anchors, packed into single rows,
visit every block of candidates.  A task holds one block of candidates and
the tables of one block of anchors.  A first pass finds every anchor's
positives (the best of its label, merged over blocks), a second one the best
rows of other labels within each positive's window of scores.

Defined results: rows with a null id, label or vector, an empty vector or a
null or non-finite component take no part; vectors of another length than the
anchor's are no partners of it; rows that share a vec_id are rows of their
own, "other" rows have another vec_id; an anchor without positives, or a
window without rows, gives no rows; an empty table gives an empty result.
Scores are 64-bit; components are exact up to 2^45.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

SCALE, CLASSES, NOISY, ANCHORS = 256, 10, 7, 50
POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies within these percentages of the positive's.
WINDOW_PCT = (50, 95)
#: Anchors whose tables a task holds at once: at 64 dimensions 4 MB of 64-bit sums.
ANCHOR_BLOCK = 256
#: Rows of a block of candidates: the larger number once there are many blocks.
CANDIDATE_BLOCK = (2048, 65536)
_NONE = -(1 << 62)


def bit_planes(v: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes, groups) bytes of whole numbers (rows, dims) in two's complement."""
    n, d = v.shape
    wide = np.zeros((n, -(-d // 8) * 8), np.int64)
    wide[:, :d] = v
    out = np.empty((n, planes, wide.shape[1] // 8), np.uint8)
    for b in range(planes):
        out[:, b] = np.packbits(((wide >> b) & 1).astype(np.uint8), axis=1, bitorder="little")
    return out


def whole_numbers(planes: np.ndarray, dims: int) -> np.ndarray:
    """The inverse of ``bit_planes``."""
    bits = np.unpackbits(planes, axis=2, bitorder="little")[:, :, :dims].astype(np.int64)
    weight = np.int64(1) << np.arange(planes.shape[1], dtype=np.int64)
    weight[-1] = -weight[-1]
    return np.einsum("npd,p->nd", bits, weight)


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): sums of every subset of each group of eight components."""
    a, d = anchors.shape
    wide = np.zeros((a, -(-d // 8) * 8), np.int64)
    wide[:, :d] = anchors
    out = np.zeros((wide.shape[1] // 8, 256, a), np.int64)
    for g in range(len(out)):
        for j in range(8):
            out[g, 1 << j:2 << j] = out[g, :1 << j] + wide[:, 8 * g + j]
    return out


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(candidates, anchors) exact inner products from tables and packed planes."""
    total = None
    for b in range(planes.shape[1] - 1, -1, -1):
        part = tables[0][planes[:, b, 0]]
        for g in range(1, len(tables)):
            part += tables[g][planes[:, b, g]]
        if total is None:
            total = -part
        else:
            total <<= 1
            total += part
    return total


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k highest scores, ties by smaller id."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        pick = np.flatnonzero(score >= least)
        return pick[np.lexsort((ids[pick], -score[pick]))[:k]]
    return np.lexsort((ids, -score))[:k]


def valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v): the rows that take part, labels as the noise rule leaves them, whole components."""
    e = F.col("embedding")
    number = F.expr(f"transform(embedding, x -> floor({SCALE} * cast(x as double)))")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % NOISY == 0, (F.col("label") + 1) % CLASSES).otherwise(F.col("label"))
    rows = vectors.select("vec_id", "label", "embedding").where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & e.isNotNull() & (F.size(e) > 0))
    return rows.where(finite).select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), number.alias("v"))


def packed(rows: DataFrame, planes: int) -> DataFrame:
    """(vec_id, label, dims, planes) with the packed bit planes of ``v``."""
    def run(batches):
        for batch in batches:
            size = pa.compute.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
            for d in np.unique(size).tolist():
                part = batch.filter(pa.array(size == d))
                v = part.column("v").flatten().to_numpy().reshape(-1, d)
                raw = bit_planes(v, planes).reshape(len(v), -1)
                data = pa.Array.from_buffers(pa.binary(), len(v), [None, pa.py_buffer((np.arange(len(v) + 1, dtype=np.int32) * raw.shape[1]).tobytes()), pa.py_buffer(raw.tobytes())])
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), pa.array(np.full(len(v), d, np.int32)), data], names=["vec_id", "label", "dims", "planes"])
    return rows.mapInArrow(common.tidy(run), "vec_id long, label long, dims int, planes binary")


def _planes(column: pa.Array, planes: int) -> np.ndarray:
    raw = [np.frombuffer(x, np.uint8) for x in column.to_pylist()]
    return np.stack(raw).reshape(len(raw), planes, -1)


def _meet(candidates: DataFrame, anchors: DataFrame, blocks: int, planes: int, pick, schema: str) -> DataFrame:
    """Every block of anchors with every block of candidates of its length.

    Rows of a block of candidates come first (``side`` 0) and are held; each
    row of side 1 is a block of anchors, which ``pick(anchor rows, scores,
    ids, labels)`` turns into result columns.
    """
    visits = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    nothing = {c: F.lit(None).cast(t) for c, t in [*candidates.dtypes, *anchors.dtypes]}
    order = ["dims", "block", "side", "vec_id", "label", "planes", "members"]
    sides = [df.withColumn("side", F.lit(i)).withColumns({c: nothing[c] for c in order if c not in df.columns and c != "side"}).select(*order) for i, df in enumerate((candidates, visits))]
    dealt = sides[0].unionByName(sides[1]).repartition(blocks, "dims", "block").sortWithinPartitions("dims", "block", "side")

    def run(batches):
        at, held, block = None, [], None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("dims", "block", "side")), strict=True))
            edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if lo == hi:
                    continue
                if keys[lo][:2] != at:
                    at, held, block = keys[lo][:2], [], None
                part = batch.slice(lo, hi - lo)
                if keys[lo][2] == 0:
                    held.append((_planes(part.column("planes"), planes), part.column("vec_id").to_numpy(), part.column("label").to_numpy()))
                    continue
                if block is None:
                    block = [np.concatenate(x) for x in zip(*held, strict=True)] if held else []
                    held = []
                if not block:
                    continue
                for members in part.column("members").to_pylist():
                    mine = whole_numbers(np.stack([np.frombuffer(m["planes"], np.uint8) for m in members]).reshape(len(members), planes, -1), at[0])
                    tables = subset_sums(mine)
                    found = []
                    for i in range(0, len(block[0]), 4096):
                        got = scores(tables, block[0][i:i + 4096])
                        found.append(pick(members, got.T, block[1][i:i + 4096], block[2][i:i + 4096]))
                    yield from (x for x in found if x.num_rows)
    return dealt.mapInArrow(common.tidy(run), schema)


def _positives(members, got, ids, labels):
    out = []
    for m, score in zip(members, got, strict=True):
        same = np.flatnonzero((labels == m["label"]) & (ids != m["vec_id"]))
        best = same[_best(score[same], ids[same], POSITIVES)]
        out += [(m["anchor"], int(ids[i]), int(score[i])) for i in best]
    return _batch(out, ["anchor", "positive_id", "positive_score"])


def _negatives(members, got, ids, labels):
    out = []
    for m, score in zip(members, got, strict=True):
        other = np.flatnonzero(labels != m["label"])
        s = score[other]
        for p in m["positives"]:
            goal = p["positive_score"]
            near = other[(s >= -(-WINDOW_PCT[0] * goal // 100)) & (s <= WINDOW_PCT[1] * goal // 100)]
            best = near[_best(score[near], ids[near], NEGATIVES)]
            out += [(m["anchor"], p["place"], int(ids[i]), int(score[i])) for i in best]
    return _batch(out, ["anchor", "place", "negative_id", "negative_score"])


def _batch(rows: list, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _top(df: DataFrame, by: list[str], score: str, key: str, k: int, rank: str) -> DataFrame:
    """The k best rows of each group, ties by smaller key; Spark cuts each task's part before the shuffle."""
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(key))
    return df.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k)


def mine(vectors: DataFrame) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank)."""
    rows = valid(vectors)
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.max(F.array_max(F.transform("v", lambda x: F.greatest(x, -x - 1)))), F.lit(0)).alias("most")).first()
    planes = int(size.most).bit_length() + 1
    small, large = CANDIDATE_BLOCK
    each = min(large, max(small, size.n // 64))
    blocks = max(1, -(-size.n // each))
    table = common.cut(packed(rows, planes).withColumn("row", F.monotonically_increasing_id()), "planes")
    candidates = table.select("dims", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), "vec_id", "label", "planes")
    queries = table.where(F.col("vec_id") % ANCHORS == 0).select(F.col("row").alias("anchor"), "vec_id", "label", "dims", "planes")
    groups = max(1, -(-size.n // ANCHORS // ANCHOR_BLOCK))

    def in_blocks(df: DataFrame, *more: str) -> DataFrame:
        return df.groupBy("dims", F.pmod(F.xxhash64("anchor"), F.lit(groups)).alias("set")).agg(F.collect_list(F.struct("anchor", "vec_id", "label", "planes", *more)).alias("members")).drop("set")

    found = _meet(candidates, in_blocks(queries), blocks, planes, _positives, "anchor long, positive_id long, positive_score long")
    positives = common.cut(_top(found, ["anchor"], "positive_score", "positive_id", POSITIVES, "place"), "positives")
    wanted = positives.groupBy("anchor").agg(F.collect_list(F.struct("place", "positive_score")).alias("positives"))
    near = _meet(candidates, in_blocks(queries.join(wanted, "anchor"), "positives"), blocks, planes, _negatives, "anchor long, place long, negative_id long, negative_score long")
    best = _top(near, ["anchor", "place"], "negative_score", "negative_id", NEGATIVES, "rank")
    names = queries.select("anchor", F.col("vec_id").alias("anchor_id"))
    return best.join(positives, ["anchor", "place"]).join(names, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score", F.col("place").cast("int").alias("positive_rank"))
