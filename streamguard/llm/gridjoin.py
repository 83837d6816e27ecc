"""Embedding near-duplicates by an epsilon grid order join (operator 1).

Vectors are scaled to length one, so cosine >= c means distance at most
eps = sqrt(2 - 2c).  They are projected on the leading principal axes (which
never lengthens a distance), put into grid cells eps wide, and sorted by
cells: the epsilon grid order.  The sequence is cut into intervals of at most
``LEAF`` vectors, and a tree of intervals with their bounding boxes is joined
with itself from the root down: a pair of intervals is split into the pairs
of their children, and pairs whose boxes lie further apart than eps are
dropped with all that is below them.  What is left are pairs of leaf
intervals, compared by one matrix product each in double precision.  They are
dealt by tiles of neighbouring leaves, so that a leaf's vectors are sent once
per tile.

Equal vectors are one row of the join, with their number, so a vector that a
third of all rows share costs one row.  Leaf pairs return counts per vector
and the smallest vector each one reaches within the pair, never the links
themselves; the latter make the components.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components, and rows with a null id, link with nothing; vectors of
different lengths do not link; rows that repeat an id are copies like others;
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .components import components

COSINE = 0.9
AXES, LEAF, FAN_OUT_BITS = 6, 1024, 2
#: Bytes of vectors, in double precision, that a task holds of one side of a tile of leaf pairs.
TILE_BYTES = 32 << 20


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _axes(classes: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and leading principal axes of the unit vectors, from summed moments (dim * dim numbers)."""
    def moments(batches):
        total = np.zeros((dim + 1, dim))
        for b in batches:
            x = _matrix(b.column("embedding"), dim)
            total[:dim] += x.T @ x
            total[dim] += x.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim + 1)), pa.ListArray.from_arrays(pa.array(np.arange(dim + 2, dtype=np.int32) * dim), pa.array(total.reshape(-1)))], names=["i", "s"])
    parts = classes.select("embedding").mapInArrow(common.tidy(moments), "i long, s array<double>")
    sums = parts.select("i", F.posexplode("s").alias("j", "s")).groupBy("i", "j").agg(F.sum("s").alias("s")).toPandas()
    total = np.zeros((dim + 1, dim))
    total[sums.i, sums.j] = sums.s
    n = classes.count()
    mean = total[dim] / max(1, n)
    _, vectors = np.linalg.eigh(total[:dim] / max(1, n) - np.outer(mean, mean))
    return mean, np.ascontiguousarray(vectors[:, ::-1][:, :AXES])


def _leaves(classes: DataFrame, dim: int, eps: float) -> DataFrame:
    """(leaf, lo, hi, ids, weights, vectors): intervals of the epsilon grid order."""
    mean, axes = _axes(classes, dim)
    k = axes.shape[1]

    def project(batches):
        for b in batches:
            p = (_matrix(b.column("embedding"), dim) - mean) @ axes
            cells = np.floor(p / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(cells[:, j]) for j in range(k)), pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * k), pa.array(p.reshape(-1)))],
                                             names=[*b.schema.names, *(f"c{j}" for j in range(k)), "p"])
    kind = dict(classes.dtypes)["embedding"]
    order = [f"c{j}" for j in range(k)] + ["rep"]
    rows = classes.select("rep", "m", "embedding").mapInArrow(common.tidy(project), f"rep long, m long, embedding {kind}, " + ", ".join(f"c{j} int" for j in range(k)) + ", p array<double>")
    parts = max(1, min(common.shards_for(classes), 1 + classes.count() // LEAF))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def pack(batches):
        """Consecutive rows of a partition as leaves."""
        held, at, part = [], 0, None
        def leaf(t):
            p = t.column("p").combine_chunks().flatten().to_numpy().reshape(-1, k)
            vectors = t.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([at], pa.int64()), pa.array([p.min(axis=0).tolist()]), pa.array([p.max(axis=0).tolist()]),
                                               pa.array([t.column("rep").to_numpy().tobytes()]), pa.array([t.column("m").to_numpy().tobytes()]), pa.array([vectors.astype(np.float64 if vectors.dtype == np.float64 else np.float32).tobytes()])],
                                              names=["part", "at", "lo", "hi", "ids", "weights", "vectors"])
        for b in batches:
            if not b.num_rows:
                continue
            part = b.column("part")[0].as_py()
            held = [pa.Table.from_batches([*(x for t in held for x in t.to_batches()), b])]
            while held[0].num_rows >= LEAF:
                yield leaf(held[0].slice(0, LEAF).combine_chunks())
                held, at = [held[0].slice(LEAF)], at + 1
        if held and held[0].num_rows:
            yield leaf(held[0].combine_chunks())
    leaves = common.cut(rows.mapInArrow(common.tidy(pack), "part int, at long, lo array<double>, hi array<double>, ids binary, weights binary, vectors binary"), "leaves")
    counts = leaves.groupBy("part").agg(F.count("*").alias("n"))
    places = counts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    return leaves.join(places, "part").withColumn("leaf", F.col("first") + F.col("at")).drop("part", "first", "at")


def _apart(k: int):
    """Squared distance of boxes (lo, hi) and (lo2, hi2)."""
    gap = [F.greatest(F.lit(0.0), F.col("lo")[j] - F.col("hi2")[j], F.col("lo2")[j] - F.col("hi")[j]) for j in range(k)]
    return sum((g * g for g in gap[1:]), gap[0] * gap[0])


def _leaf_pairs(leaves: DataFrame, eps: float, k: int) -> DataFrame:
    """(a, b), a <= b: leaf intervals that may hold vectors within eps, from the root of the tree down."""
    level = common.cut(leaves.select(F.col("leaf").alias("node"), "lo", "hi"), "level")
    levels = [level]
    while level.agg(F.coalesce(F.max("node"), F.lit(0))).first()[0] > 0:
        up = level.groupBy(F.shiftright("node", FAN_OUT_BITS).alias("node")).agg(
            F.array(*[F.min(F.col("lo")[j]) for j in range(k)]).alias("lo"), F.array(*[F.max(F.col("hi")[j]) for j in range(k)]).alias("hi"))
        level = common.cut(up, "level")
        levels.append(level)
    pairs = level.select(F.col("node").alias("a"), F.col("node").alias("b"))
    limit = eps * eps * (1 + 1e-9) + 1e-12
    for below in reversed(levels[:-1]):
        left = below.select(F.shiftright("node", FAN_OUT_BITS).alias("a"), F.col("node").alias("x"), "lo", "hi")
        right = below.select(F.shiftright("node", FAN_OUT_BITS).alias("b"), F.col("node").alias("y"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
        split = pairs.join(left, "a").join(right, "b").where((F.col("x") <= F.col("y")) & (_apart(k) <= limit))
        pairs = common.cut(split.select(F.col("x").alias("a"), F.col("y").alias("b")), "pairs")
    return pairs


def _compare(batches, dim: int, cosine: float):
    """The leaves of a tile's first side, then those of its second with their partners: links per vector (weighted) and the smallest vector reached."""
    now, held = None, {}
    for batch in batches:
        for row in batch.to_pylist():
            kind = np.float64 if len(row["vectors"]) == len(row["ids"]) * dim else np.float32
            x = np.frombuffer(row["vectors"], kind).astype(np.float64).reshape(-1, dim)
            other = (np.frombuffer(row["ids"], np.int64), np.frombuffer(row["weights"], np.int64), x / np.sqrt((x * x).sum(axis=1, keepdims=True)))
            if now != (row["ta"], row["tb"]):
                now, held = (row["ta"], row["tb"]), {}
            if row["partners"] is None:
                held[row["leaf"]] = other
                continue
            for a in row["partners"]:
                yield from _links(held[a], other, a == row["leaf"], cosine)


def _links(mine: tuple, other: tuple, same: bool, cosine: float):
    """Links between two leaves, or within one."""
    ids, weights, vectors = mine
    linked = vectors @ other[2].T >= cosine
    if same:
        np.fill_diagonal(linked, False)
    some, cols = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
    if not len(some):
        return
    linked = linked[np.ix_(some, cols)]
    la, lb = ids[some], other[0][cols]
    high = np.iinfo(np.int64).max
    while True:  # smallest id within the pair's links
        na = np.minimum(la, np.where(linked, lb[None, :], high).min(axis=1))
        nb = np.minimum(lb, np.where(linked, na[:, None], high).min(axis=0))
        if (na == la).all() and (nb == lb).all():
            break
        la, lb = na, nb
    counts = linked @ other[1][cols]
    out = [(ids[some], counts, la)]
    if not same:
        out.append((other[0][cols], linked.T @ weights[some], lb))
    for i, n, low in out:
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(n.astype(np.int64)), pa.array(low)], names=["id", "links", "low"])


def _dealt(pairs: DataFrame, body: DataFrame, width: int, parts: int) -> DataFrame:
    """Leaf pairs by tiles of ``width`` x ``width`` neighbouring leaves: a leaf's vectors go once to each tile that compares it, not once per pair."""
    pairs = pairs.withColumn("ta", F.floor(F.col("a") / width)).withColumn("tb", F.floor(F.col("b") / width))
    columns = ["ta", "tb", "partners", "leaf", "ids", "weights", "vectors"]
    left = pairs.select("ta", "tb", "a", F.lit(None).cast("array<long>").alias("partners")).distinct().join(body, F.col("a") == F.col("leaf")).select(*columns)
    right = pairs.groupBy("ta", "tb", "b").agg(F.collect_list("a").alias("partners")).join(body, F.col("b") == F.col("leaf")).select(*columns)
    return left.unionByName(right).repartition(parts, "ta", "tb").sortWithinPartitions("ta", "tb", F.col("partners").isNotNull(), "leaf")


def _join(classes: DataFrame, dim: int, cosine: float) -> DataFrame:
    """(id, links, low) of linked classes of one vector length, in parts."""
    eps = float(np.sqrt(2 - 2 * cosine))
    leaves = common.cut(_leaves(classes, dim, eps), "leaves")
    pairs = _leaf_pairs(leaves, eps, min(AXES, dim))
    n, cores = leaves.count(), classes.sparkSession.sparkContext.defaultParallelism
    # a tile's first side fits TILE_BYTES; small tables are cut finer, to give all cores work
    width = max(1, min(TILE_BYTES // (LEAF * dim * 8), -(-n // int(np.ceil(np.sqrt(4 * cores))))))
    parts = max(common.shards_for(classes), int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = _dealt(pairs, leaves.select("leaf", "ids", "weights", "vectors"), width, parts)
    return dealt.mapInArrow(common.tidy(lambda b: _compare(b, dim, cosine)), "id long, links long, low long")


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding)."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(x.isNotNull() & finite & F.exists(x, lambda v: v != 0) & F.col("vec_id").isNotNull(), F.lit(False))
    rows = common.plain_ids(vectors, "vec_id", "embedding").withColumn("usable", usable)
    classes = common.cut(rows.where("usable").groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m")), "classes")
    dims = [r[0] for r in classes.select(F.size("embedding").alias("d")).distinct().orderBy("d").collect()]  # vector lengths in use
    found = None
    for d in dims:
        part = _join(classes.where(F.size("embedding") == d), d, cosine)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = classes.select(F.col("rep").alias("id"), F.col("m").alias("links"), F.col("rep").alias("low"))
    found = common.cut(found, "found")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    nodes = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")).where(F.col("a") != F.col("b")))
    known = classes.join(links, classes.rep == links.id, "left").join(nodes, classes.rep == nodes.node, "left")
    known = known.select(F.col("embedding").alias("_e"), (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n"), F.coalesce("component", "rep").alias("c"))
    out = rows.join(known, F.col("usable") & (F.col("embedding") == F.col("_e")), "left")
    component = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
