"""Shards by a consistent-hash ring with virtual nodes and bounded loads (operator 11).

Every shard stands at ``REPLICAS`` points of a ring; a document belongs to the
first point clockwise of its own hash.  A shard takes documents up to its
capacity, in the order of a second hash; the others walk on clockwise to the
next shard that still has room, round by round, until all are placed.  This
is the ring with bounded loads for one order of insertion: documents that
find room at home first, then those that walked once, and so on.

Capacities follow the law: ``rows`` gives every shard the whole part of rows /
shards and one row more to the first of them, so counts are at most one
apart; ``bytes`` gives every shard (1 + slack) times the mean of bytes, which
the last document that it takes may exceed.  A document that has room at home
under both numbers of shards stays when a shard is added.

The ring is a table of cells (hash prefixes) with the next open shard of
each; its size follows the number of points, not the data, so it is broadcast.
A round ranks the walking rows of all shards by ranges of (shard, hash): one
shard, or one repeated key, may hold most rows.  The driver sees one number
per shard and round; there are at most as many rounds as shards, and a few in
practice, each over the overflow of the one before.

Only DataFrame functions run here.

Defined results: a null text has no bytes (crc 0); a null doc_id is placed by
its text; rows that share a doc_id share their home, and overflow like
others; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .ranking import prefix_sums

SHARDS, REPLICAS = 40, 256
#: Bytes that a row counts besides its text.
ROW_BYTES = 16
SEED = "ring"


def _cell_bits(shards: int, replicas: int) -> int:
    """Sixteen cells a point on average, so that few points share one."""
    return max(10, min(24, (16 * shards * replicas).bit_length()))


def ring(spark: SparkSession, shards: int, replicas: int, bits: int, closed: list[int], seed: str = SEED) -> DataFrame:
    """(cell, shard): the first open shard clockwise of every cell."""
    points = spark.range(0, shards * replicas, 1, 1).select(F.floor(F.col("id") / replicas).cast("int").alias("shard"), (F.col("id") % replicas).alias("replica"))
    points = points.select("shard", F.xxhash64(F.lit(seed), "shard", "replica").alias("point"))
    points = points.where(~F.col("shard").isin(closed)) if closed else points
    cells = points.groupBy(F.shiftrightunsigned("point", 64 - bits).alias("cell")).agg(F.min_by("shard", "point").alias("shard"))
    order = Window.orderBy("cell")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = (1 << bits) - 1
    cells = cells.select("cell", "shard", F.lag("cell").over(order).alias("before"), F.max("cell").over(everything).alias("top"))
    home = F.sequence(F.coalesce(F.col("before") + 1, F.lit(0).cast("long")), F.col("cell"))
    wrapped = F.when(F.col("before").isNull() & (F.col("top") < last), F.sequence(F.least(F.col("top") + 1, F.lit(last).cast("long")), F.lit(last).cast("long")))
    return cells.select(F.explode(F.concat(home, F.coalesce(wrapped, F.array().cast("array<bigint>")))).alias("cell"), "shard")


def keyed(docs: DataFrame, bits: int, seed: str = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, cell, turn, tie): what placing needs of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    own = F.when(F.col("doc_id").isNotNull(), F.xxhash64(F.lit(seed), F.lit("id"), F.col("doc_id"))).otherwise(F.xxhash64(F.lit(seed), F.lit("text"), F.col("text_crc32"), F.col("size")))
    return rows.withColumn("own", own).select(
        "doc_id", "size", "text_crc32", F.shiftrightunsigned("own", 64 - bits).alias("cell"),
        F.xxhash64(F.lit(seed), F.lit("turn"), F.col("own")).alias("turn"), F.monotonically_increasing_id().alias("tie"))


def capacities(law: str, shards: int, n: int, size: int, slack: float) -> list[int]:
    if law == "rows":
        return [n // shards + (s < n % shards) for s in range(shards)]
    if law == "bytes":
        return [int(-(-size * (1 + slack) // shards))] * shards
    raise ValueError(f"unknown law {law!r}")


def place(docs: DataFrame, shards: int = SHARDS, law: str = "rows", replicas: int = REPLICAS, slack: float = 0.02, seed: str = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, hops) of every row; ``hops`` counts full shards that it passed in rounds.

    ``slot`` numbers a shard's rows from 0.
    """
    spark = docs.sparkSession
    bits = _cell_bits(shards, replicas)
    walking = common.cut(keyed(docs, bits, seed), "keyed")
    total = walking.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("size")).first()
    room = capacities(law, shards, total.n, int(total.size), slack)
    weight = F.lit(1).cast("long") if law == "rows" else F.col("size")
    placed, used, hops = [], [0] * shards, 0
    while walking is not None:
        owner = ring(spark, shards, replicas, bits, [s for s in range(shards) if room[s] <= 0], seed)
        at = walking.join(F.broadcast(owner), "cell").withColumn("weight", weight)
        ranked = common.cut(prefix_sums(at, ["turn", "doc_id", "text_crc32", "tie"], "weight", "before", group=["shard"]), "ranked")
        loads = {r.shard: r for r in ranked.groupBy("shard").agg(F.sum("weight").alias("w"), F.count("*").alias("n")).collect()}  # a row per shard
        limit = F.element_at(F.array(*[F.lit(x).cast("long") for x in room]), F.col("shard") + 1)
        begun = F.element_at(F.array(*[F.lit(x).cast("long") for x in used]), F.col("shard") + 1)
        home = ranked.where(F.col("before") < limit).select("doc_id", "size", "text_crc32", "shard", "turn", "tie", (begun + F.col("before")).alias("slot"), F.lit(hops).alias("hops"))
        placed.append(home)
        over = any(x.w > room[s] for s, x in loads.items())
        for s, x in loads.items():
            used[s] += min(x.w, room[s])
            room[s] = max(0, room[s] - x.w)
        walking = ranked.where(F.col("before") >= limit).select("doc_id", "size", "text_crc32", "cell", "turn", "tie") if over else None
        hops += 1
    out = placed[0]
    for more in placed[1:]:
        out = out.unionByName(more)
    if law != "rows":  # prefix sums of bytes are no slots
        out = out.drop("slot").withColumn("one", F.lit(1).cast("long"))
        out = prefix_sums(out, ["hops", "turn", "doc_id", "tie"], "one", "slot", group=["shard"])
    return out.select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"), "hops")


def report(docs: DataFrame, shards: int = SHARDS, law: str = "rows", **options) -> DataFrame:
    """The placing with its law; a bounded ring may move rows between old shards, so ``grown_shard`` is null."""
    return place(docs, shards, law, **options).select(
        "doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hops")
