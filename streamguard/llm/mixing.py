"""Mixing sources to target weights by systematic sampling (operator 3).

Sources, in code-point order with null last, weigh 1, 2, 3, repeating, and
share the corpus's words; a source's target stops at ``MAX_REPEAT`` times its
size and the excess goes to the others by weight.  That is water filling: one
level per weight, found from prefix sums over the sources by their ratio of
cap to weight.  Within a source all documents expect target / size copies;
ordered by size (which spreads the chosen ones over all sizes), document
number r has the prefix sum r * copies, and is emitted once per whole number
that the prefix sum plus the source's one random offset crosses.

Ranks come from ranges of the sorted rows, so one source may hold most rows.

Defined results: a null text has size 0; sources of size 0 have target 0; a
null source is a source; repeated rows are sampled each; an empty table gives
an empty result.  The offset depends on the source's name and ``seed`` only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .ranking import prefix_sums

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text="text"):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, cap: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size): water filling over all sources."""
    named = sizes.select("source", "source_size", F.col("source").isNull().alias("_last"), F.lit(1).alias("_one"))
    ranked = prefix_sums(named, ["_last", "source"], "_one", "_rank")
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int")).cast("long")
    capped = ranked.select("source", "source_size", pick.alias("weight")).withColumn("_cap", F.col("source_size") * cap)
    capped = capped.withColumn("_ratio", F.col("_cap") / F.col("weight"))
    below = prefix_sums(prefix_sums(capped, ["_ratio", "source"], "_cap", "_caps"), ["_ratio", "source"], "weight", "_weights")
    total = below.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("t"), F.coalesce(F.sum("weight"), F.lit(0)).alias("w")).first()
    level = (F.lit(total.t) - F.col("_caps")) / F.nullif(F.lit(total.w) - F.col("_weights"), F.lit(0))
    # the first source, by ratio, that the level does not lift above its cap fixes the level
    found = below.select("_ratio", level.alias("level")).where(F.col("level") <= F.col("_ratio")).agg(F.min_by("level", "_ratio").alias("level")).first()[0]
    return below.select("source", "source_size", "weight", F.least(F.lit(float(found or 0.0)) * F.col("weight"), F.col("_cap").cast("double")).alias("target"))


def offset(source="source", seed: str = "mix"):
    """One number in [0, 1) per source, the same in every run and engine: 48 bits of an md5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(source, F.lit("\x00null")))), 1, 12), 16, 10).cast("long") / float(1 << 48)


def sample(sized: DataFrame) -> DataFrame:
    """Add source_size, target, copies and taken to (doc_id, source, size, ...)."""
    sizes = common.cut(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sizes")
    goal = common.cut(targets(sizes), "targets")
    ranked = prefix_sums(sized.withColumn("_one", F.lit(1)), ["size", "doc_id"], "_one", "_rank", group=["source"]).drop("_one")
    both = ranked.join(goal.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    each = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    crossed = F.floor(each * (F.col("_rank") + 1) + offset()) - F.floor(each * F.col("_rank") + offset())
    both = both.withColumn("copies", F.least(crossed, F.lit(MAX_REPEAT)).cast("long"))
    return both.withColumn("taken", F.col("copies") * F.col("size")).drop("_rank", "weight")


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) of every row."""
    return sample(docs.select("doc_id", "source", n_words().alias("size"))).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def mixed(docs: DataFrame) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as it was drawn.

    Equal rows are drawn one by one and emitted together.
    """
    key = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    drawn = sample(docs.select("doc_id", "source", n_words().alias("size"), key.alias("_key")))
    drawn = drawn.groupBy("doc_id", "_key").agg(F.sum("copies").alias("_copies")).where(F.col("_copies") > 0).withColumnRenamed("doc_id", "_id")
    rows = docs.withColumn("_row", key)
    rows = rows.join(drawn, (F.col("doc_id").eqNullSafe(F.col("_id"))) & (F.col("_row") == F.col("_key"))).dropDuplicates(["_id", "_key"])
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(*[F.col(f"`{c}`") for c in docs.columns])
