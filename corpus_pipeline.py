"""Documents to packed training sequences in five stages.

Each stage is ``fn(spark, docs, sf_dir) -> DataFrame``; ``run`` writes every
stage's result as Parquet into the session's shared folder and hands the next
stage what it reads back.  All but the last return the columns of
``documents``, further ones under any name included.  The language model has
no SQL form, so ``ORACLE_SQL`` is None; the tests compare near-dedup with a
brute-force version and run all stages over odd rows.

Nulls and repeated rows: quality judges rows one by one; near-dedup takes rows,
not ids, as documents: of near-duplicates the row with the smallest doc_id stays
(one without an id only if no other has one), of equal rows one, and different
texts under one id both stay; the later stages treat rows one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamguard.llm import common, minhash, mixing, packing, perplexity, substring
from streamguard.llm.queries import table, tokenizer

TOKENIZER = "byte_bpe_50k.json"
DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def extras_aside(stage):
    """The stage with columns beyond those of ``documents`` under neutral names, given back under their own."""
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c: f"extra_column_{i}" for i, c in enumerate(docs.columns) if c not in DOCUMENTS}
        out = stage(spark, docs.withColumnsRenamed(names), sf_dir)
        return out.withColumnsRenamed({v: k for k, v in names.items()})
    run.__name__, run.__doc__ = stage.__name__, stage.__doc__
    return run


def row_key(docs: DataFrame):
    """64 bits of all columns: equal for equal rows."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])


@extras_aside
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie within their language's perplexity band."""
    common.bounded_batches(spark)
    keyed = docs.withColumn("_row", row_key(docs))
    verdict = perplexity.quality(keyed.select(F.col("_row").alias("doc_id"), "text", "lang"))
    kept = verdict.where("kept").select(F.col("doc_id").alias("_row")).distinct()
    return keyed.join(kept, "_row", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


@extras_aside
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component (five-word shingles, similarity 0.8)."""
    common.bounded_batches(spark)
    keyed = docs.withColumn("_row", row_key(docs))
    found = minhash.near_duplicates(keyed.select(F.col("_row").alias("doc_id"), "text")).select(F.col("doc_id").alias("_row"), "component_id").distinct()
    first = F.min_by("_row", F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row")))
    best = keyed.select("_row", "doc_id").join(found, "_row").groupBy("component_id").agg(first.alias("_row")).select("_row")
    return keyed.join(best, "_row", "left_semi").dropDuplicates(["_row"]).select(*[F.col(f"`{c}`") for c in docs.columns])


@extras_aside
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Word windows that also start in a document with a smaller id are taken out; emptied documents go."""
    common.bounded_batches(spark)
    return substring.stripped(docs)


@extras_aside
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn towards their sources' target weights, repeats as repeated rows."""
    common.bounded_batches(spark)
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences of 1024."""
    common.bounded_batches(spark)
    return packing.pack(packing.pieces(docs, tokenizer(TOKENIZER)))


STAGES = [
    ("quality", quality_rules),
    ("near_dedup", near_dedup),
    ("substring", substring_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.cut(stage(spark, docs, sf_dir), name)
    return docs
