"""Ranked lexical search with bag deduplication (operator 13).

A document's score for an item depends only on its length norm m and on how
often it holds the item's terms.  So all documents are restricted to the
items' vocabulary: what is left of one is a bag, the term numbers with their
counts.  Documents with the same bag and m are one class (dealt by a hash and
compared in full); a class is scored once for every item, and its members
take the score, in ascending doc_id order.

1. The items' distinct terms are found; items are dealt into blocks of at most
   ``BLOCK_PAIRS`` (item, term) pairs (usually one block; an item is never
   split), and a block's vocabulary is broadcast as sorted hashes.
2. One pass over the whole texts counts each document's terms and its bag, and
   each task's document frequencies of the vocabulary.
3. Bags become classes.  At most ``TOP`` smallest ids of a class can be among
   an item's ``TOP`` best documents, so Spark cuts each task's part of a class
   to them before the shuffle: a hot class is ``TOP`` rows a task.
4. Each task scores its classes for all items of the block, in a dense table of
   (vocabulary, classes) for a few hundred classes at a time, whole numbers
   throughout, and keeps every item's best documents; the best of all tasks
   are merged.  A document among an item's best belongs to one of the item's
   ``TOP`` best classes by (score, smallest id), so nothing is lost.

Defined results: null texts have no terms and are not counted in N; an item
without terms, or whose documents all score 0, has no rows; items that occur
twice are answered twice; rows that share a doc_id are documents of their
own; those without one rank behind equal scores with one; empty tables give
an empty result.  Terms are told apart by 64-bit hash and length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .wordhash import Sorted, Texts, U, mix

TOP = 50
#: Length normalisation in hundredths, and the saturation term times 10.
LENGTH_PCT, SATURATION = 50, 20
#: Distinct (item, term) pairs of a block of items: 16 bytes each where they are broadcast.
BLOCK_PAIRS = 500_000
#: Numbers of a dense (vocabulary, classes) table, and classes at once.
DENSE, CLASSES = 1 << 21, 1024
#: Stands for a missing doc_id.
NO_ID = (1 << 63) - 1

_TERM = np.zeros(256, bool)
_TERM[0x30:0x3A] = _TERM[0x41:0x5B] = _TERM[0x61:0x7B] = _TERM[0x80:] = True


class Terms(Texts):
    """Texts whose words are runs of ASCII letters, digits and everything beyond ASCII, A-Z lower-cased."""

    def __init__(self, texts: pa.Array):
        super().__init__(texts, lower=True)

    def _words(self) -> None:
        self.data = np.where(_TERM[self.data], self.data, np.uint8(0x20))
        super()._words()


def item_terms(items: DataFrame) -> DataFrame:
    """(item, hash, length): the distinct terms of every item row."""
    def run(table: pa.Table):
        terms = Terms(common.column(table, "text"))
        item = common.column(table, "item").to_numpy()[terms.text]
        h, n = terms.word_hashes(), terms.end - terms.start
        _, first = np.unique(np.stack([item.astype(U), h]), axis=1, return_index=True) if len(h) else (None, np.zeros(0, int))
        yield pa.RecordBatch.from_arrays([pa.array(item[first]), pa.array(h[first].view(np.int64)), pa.array(n[first].astype(np.int32))], names=["item", "hash", "length"])
    return common.map_chunks(items.select("item", "text"), run, "item long, hash long, length int")


class Vocabulary:
    """A block's distinct terms, numbered in the order of their hashes, and the terms of its items."""

    def __init__(self, item: np.ndarray, h: np.ndarray, length: np.ndarray):
        self.keys, first, number = np.unique(h.view(U), return_index=True, return_inverse=True)
        self.length = length[first]
        order = np.argsort(item, kind="stable")
        self.terms = number[order].astype(np.int32)
        self.items, start = np.unique(item[order], return_index=True)
        self.start = np.append(start, len(item))

    def __len__(self) -> int:
        return len(self.keys)


def bags(docs: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, n, hash, bag) of every row with a term, and rows (ids, counts): documents that hold a term, by task.

    A bag is the sorted term numbers, then their counts, as unsigned 32-bit
    numbers; it is null for a document without any term of the vocabulary.
    """
    def run(batches):
        known: Vocabulary = vocabulary.value
        index = Sorted(known.keys)
        seen = np.zeros(len(known), np.int64)
        for table in common.by_chunk(batches, "text"):
            terms = Terms(common.column(table, "text"))
            at, hit = index.find(terms.word_hashes())
            hit = np.flatnonzero(hit)
            at = at[hit]
            right = known.length[at] == (terms.end - terms.start)[hit]
            key, count = np.unique(terms.text[hit][right] * len(known) + at[right], return_counts=True)
            text, number = key // max(1, len(known)), (key % max(1, len(known))).astype(np.uint32)
            seen += np.bincount(number, minlength=len(known))
            edge = np.searchsorted(text, np.arange(len(terms.counts) + 1))
            with_terms = np.flatnonzero(terms.counts)
            raw = []
            for a, b in zip(edge[with_terms].tolist(), edge[with_terms + 1].tolist(), strict=True):
                raw.append(number[a:b].tobytes() + count[a:b].astype(np.uint32).tobytes() if b > a else None)
            parts = mix(number.astype(U) << U(32) | count.astype(U))
            total = np.zeros(len(parts) + 1, U)
            np.cumsum(parts, dtype=U, out=total[1:])
            h = (total[edge[1:]] - total[edge[:-1]])[with_terms].view(np.int64)
            ids = common.column(table, "doc_id").take(pa.array(with_terms))
            nothing = pa.nulls(len(with_terms))
            yield pa.RecordBatch.from_arrays([ids, pa.array(terms.counts[with_terms]), pa.array(h), pa.array(raw, pa.binary()), nothing.cast(pa.list_(pa.int32())), nothing.cast(pa.list_(pa.int64()))], names=names)
        there = np.flatnonzero(seen)
        if len(there):
            one = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*one, pa.array([there.astype(np.int32)], pa.list_(pa.int32())), pa.array([seen[there]], pa.list_(pa.int64()))], names=names)
    names = ["doc_id", "n", "hash", "bag", "ids", "counts"]
    return common.plain_ids(docs, "doc_id", "text").mapInArrow(common.tidy(run), "doc_id long, n long, hash long, bag binary, ids array<int>, counts array<long>")


def classes(found: DataFrame, n: int, total: int, top: int = TOP) -> DataFrame:
    """(m, bag, members): equal bags of equal m with their ``top`` smallest ids, ascending."""
    rows = found.where(F.col("bag").isNotNull()).select(
        "hash", (F.lit(100 - LENGTH_PCT) + F.expr(f"({LENGTH_PCT} * n * {n}L) div {max(1, total)}L")).cast("long").alias("m"), "bag", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"))
    order = Window.partitionBy("hash", "m", "bag").orderBy("id")
    least = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
    return least.groupBy("hash", "m", "bag").agg(F.sort_array(F.collect_list("id")).alias("members")).drop("hash")


def _dense(bag: list[bytes], m: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """(vocabulary, classes): what each term adds to the score of each class."""
    size = np.array([len(b) // 8 for b in bag])
    flat = np.frombuffer(b"".join(bag), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(bag)), size)
    at = np.arange(size.sum()) + np.repeat(np.cumsum(size) - size, size)  # a bag is twice its size long
    number, tf = flat[at], flat[at + size[row]]
    out = np.zeros((len(weight), len(bag)), np.int64)
    out[number, row] = weight[number] * (1_000_000_000 * tf // (1000 * tf + SATURATION * m[row]))
    return out


def score(found: DataFrame, vocabulary, weights, top: int = TOP) -> DataFrame:
    """(item, doc_id, score): every task's best documents of every item of the block."""
    def run(batches):
        known, weight = vocabulary.value, weights.value
        spans = list(zip(known.start[:-1].tolist(), known.start[1:].tolist(), strict=True))
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in spans]  # (scores, ids) of documents
        chunk = max(8, min(CLASSES, DENSE // max(1, len(known))))
        for batch in batches:
            for lo in range(0, batch.num_rows, chunk):
                part = batch.slice(lo, chunk)
                table = _dense(part.column("bag").to_pylist(), part.column("m").to_numpy(), weight)
                members = part.column("members")
                edge = members.offsets.to_numpy().astype(np.int64)
                ids = members.values.to_numpy()
                first = ids[edge[:-1]]
                for i, (a, b) in enumerate(spans):
                    got = table[known.terms[a:b]].sum(axis=0)
                    old, old_ids = best[i]
                    least = max(1, int(old[-1])) if len(old) == top else 1
                    pick = np.flatnonzero(got >= least)
                    if not len(pick):
                        continue
                    if len(pick) > top:
                        pick = pick[np.lexsort((first[pick], -got[pick]))[:top]]
                    many = edge[pick + 1] - edge[pick]
                    new = np.repeat(edge[pick] - (np.cumsum(many) - many), many) + np.arange(many.sum())
                    s, d = np.concatenate([old, np.repeat(got[pick], many)]), np.concatenate([old_ids, ids[new]])
                    order = np.lexsort((d, -s))[:top]
                    best[i] = s[order], d[order]
        for item, (s, d) in zip(known.items.tolist(), best, strict=True):
            if len(s):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), item)), pa.array(d), pa.array(s)], names=["item", "doc_id", "score"])
    return found.select("m", "bag", "members").mapInArrow(common.tidy(run), "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): every item's ``top`` best documents."""
    spark = docs.sparkSession
    asked = common.cut(items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), "items")
    pairs = common.cut(item_terms(asked), "terms")
    blocks = max(1, -(-pairs.count() // BLOCK_PAIRS))
    answers = []
    for k in range(blocks):
        mine = pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).toArrow()  # bounded by BLOCK_PAIRS
        if not mine.num_rows:
            continue
        known = Vocabulary(*(mine.column(c).to_numpy() for c in ("item", "hash", "length")))
        vocabulary = spark.sparkContext.broadcast(known)
        found = common.cut(bags(docs, vocabulary), "bags")
        total = found.agg(F.count("n").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
        counts = found.where(F.col("ids").isNotNull()).select(F.explode(F.arrays_zip("ids", "counts")).alias("x")).groupBy("x.ids").agg(F.sum("x.counts").alias("df"))
        df = np.zeros(len(known), np.int64)
        seen = counts.toArrow()  # a row per term of the block at most
        df[seen.column("ids").to_numpy()] = seen.column("df").to_numpy()
        weights = spark.sparkContext.broadcast(np.floor(1000 * np.log((2 * total.n + 2) / (2 * df + 1))).astype(np.int64))
        answers.append(common.cut(score(classes(found, total.n, total.l, top), vocabulary, weights, top), "scores"))
        vocabulary.destroy()
        weights.destroy()
        common.remove(found)
    if not answers:
        return asked.where("false").select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    every = answers[0]
    for more in answers[1:]:
        every = every.unionByName(more)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), "doc_id")
    best = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(asked.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "score")
