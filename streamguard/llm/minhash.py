"""Near-duplicate documents by b-bit MinHash (operator 10).

1. Every document's set of word shingles is hashed; 128 minima come from as
   many affine maps.  Documents with the same word sequence form one class
   (one row each after a map-side aggregation), so only its smallest id is
   compared further.
2. Bands of four minima give candidate buckets: a pair at similarity 0.8
   misses all 32 bands with probability 5e-8.
3. The low two bits of the minima are kept as a packed signature of four
   longs; equal positions are counted with bit operations and corrected for
   chance collisions.  Pairs below the threshold by more than five standard
   errors end here.
4. The remaining pairs are confirmed on their full shingle sets.  The text of
   a hub is sent once per block of its partners, never once per pair.

Hot buckets: the first round compares each member with the bucket's smallest
document only.  Pairs whose ends are then in one component need no comparison.
Buckets that still hold several components are finished exactly: small ones
by joining their members, with the size and signature tests in the join;
large ones by blocks: each block of documents becomes an index of shingles
in one task, through which the members outside the bucket's main component
stream.  So no link between components is lost, and a bucket of true copies
costs one comparison per member.

Defined results: null or wordless texts have an empty set and link with
nothing; fewer words than ``width`` make one shingle of the whole sequence;
equal rows and equal texts share a component; a null doc_id takes part as
its own row without links.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components
from .wordhash import Texts, U, mix, range_hashes

WIDTH, THRESHOLD_PCT = 5, 80
BANDS, ROWS, BITS = 32, 4, 2
HASHES = BANDS * ROWS
#: Pairs whose estimate lies below the threshold by more than this are dropped before the exact check.
SLACK = 0.21
#: Open buckets up to this size compare by pairs of rows, larger ones by blocks of BLOCK documents.
PAIRED = 32
#: Partners of one hub, or documents of one block, that a task compares at once.
BLOCK = 256
_MULT = mix(np.arange(1, HASHES + 1, dtype=U)) | U(1)
_ADD = mix(np.arange(1001, 1001 + HASHES, dtype=U))


def shingle_sets(texts: Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each text, and the bounds of the texts."""
    words = texts.word_hashes()
    at, h = texts.windows(width, words)
    owner = texts.text[at]
    short = np.flatnonzero((texts.counts > 0) & (texts.counts < width))
    if len(short):
        h = np.concatenate([h, range_hashes(words, texts.first[short], texts.first[short + 1])])
        owner = np.concatenate([owner, short])
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    if len(h):
        keep = np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])])
        h, owner = h[keep], owner[keep]
    return h, np.searchsorted(owner, np.arange(len(texts.counts) + 1))


def minima(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(texts, HASHES) minima; texts without shingles have zeros."""
    full = np.flatnonzero(np.diff(bounds))
    out = np.zeros((len(bounds) - 1, HASHES), U)
    if len(full):
        starts = bounds[full]
        for k in range(HASHES):
            x = h * _MULT[k]
            x += _ADD[k]
            out[full, k] = np.minimum.reduceat(x, starts)
    return out


def pack(m: np.ndarray) -> np.ndarray:
    """Low bits of the (mixed) minima, packed into HASHES * BITS / 64 longs a text."""
    low = mix(m.copy()) & U((1 << BITS) - 1)
    per = 64 // BITS
    shifts = (np.arange(per, dtype=U) * U(BITS))[None, None, :]
    return np.bitwise_or.reduce(low.reshape(len(m), HASHES // per, per) << shifts, axis=2)


def _sketch(width: int):
    def run(table: pa.Table):
        texts = Texts(common.column(table, "text"), lower=True)
        h, bounds = shingle_sets(texts, width)
        m = minima(h, bounds)
        packed = pack(m)
        keys = [mix(np.bitwise_xor.reduce(m[:, b * ROWS:(b + 1) * ROWS] * _MULT[:ROWS], axis=1) + U(b)) for b in range(BANDS)]
        words = texts.word_hashes()
        digest = []
        for i in range(len(texts.counts)):  # 128 bits of the word sequence: equal only for equal sequences
            lo, hi = texts.first[i], texts.first[i + 1]
            digest.append(hashlib.blake2b(words[lo:hi].tobytes(), digest_size=16).digest() if hi > lo else None)
        bands = np.stack(keys, 1).view(np.int64).reshape(-1)
        yield pa.RecordBatch.from_arrays([
            common.column(table, "doc_id"), pa.array(np.diff(bounds)), pa.array(digest, pa.binary()),
            pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * packed.shape[1]), pa.array(packed.view(np.int64).reshape(-1))),
            pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * BANDS), pa.array(bands))], names=["doc_id", "n_shingles", "digest", "sig", "bands"])
    return run


def sketches(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, digest, sig, bands) of every document."""
    return common.map_chunks(common.plain_ids(docs, "doc_id", "text"), _sketch(width), "doc_id long, n_shingles long, digest binary, sig array<long>, bands array<long>")


def estimate(a, b):
    """Similarity from two packed signatures: share of equal positions, corrected for chance collisions."""
    mask = F.lit(int("01" * 32, 2))
    different = F.lit(0)
    for i in range(HASHES * BITS // 64):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        for s in range(1, BITS):
            x = x.bitwiseOR(F.shiftrightunsigned(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))), s))
        different = different + F.bit_count(x.bitwiseAND(mask))
    chance = 2.0 ** -BITS
    return (1 - different / F.lit(float(HASHES)) - chance) / (1 - chance)


def _confirm(pairs: DataFrame, sized: DataFrame, width: int, pct: int, parts: int) -> DataFrame:
    """The pairs (a, b) whose full sets meet the threshold.

    Rows (hub, block, side, text) are dealt by (hub, block) and sorted, so a
    task holds one hub's set and streams its partners.
    """
    pairs = pairs.withColumn("block", F.pmod(F.xxhash64("b"), F.greatest(F.lit(1), F.ceil(F.col("n_b") / BLOCK))).cast("int"))
    hubs = pairs.select("a", "block").distinct()
    left = sized.join(hubs, sized.doc_id == hubs.a).select("a", "block", F.lit(None).cast("long").alias("b"), "z")
    right = sized.join(pairs, sized.doc_id == pairs.b).select("a", "block", "b", "z")
    rows = left.unionByName(right).repartition(parts, "a", "block").sortWithinPartitions("a", "block", F.col("b").asc_nulls_first())

    def compare(batches):
        hub, mine = None, None
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = Texts(pa.array(common.unsqueeze(part.column("z")), pa.binary()).cast(pa.string()), lower=True)
                h, bounds = shingle_sets(texts, width)
                linked_a, linked_b = [], []
                for i, (a, b) in enumerate(zip(part.column("a").to_pylist(), part.column("b").to_pylist(), strict=True)):
                    own = h[bounds[i]:bounds[i + 1]]
                    if b is None:
                        hub, mine = a, own
                        continue
                    assert hub == a
                    small, big = (own, mine) if len(own) < len(mine) else (mine, own)
                    where = np.searchsorted(big, small)
                    both = int(np.count_nonzero(big[np.minimum(where, len(big) - 1)] == small)) if len(big) else 0
                    if both and 100 * both >= pct * (len(own) + len(mine) - both):
                        linked_a.append(a)
                        linked_b.append(b)
                yield pa.RecordBatch.from_arrays([pa.array(linked_a, pa.int64()), pa.array(linked_b, pa.int64())], names=["a", "b"])
    return rows.mapInArrow(common.tidy(compare), "a long, b long")


def near_duplicates(docs: DataFrame, width: int = WIDTH, pct: int = THRESHOLD_PCT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    spark = docs.sparkSession
    parts = common.shards_for(docs)
    sketch = common.cut(sketches(docs, width), "sketches")
    texts_of = sketch.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    same = [F.any_value(c).alias(c) for c in ("n_shingles", "sig", "bands")]  # equal for equal word sequences
    classes = common.cut(texts_of.groupBy("digest").agg(F.min("doc_id").alias("rep"), *same), "classes")
    reps = common.cut(classes.drop("digest").dropDuplicates(["rep"]), "reps")
    band = reps.select(F.col("rep").alias("id"), F.posexplode("bands").alias("band", "key"))
    buckets = band.groupBy("band", "key").agg(F.min("id").alias("hub"), F.count("*").alias("size")).where(F.col("size") > 1)
    members = common.cut(band.join(buckets, ["band", "key"]).select("band", "key", "id", "hub", "size"), "members")
    sigs = reps.select("rep", "n_shingles", "sig")

    def likely(pairs: DataFrame) -> DataFrame:
        """Distinct pairs that size and signature allow, with the number of partners of ``a``."""
        x, y = (sigs.select(F.col("rep").alias(c), F.col("n_shingles").alias(f"s{c}"), F.col("sig").alias(f"g{c}")) for c in "ab")
        sure = pairs.distinct().join(x, "a").join(y, "b").where(100 * F.least("sa", "sb") >= pct * F.greatest("sa", "sb"))
        sure = sure.where(estimate(F.col("ga"), F.col("gb")) >= pct / 100 - SLACK).select("a", "b")
        sure = common.cut(sure, "pairs")
        return sure.join(sure.groupBy("a").agg(F.count("*").alias("n_b")), "a")

    first = likely(members.where(F.col("id") != F.col("hub")).select(F.col("hub").alias("a"), F.col("id").alias("b")))
    links = common.cut(_confirm(first, _texts(docs, _ends(first)), width, pct, parts), "links")
    nodes = components(links)
    # buckets that still hold several components: every pair of different components is compared
    placed = members.where(F.col("size") > 2).join(nodes, members.id == nodes.node, "left").withColumn("component", F.coalesce("component", "id")).drop("node", "hub")
    shares = placed.groupBy("band", "key", "component").agg(F.count("*").alias("n"))
    mixed = shares.groupBy("band", "key").agg(F.count("*").alias("kinds"), F.max_by("component", F.struct("n", "component")).alias("main")).where(F.col("kinds") > 1).drop("kinds")
    open_, left = common.cut_measured(placed.join(mixed, ["band", "key"]).join(sigs, F.col("id") == F.col("rep")).drop("rep"), "open")
    if left["rows"]:
        nodes = _joined(docs, open_, nodes, width, pct, parts)
    whole = sketch.join(classes.select("digest", "rep"), "digest", "left")
    whole = whole.join(nodes, whole.rep == nodes.node, "left")
    component = F.coalesce("component", "rep", "doc_id")
    return whole.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _joined(docs: DataFrame, open_: DataFrame, nodes: DataFrame, width: int, pct: int, parts: int) -> DataFrame:
    """(node, component) after the comparisons between the components that share an open bucket."""
    small = open_.where(F.col("size") <= PAIRED)
    x, y = (small.select("band", "key", F.col("id").alias(c), F.col("component").alias(f"c{c}"), F.col("n_shingles").alias(f"s{c}"), F.col("sig").alias(f"g{c}")) for c in "ab")
    near = (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & (100 * F.least("sa", "sb") >= pct * F.greatest("sa", "sb")) & (estimate(F.col("ga"), F.col("gb")) >= pct / 100 - SLACK)
    second = common.cut(x.join(y, ["band", "key"]).where(near).select("a", "b").distinct(), "pairs")
    second = second.join(second.groupBy("a").agg(F.count("*").alias("n_b")), "a")
    large = open_.where(F.col("size") > PAIRED)
    wanted = _ends(second).unionByName(large.select(F.col("id").alias("doc_id"))).distinct()
    texts = _texts(docs, wanted)
    more = _confirm(second, texts, width, pct, parts).unionByName(_confirm_blocks(large, texts, width, pct, parts))
    more, found = common.cut_measured(more, "links")
    if not found["rows"]:
        return nodes
    placed = nodes.where(F.col("node") != F.col("component")).select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(placed.unionByName(more))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, z) of the wanted documents; a bounded Bloom filter keeps the others out of the shuffle."""
    from .bloom import might_contain
    wanted = common.cut(wanted, "wanted")
    with might_contain(common.plain_ids(docs, "doc_id", "text"), "doc_id", wanted) as rows:
        return common.cut(common.squeeze(rows).join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")


def _confirm_blocks(large: DataFrame, texts: DataFrame, width: int, pct: int, parts: int) -> DataFrame:
    """Links between different components of large buckets.

    Every member lies in one block of its bucket; members outside the main
    component visit all blocks.  A pair of different components has such a
    member, so it meets in some block.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = large.join(texts, large.id == texts.doc_id).select("band", "key", "id", "component", "main", "sig", "z", blocks.alias("blocks"))
    kept = rows.select("band", "key", F.pmod(F.xxhash64("id", "band"), F.col("blocks")).cast("int").alias("block"), F.lit(0).alias("side"), "id", "component", "sig", "z")
    visit = rows.where(F.col("component") != F.col("main")).select("band", "key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("side"), "id", "component", "sig", "z")
    dealt = kept.unionByName(visit).repartition(parts, "band", "key", "block").sortWithinPartitions("band", "key", "block", "side", "id")
    ones = U(int("01" * 32, 2))

    def compare(batches):
        at, held, index = None, [], None
        for batch in batches:
            sets = Texts(pa.array(common.unsqueeze(batch.column("z")), pa.binary()).cast(pa.string()), lower=True)
            h, bounds = shingle_sets(sets, width)
            sig = batch.column("sig").flatten().to_numpy().view(U).reshape(batch.num_rows, -1)
            linked = []
            places = zip(*(batch.column(c).to_pylist() for c in ("band", "key", "block", "side", "id", "component")), strict=True)
            for i, (band, key, block, side, doc, component) in enumerate(places):
                if (band, key, block) != at:
                    at, held, index = (band, key, block), [], None
                own = h[bounds[i]:bounds[i + 1]]
                if side == 0:
                    held.append((doc, component, own, sig[i]))
                    continue
                if index is None:
                    sizes = np.array([len(x[2]) for x in held], np.int64)
                    every = np.concatenate([x[2] for x in held]) if held else np.zeros(0, U)
                    order = np.argsort(every)
                    index = every[order], np.repeat(np.arange(len(held)), sizes)[order], sizes, np.array([x[0] for x in held]), np.array([x[1] for x in held]), np.array([x[3] for x in held])
                keys, owner, sizes, ids, comps, sigs = index
                if not len(ids):
                    continue
                different = sum(np.bitwise_count(((x := sigs[:, j] ^ sig[i, j]) | x >> U(1)) & ones).astype(np.int64) for j in range(sig.shape[1]))
                chance = 2.0 ** -BITS
                may = (comps != component) & ((1 - different / HASHES - chance) / (1 - chance) >= pct / 100 - SLACK)
                if not may.any():
                    continue
                lo, hi = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
                n = hi - lo
                hits = owner[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                both = np.bincount(hits, minlength=len(ids))
                good = np.flatnonzero(may & (100 * both >= pct * (sizes + len(own) - both)) & (both > 0))
                _, once = np.unique(comps[good], return_index=True)  # one link to each component is enough
                linked.extend((int(min(doc, ids[g])), int(max(doc, ids[g]))) for g in good[once].tolist())
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in linked], pa.int64()) for k in (0, 1)], names=["a", "b"])
    return dealt.mapInArrow(common.tidy(compare), "a long, b long")
