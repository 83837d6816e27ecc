"""Removal of repeated token windows (operator 4).

Every window of ``width`` consecutive words gets a Rabin-Karp hash.  A task
sends, per chunk of documents and shard of the hash space, one packed block:
the sorted hashes as byte planes of their differences, and where each window
lies.  Within a chunk only the smallest document that holds a hash sends it;
the chunk's other documents already know that they lose it, so a passage that
a third of all documents share costs one entry a chunk, not one a document.
Each shard finds every hash's smallest document and returns the windows that
lose, merged into intervals and packed by document; these are gathered,
merged into maximal intervals, and joined with the texts of the documents that lose anything
(a bounded Bloom filter keeps the others out of that shuffle).

Defined results: null texts have no words; texts shorter than a window lose
nothing; a document never loses a window to itself or to a row with its own
doc_id; rows with a null doc_id lose nothing and take nothing; texts under one doc_id are told apart
by a 32-bit tag.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .wordhash import Texts, U, joined, mix

WIDTH = 13
#: Text bytes of a chunk: larger ones send shared passages and document names less often, and hold more.
CHUNK_BYTES = 1 << 20


def _planes(sorted_values: np.ndarray) -> bytes:
    """Sorted uint64 values as byte planes of their differences, zstd-compressed."""
    import zstandard
    step = np.diff(sorted_values, prepend=U(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8).T).tobytes())


def _unplanes(data: bytes) -> np.ndarray:
    import zstandard
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(raw.T).view(U).reshape(-1), dtype=U)


def _runs(at: np.ndarray, group: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that start at ``at`` (sorted within sorted ``group``) merged into (group, start, end) intervals."""
    new = np.concatenate([[True], (group[1:] != group[:-1]) | (at[1:] > at[:-1] + width)]) if len(at) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return group[first], at[first], at[last] + width if len(at) else at


_BLOCK = "shard int, hashes binary, places binary, docs binary"
#: What a block says of each of its documents: first word in the chunk, id, and a tag of the text.
_SPAN = np.dtype([("id", "<i8"), ("tag", "<u4"), ("lo", "<u4"), ("hi", "<u4")])
_DOC = np.dtype([("start", "<u4"), ("tag", "<u4"), ("id", "<i8")])


def _emit(table: pa.Table, width: int, shards: int):
    """Packed blocks of a chunk's windows by shard, and intervals already lost within the chunk.

    ``places`` are word numbers in the chunk; ``ids`` and ``starts`` are the
    chunk's documents and their first words.  A block without hashes carries
    intervals: places are then (document, start, end) triples.
    """
    import zstandard
    pack = zstandard.ZstdCompressor(level=1).compress
    table = table.filter(pa.compute.is_valid(table.column("doc_id")))
    # documents by id, so that a smaller number within the chunk is a smaller id; rows of one id stay neighbours
    table = table.sort_by("doc_id")
    texts = Texts(common.column(table, "text"))
    ids = table.column("doc_id").to_numpy()
    at, h = texts.windows(width)
    if not len(at):
        return
    rank = np.concatenate([[0], np.cumsum(ids[1:] != ids[:-1])])  # equal ids share a rank
    owner = rank[texts.text[at]]
    order = np.lexsort((at, h))
    at, h, owner = at[order], h[order], owner[order]
    new = np.concatenate([[True], h[1:] != h[:-1]])
    least = owner[np.flatnonzero(new)][np.cumsum(new) - 1]  # at is ascending within a hash, and so is owner
    lost = owner != least
    lost_at = np.sort(at[lost])
    text, lo, hi = _runs(lost_at, texts.text[lost_at], width)
    at, h = at[~lost], h[~lost]
    docs = np.zeros(len(ids), _DOC)
    docs["start"], docs["id"], docs["tag"] = texts.first[:-1], ids, _tags(texts)
    edge = np.searchsorted(h, (np.arange(1, shards, dtype=object) * (1 << 64) // shards).astype(U)) if shards > 1 else np.zeros(0, np.int64)
    edge = np.concatenate([[0], edge, [len(h)]])
    out = []
    for s, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)):
        if b > a:
            used = np.zeros(len(ids), bool)
            used[texts.text[at[a:b]]] = True
            places = np.ascontiguousarray(at[a:b].astype("<u4").view(np.uint8).reshape(-1, 4).T)
            out.append((s, _planes(h[a:b]), pack(places.tobytes()), pack(docs[used].tobytes())))
    if len(lo):
        spans = np.stack([ids[text], docs["tag"][text], lo - texts.first[text], hi - texts.first[text]], 1).astype("<i8")
        out.append((int(ids[0] % shards), None, pack(spans.tobytes()), None))
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), *(pa.array([r[k] for r in out], pa.binary()) for k in range(1, 4))], names=["shard", "hashes", "places", "docs"])


def _tags(texts: Texts) -> np.ndarray:
    """32 bits of each text's hash: tells apart different texts under one doc_id."""
    return (texts.byte_hashes(texts.bounds[:-1], texts.bounds[1:]) >> U(32)).astype(np.uint32)


def _judge(batches, width: int, shards: int):
    """One shard: each hash's smallest document keeps it; the others' windows become intervals.

    Intervals leave packed by a hash of their document, one row per target.
    """
    import zstandard
    unpack = zstandard.ZstdDecompressor().decompress
    all_h, all_doc, all_at = [], [], []
    for batch in batches:
        for row in batch.to_pylist():
            if row["hashes"] is None:
                yield from _dealt(*np.frombuffer(unpack(row["places"]), "<i8").reshape(-1, 4).T, shards)
                continue
            places = np.ascontiguousarray(np.frombuffer(unpack(row["places"]), np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)
            docs = np.frombuffer(unpack(row["docs"]), _DOC)
            doc = docs[np.searchsorted(docs["start"], places, side="right") - 1]
            all_h.append(_unplanes(row["hashes"]))
            all_doc.append(doc[["id", "tag"]])
            all_at.append(places - doc["start"])
    if not all_h:
        return
    h, docs, at = np.concatenate(all_h), np.concatenate(all_doc), np.concatenate(all_at)
    del all_h, all_doc, all_at
    order = np.argsort(h, kind="stable")
    h = h[order]
    same = np.concatenate([[False], h[1:] == h[:-1]])
    shared = same | np.concatenate([same[1:], [False]])  # most windows are alone
    order, h = order[shared], h[shared]
    ids, tags, at = docs["id"][order], docs["tag"][order], at[order]
    if len(h):
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        least = np.repeat(np.minimum.reduceat(ids, first), np.diff(np.append(first, len(h))))
        lost = ids != least
        ids, tags, at = ids[lost], tags[lost].astype(np.int64), at[lost].astype(np.int64)
        order = np.lexsort((at, tags, ids))
        if len(order):
            ids, tags, at = ids[order], tags[order], at[order]
            new = np.concatenate([[True], (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])])
            text, lo, hi = _runs(at, np.cumsum(new) - 1, width)
            yield from _dealt(ids[new][text], tags[new][text], lo, hi, shards)


def _dealt(ids, tags, lo, hi, shards: int):
    import zstandard
    pack = zstandard.ZstdCompressor(level=1).compress
    rows = np.zeros(len(ids), _SPAN)
    rows["id"], rows["tag"], rows["lo"], rows["hi"] = ids, tags, lo, hi
    target = (mix(rows["id"].view(U).copy()) % U(shards)).astype(np.int32)
    order = np.argsort(target, kind="stable")
    rows, target = rows[order], target[order]
    edge = np.append(np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]])), len(rows))
    yield pa.RecordBatch.from_arrays([pa.array(target[edge[:-1]]), pa.array([pack(rows[x:y].tobytes()) for x, y in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)], pa.binary())], names=["target", "packed"])


def _gather(batches):
    """All intervals of a target's texts, merged: one row per text."""
    import zstandard
    unpack = zstandard.ZstdDecompressor().decompress
    parts = [np.frombuffer(unpack(x), _SPAN) for b in batches for x in b.column("packed").to_pylist()]
    if not parts:
        return
    rows = np.unique(np.concatenate(parts))  # sorted by id, tag, start, end
    del parts
    text = np.cumsum(np.concatenate([[False], (rows["id"][1:] != rows["id"][:-1]) | (rows["tag"][1:] != rows["tag"][:-1])]))
    # the furthest end so far within the text, by lifting every text above the one before
    lift = text.astype(np.int64) << 32
    reach = np.maximum.accumulate(rows["hi"] + lift)
    new = np.concatenate([[True], rows["lo"][1:] + lift[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(rows)) - 1
    merged = rows[first]
    merged["hi"] = reach[last] - lift[last]
    owner = text[first]
    edge = np.append(np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])), len(merged))
    for k in range(0, len(edge) - 1, 10_000):
        part = edge[k:k + 10_001]
        yield _intervals(*(merged[c][part[0]:part[-1]] for c in ("id", "tag", "lo", "hi")))


def _intervals(ids, tags, lo, hi) -> pa.RecordBatch:
    """(doc_id, tag, spans): a text's intervals as one list of start, end, start, end ..."""
    ids, tags, lo, hi = (np.ascontiguousarray(x, np.int64) for x in (ids, tags, lo, hi))
    order = np.lexsort((lo, tags, ids))
    ids, tags, lo, hi = ids[order], tags[order], lo[order], hi[order]
    first = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])])) if len(ids) else np.zeros(0, np.int64)
    spans = pa.ListArray.from_arrays(pa.array((np.append(first, len(ids)) * 2).astype(np.int32)), pa.array(np.stack([lo, hi], 1).reshape(-1)))
    return pa.RecordBatch.from_arrays([pa.array(ids[first]), pa.array(tags[first]), spans], names=["doc_id", "tag", "spans"])


def repeated_spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, tag, spans): the maximal word intervals that each text loses, as start, end, start, end ..."""
    shards = common.shards_for(docs)
    blocks = common.map_chunks(common.plain_ids(docs, "doc_id", "text"), lambda t: _emit(t, width, shards), _BLOCK, limit=CHUNK_BYTES)
    dealt = blocks.repartitionById(shards, F.col("shard")).mapInArrow(common.tidy(lambda b: _judge(b, width, shards)), "target int, packed binary")
    return dealt.repartitionById(shards, F.col("target")).mapInArrow(common.tidy(_gather), "doc_id long, tag long, spans array<long>")


def _tagged(batches):
    """(doc_id, tag, z, n_words, sha) of every row; z is the text as ``squeeze`` packs it."""
    import zstandard
    pack = zstandard.ZstdCompressor(level=1).compress
    for table in common.by_chunk(batches, "text"):
        texts = Texts(common.column(table, "text"))
        body = texts.data.tobytes()
        z = [pack(body[a:b]) for a, b in zip(texts.bounds[:-1].tolist(), texts.bounds[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([common.column(table, "doc_id"), pa.array(_tags(texts).astype(np.int64)), pa.array(z, pa.binary())], names=["doc_id", "tag", "z"])


def _strip(batches):
    """Kept words of every text; spans may overlap and come in any order."""
    for table in common.by_chunk(batches, "z"):
        texts = Texts(pa.array(common.unsqueeze(common.column(table, "z")), pa.binary()).cast(pa.string()))
        steps = np.zeros(len(texts.start) + 1, np.int64)
        for first, last, spans in zip(texts.first[:-1].tolist(), texts.first[1:].tolist(), table.column("spans").to_pylist(), strict=True):
            flat = np.minimum(np.array(spans) + first, last)
            np.add.at(steps, flat[0::2], 1)
            np.add.at(steps, flat[1::2], -1)
        keep = np.cumsum(steps[:-1]) == 0
        body, at = joined(texts, keep)
        kept = [body[a:b].decode() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([common.column(table, "doc_id"), common.column(table, "tag"), pa.array(texts.per_text(~keep, texts.first)), pa.array(kept, pa.string())], names=["doc_id", "tag", "n_removed", "kept_text"])


def deduplicate(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, tag, n_removed, kept_text), one row for each text that loses words; ``tag`` is ``text_tags``'."""
    from .bloom import might_contain
    spans = common.cut(repeated_spans(docs, width), "spans")
    named = common.plain_ids(docs, "doc_id", "text").where(F.col("doc_id").isNotNull())
    with might_contain(named, "doc_id", spans.select("doc_id")) as rows:
        texts = rows.mapInArrow(common.tidy(_tagged), "doc_id long, tag long, z binary").join(spans, ["doc_id", "tag"])
        out = common.cut(texts.mapInArrow(common.tidy(_strip), "doc_id long, tag long, n_removed long, kept_text string"), "stripped")
    return out.dropDuplicates(["doc_id", "tag"])


def _whole(table: pa.Table):
    """(doc_id, tag, n_words, sha) of every text as if nothing were lost."""
    texts = Texts(common.column(table, "text"))
    body, at = joined(texts, np.ones(len(texts.start), bool))
    sha = [hashlib.sha256(body[a:b]).hexdigest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    yield pa.RecordBatch.from_arrays([common.column(table, "doc_id"), pa.array(_tags(texts).astype(np.int64)), pa.array(texts.counts), pa.array(sha)], names=["doc_id", "tag", "n_words", "sha"])


def digests(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row of ``docs``."""
    lost = deduplicate(docs, width).select("doc_id", "tag", "n_removed", F.sha2("kept_text", 256).alias("lost_sha"))
    whole = common.map_chunks(common.plain_ids(docs, "doc_id", "text"), _whole, "doc_id long, tag long, n_words long, sha string")
    return whole.join(lost, ["doc_id", "tag"], "left").select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("lost_sha", "sha").alias("kept_sha256"))


def stripped(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with the repeated windows taken out of their texts; texts that lose nothing stay as they are.

    Only documents that lose words and still have some come from the operator
    rewritten; a document that loses every word goes.
    """
    lost = deduplicate(docs, width)
    tag = common.map_chunks(docs, _with_tag(docs), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", _tag long")
    out = tag.join(lost.select(F.col("doc_id").alias("_id"), F.col("tag").alias("_lost"), "kept_text"), (F.col("doc_id") == F.col("_id")) & (F.col("_tag") == F.col("_lost")), "left")
    out = out.where(F.col("kept_text").isNull() | (F.col("kept_text") != ""))
    text = F.coalesce("kept_text", "text")
    return out.select(*[(text if c == "text" else F.when(F.col("kept_text").isNotNull(), F.length("kept_text").cast("long")).otherwise(F.col("n_chars")) if c == "n_chars" else F.col(f"`{c}`")).alias(c) for c in docs.columns])


def _with_tag(docs: DataFrame):
    names = docs.columns

    def run(table: pa.Table):
        tags = _tags(Texts(common.column(table, "text")))
        yield pa.RecordBatch.from_arrays([common.column(table, c) for c in names] + [pa.array(tags.astype(np.int64))], names=[*names, "_tag"])
    return run
