"""Quality rules with an n-gram language model (operator 2).

A modified Kneser-Ney model over characters (order 5, white space as one
blank per character, four start marks) is trained per language on every
document that passes the base rules and has at most one symbol of the
contract's set in ten words, so junk does not teach the model its own style.  Spark counts the n-grams (each task sends its own
distinct ones), and joins on contexts and suffixes give every order's
interpolated probabilities and back-off weights.  The model is stored as
shards of sorted hash arrays.  Each document's perplexity under its own
language's model is held against that language's lower and upper band, the
median log perplexity minus / plus a number of robust deviations: far below
lies text that repeats itself, far above lies noise.  The mean of n
characters scatters with 1 / sqrt(n), so the deviation widens for texts
shorter than ``REFERENCE_CHARS``.

The arrays are broadcast only when their measured size is within
``broadcast_bytes``; a larger model is joined with the n-grams of each chunk
of documents instead (``_score_by_join``), with the same results.

Defined results: a null text has no words; a text without words has no
perplexity (null) and fails the base rules; a null ``lang`` is a language of
its own; a language without training documents has the uniform model over all
code points, so only the base rules decide; repeated rows are scored each; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .wordhash import Sorted, Texts, U, covered, mix, repeated

ORDER = 5
START = "\x02"
#: Fixed by the contract.
WINDOW, MIN_WORDS, MAX_REPEAT_PCT = 8, 20, 30
SYMBOLS = "#*$%&|<>"
#: Robust deviations from the language's median log perplexity.
LOWER, UPPER = 10.0, 10.0
REFERENCE_CHARS = 2000
#: A training document has at most this many symbols per word.
MAX_SYMBOLS_PER_WORD = 0.1
#: A language's deviation is never taken below this (natural log).
LEAST_SPREAD = 0.02
#: Grid of log perplexity on which medians are taken exactly.
GRID = 2000.0
BROADCAST_BYTES = 96 << 20
#: Code points of Unicode: the alphabet of a language without training documents.
CODE_POINTS = 0x110000

_STEP = U(0x100000001B3)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_NO_LANG = "\x03none"


# --- counting -------------------------------------------------------------------------------------

def _lang_seeds(langs: list[str]) -> np.ndarray:
    import hashlib
    known = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(langs)}
    return np.array([known[x] for x in langs], U)


def _padded(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points with start marks before every text; where each real character lies; characters per text."""
    lead = (texts.data & 0xC0) != 0x80
    counts = texts.per_text(lead)
    blank = np.where(texts.separator, np.uint8(32), texts.data)
    points = np.frombuffer(blank.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(points)) + (ORDER - 1) * (text + 1)
    out = np.full(len(points) + (ORDER - 1) * len(counts), ord(START), np.uint32)
    out[at] = points
    return out, at, counts


def _hashes(points: np.ndarray, at: np.ndarray, seeds: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Hash of the ``order`` code points that end at each position; ``seeds`` tell languages apart."""
    wide = points.astype(U)
    h = np.zeros(len(wide), U)
    for j in range(order):
        back = order - 1 - j
        h *= _STEP
        h[back:] += wide[:len(wide) - back] if back else wide
    return mix(h[at] ^ seeds ^ U(order))


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = np.sort(h)
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
    return s[first], np.diff(np.append(first, len(s)))


#: Distinct n-grams that a counting task holds before it sends them on.
HELD = 400_000
#: Text bytes of a chunk: every character takes some ten 8-byte numbers while it is counted or scored.
CHUNK_BYTES = 256 << 10


def _merge(parts: list[tuple]) -> tuple:
    """(keys, counts, code points, languages) of several chunks as one, each key once."""
    keys, n, grams, langs = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n[order], first), grams[order[first]], langs[order[first]]


def _count_partition(batches, everything: bool = False):
    """Distinct n-grams of a task's training documents (or of all) with their counts, merged over its chunks."""
    parts: list[tuple] = []
    names: dict[str, int] = {}

    def flush():
        _, n, grams, langs = parts[0]
        known = list(names)
        for lo in range(0, len(n), 20_000):
            whole = grams[lo:lo + 20_000].astype("<u4").tobytes().decode("utf-32-le")
            rows = [whole[i:i + ORDER] for i in range(0, len(whole), ORDER)]
            yield pa.RecordBatch.from_arrays([pa.array([known[x] for x in langs[lo:lo + 20_000].tolist()]), pa.array(rows), pa.array(n[lo:lo + 20_000])], names=["lang", "gram", "n"])

    for table in common.by_chunk(batches, "text", CHUNK_BYTES):
        texts = Texts(common.column(table, "text"))
        langs = [x if x is not None else _NO_LANG for x in table.column("lang").to_pylist()]
        got = features(texts)
        clean = (got["n_words"] >= MIN_WORDS) & (100 * got["n_repeat_words"] <= MAX_REPEAT_PCT * got["n_words"]) & (got["n_symbols"] <= MAX_SYMBOLS_PER_WORD * got["n_words"])
        points, at, counts = _padded(texts)
        text = np.repeat(np.arange(len(counts)), counts)
        if not everything:
            at, text = at[clean[text]], text[clean[text]]
        if not len(at):
            continue
        h = _hashes(points, at, _lang_seeds(langs)[text])
        keys, n = _distinct(h)
        where = np.empty(len(keys), np.int64)
        where[Sorted(keys).find(h)[0]] = np.arange(len(h))
        grams = np.stack([points[at[where] - (ORDER - 1) + j] for j in range(ORDER)], 1)
        number = np.array([names.setdefault(x, len(names)) for x in langs], np.int32)
        parts.append((keys, n.astype(np.int64), grams, number[text[where]]))
        if sum(len(p[0]) for p in parts) > HELD:
            parts = [_merge(parts)]
            if len(parts[0][0]) > 3 * HELD // 4:  # bounded memory: Spark adds the parts
                yield from flush()
                parts = []
    if parts:
        parts = [_merge(parts)]
        yield from flush()


def count_ngrams(docs: DataFrame, everything: bool = False) -> DataFrame:
    """(lang, gram, n) of every n-gram of the training documents, or of all documents."""
    parts = common.plain_ids(docs, "text", "lang").mapInArrow(common.tidy(lambda b: _count_partition(b, everything)), "lang string, gram string, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


# --- modified Kneser-Ney ----------------------------------------------------------------------------

def _discounts(levels: DataFrame) -> DataFrame:
    """(lang, k, d1, d2, d3, v) from (k, lang, gram, n): a language's discounts of each order (Chen and Goodman), and its n-grams plus one."""
    c = lambda k: F.sum(F.when(F.col("n") == k, 1.0).otherwise(0.0))
    n = levels.groupBy("lang", "k").agg((F.count("*") + 1).cast("double").alias("v"), *[c(k).alias(f"n{k}") for k in (1, 2, 3, 4)])
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def d(k: int):
        raw = k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")
        usable = (F.col(f"n{k}") > 0) & (F.col("n1") > 0) & (F.try_divide(F.col("n1"), F.col("n1")) == 1)
        return F.when(usable, F.greatest(F.lit(0.05 * k), F.least(raw, F.lit(0.95 * k)))).otherwise(F.lit(0.5 * k)).alias(f"d{k}")
    return n.select("lang", "k", d(1), d(2), d(3), "v")


def _taken():
    """The discount of a row's count."""
    return F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))


def train(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """The model: (lang, k, gram, logp, backoff) for every n-gram of 1 to ``order`` characters."""
    return _trained(docs, order)[0]


def _trained(docs: DataFrame, order: int = ORDER) -> tuple[DataFrame, int]:
    """The model and its number of rows.

    ``logp`` is the interpolated log probability of the last character after
    the others; ``backoff`` the log weight left to the shorter context where
    this n-gram is the context and the next character was not seen after it.
    All orders share the passes for discounts, contexts and back-off weights;
    only the interpolation goes order by order.  The discounts, one row per
    language and order, are a table of their own, so Spark sees its size and
    does not deal the n-grams by language.
    """
    levels = {order: common.cut(count_ngrams(docs), "ngrams")}
    for k in range(order - 1, 0, -1):  # continuation counts: how many characters stand before it
        up = levels[k + 1]
        levels[k] = common.cut(up.groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("n")), f"ngrams{k}")
    every = reduce(DataFrame.unionByName, [levels[k].select(F.lit(k).alias("k"), "lang", "gram", "n") for k in levels])
    discounts = common.cut(_discounts(every), "discounts")
    every = every.join(discounts, ["lang", "k"]).withColumn("ctx", F.substring("gram", F.lit(1), F.col("k") - 1))
    left = common.cut(every.groupBy("k", "lang", "ctx").agg(F.sum("n").alias("total"), F.sum(_taken()).alias("mass")), "contexts")
    backoff = left.select((F.col("k") - 1).alias("k"), "lang", F.col("ctx").alias("gram"), F.log(F.col("mass") / F.col("total")).alias("backoff"))
    rows = every.select("k", "lang", "gram", "ctx", "v", (F.col("n") - _taken()).alias("own")).join(left, ["k", "lang", "ctx"]).join(backoff, ["k", "lang", "gram"], "left")
    rows = common.cut(rows.select("k", "lang", "gram", "v", "own", "total", "mass", F.coalesce("backoff", F.lit(0.0)).alias("backoff")), "rows")
    below, parts = None, []
    for k in range(1, order + 1):
        mine = rows.where(F.col("k") == k)
        if below is None:
            mine = mine.withColumn("lower", 1.0 / F.col("v"))
        else:
            mine = mine.withColumn("suffix", F.substring("gram", 2, k - 1)).join(below.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("lower")), ["lang", "suffix"])
        below = mine.select("lang", "k", "gram", ((F.col("own") + F.col("mass") * F.col("lower")) / F.col("total")).alias("p"), "backoff")
        below = common.cut(below, f"p{k}") if k < order else below
        parts.append(below.select("lang", "k", "gram", F.log("p").alias("logp"), "backoff"))
    langs = docs.select(F.coalesce("lang", F.lit(_NO_LANG)).alias("lang")).distinct()
    size = discounts.where(F.col("k") == 1).select("lang", "v")
    floor = langs.join(size, "lang", "left").withColumn("v", F.coalesce("v", F.lit(float(CODE_POINTS)))).select("lang", F.lit(0).alias("k"), F.lit("").alias("gram"), F.log(1.0 / F.col("v")).alias("logp"), F.lit(0.0).alias("backoff"))
    model, seen = common.cut_measured(reduce(DataFrame.unionByName, [*parts, floor]), "model")
    return model, seen["rows"]


def gram_hashes(langs: list[str], orders: np.ndarray, grams: list[str]) -> np.ndarray:
    """The hashes of single n-grams, equal to those of ``_hashes``."""
    seeds = _lang_seeds(langs)
    out = np.zeros(len(grams), U)
    for k in np.unique(orders).tolist():
        pick = np.flatnonzero(orders == k)
        if k == 0:
            out[pick] = mix(seeds[pick] ^ U(0))
            continue
        points = np.frombuffer("".join(grams[i] for i in pick).encode("utf-32-le"), np.uint32)
        out[pick] = _hashes(points, np.arange(k - 1, len(points), k), seeds[pick], k)
    return out


def hash_arrays(model: DataFrame, shards: int) -> DataFrame:
    """The model as shards of sorted hash arrays: hashes (uint64), logp and backoff (float32)."""
    width = max(1, int(shards).bit_length() - 1)

    def hashed(batches):
        for b in batches:
            h = gram_hashes(b.column("lang").to_pylist(), b.column("k").to_numpy(), b.column("gram").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array((h >> U(64 - width)).astype(np.int32)), pa.array(h.view(np.int64)), b.column("logp").cast(pa.float32()), b.column("backoff").cast(pa.float32())], names=["shard", "h", "logp", "backoff"])

    def packed(batches):
        held = [b for b in batches if b.num_rows]
        if held:
            whole = pa.Table.from_batches(held)
            h = whole.column("h").to_numpy().view(U)
            order = np.argsort(h)
            rows = [np.ascontiguousarray(x[order]).tobytes() for x in (h, whole.column("logp").to_numpy(), whole.column("backoff").to_numpy())]
            yield pa.RecordBatch.from_arrays([pa.array([whole.column("shard")[0].as_py()], pa.int32()), pa.array([len(h)], pa.int64()), *(pa.array([r], pa.binary()) for r in rows)], names=["shard", "n", "hashes", "logp", "backoff"])
    rows = model.mapInArrow(common.tidy(hashed), "shard int, h long, logp float, backoff float").repartitionById(1 << width, F.col("shard"))
    return rows.mapInArrow(common.tidy(packed), "shard int, n long, hashes binary, logp binary, backoff binary")


# --- scoring ----------------------------------------------------------------------------------------

def features(texts: Texts) -> dict[str, np.ndarray]:
    """The contract's base counts of every text of a chunk."""
    data, n = texts.data, len(texts.data)
    lead = (data & 0xC0) != 0x80
    at, h = texts.windows(WINDOW)
    again, _ = repeated(texts.text[at], h)
    in_window = covered(len(texts.start), at[again], WINDOW)
    # lines: pieces between \n and the ends of texts that hold a word
    newline = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([texts.bounds[:-1], newline + 1])) if len(texts.counts) else np.zeros(0, np.int64)
    line_start = line_start[line_start < n]
    # a text that starts where others end owns the line; it ends at the next \n or with its own text
    owner = np.searchsorted(texts.bounds, line_start, side="right") - 1
    line_end = np.minimum(np.append(newline, n)[np.searchsorted(newline, line_start)], texts.bounds[owner + 1])
    words = np.searchsorted(texts.start, line_end) - np.searchsorted(texts.start, line_start)
    line_start, line_end, owner = line_start[words > 0], line_end[words > 0], owner[words > 0]
    _, earlier = repeated(owner, texts.byte_hashes(line_start, line_end))
    return {
        "n_words": texts.counts,
        "word_chars": texts.per_text(lead & ~texts.separator),
        "n_symbols": texts.per_text(_SYMBOL[data]),
        "n_dup_lines": np.bincount(owner[earlier], minlength=len(texts.counts)).astype(np.int64),
        "n_repeat_words": texts.per_text(in_window, texts.first),
    }


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


class _Model:
    """Broadcast form: one sorted array over all shards."""

    def __init__(self, hashes: bytes, logp: bytes, backoff: bytes):
        self.index = Sorted(np.frombuffer(hashes, U), ended=True)
        self.logp, self.backoff = np.frombuffer(logp, np.float32), np.frombuffer(backoff, np.float32)

    def score(self, points: np.ndarray, at: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        """Log probability of every character; unseen n-grams back off to shorter ones."""
        out = np.zeros(len(at))
        todo, order = np.arange(len(at)), ORDER
        while len(todo) and order >= 0:
            keys = _hashes(points, at[todo], seeds[todo], order) if order else mix(seeds[todo] ^ U(0))
            where, found = self.index.find(keys)
            out[todo[found]] += self.logp[where[found]]
            todo = todo[~found]
            if len(todo) and order > 1:  # the weight the seen context leaves to the next shorter one
                where, found = self.index.find(_hashes(points, at[todo] - 1, seeds[todo], order - 1))
                out[todo[found]] += self.backoff[where[found]]
            order -= 1
        return out


#: Name under which a worker keeps the model between tasks.
KEPT = "model"


def _score_by_broadcast(docs: DataFrame, arrays: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    shards = sorted(arrays.collect(), key=lambda r: r.shard)
    stops = {"hashes": b"\xff" * 8, "logp": bytes(4), "backoff": bytes(4)}
    key = uuid.uuid4().hex
    shared = spark.sparkContext.broadcast(tuple(b"".join([*(bytes(r[c]) for r in shards), stop]) for c, stop in stops.items()))

    def run(batches):
        for table in common.by_chunk(batches, "text", CHUNK_BYTES, KEPT):
            model = common.kept(KEPT, key, lambda: _Model(*shared.value))
            texts = Texts(common.column(table, "text"))
            langs = [x if x is not None else _NO_LANG for x in table.column("lang").to_pylist()]
            points, at, counts = _padded(texts)
            total = model.score(points, at, np.repeat(_lang_seeds(langs), counts))
            got = features(texts)
            edges = np.concatenate([[0], np.cumsum(counts)])
            sums = np.concatenate([[0.0], np.cumsum(total)])
            yield pa.RecordBatch.from_arrays([column for column in (common.column(table, "doc_id"), common.column(table, "lang"))] + [pa.array(got[c].astype(np.int64)) for c in _COUNTS] + [pa.array(counts), pa.array(sums[edges[1:]] - sums[edges[:-1]])],
                                             names=["doc_id", "lang", *_COUNTS, "n_scored", "logp"])
    rows = common.plain_ids(docs, "doc_id", "text", "lang").mapInArrow(common.tidy(run), "doc_id long, lang string, " + ", ".join(f"{c} long" for c in _COUNTS) + ", n_scored long, logp double")
    out = common.cut(rows, "scores")
    shared.destroy()
    return out


def _features_only(docs: DataFrame) -> DataFrame:
    def run(table):
        got = features(Texts(common.column(table, "text")))
        yield pa.RecordBatch.from_arrays([common.column(table, c) for c in ("row", "doc_id", "lang")] + [pa.array(got[c].astype(np.int64)) for c in _COUNTS], names=["row", "doc_id", "lang", *_COUNTS])
    return common.map_chunks(common.plain_ids(docs, "row", "doc_id", "lang", "text"), run, "row long, doc_id long, lang string, " + ", ".join(f"{c} long" for c in _COUNTS))


def _spread(table: pa.Table):
    """One row per distinct n-gram of a chunk: the documents that hold it and how often."""
    texts = Texts(common.column(table, "text"))
    langs = [x if x is not None else _NO_LANG for x in table.column("lang").to_pylist()]
    rows = table.column("row").to_numpy()
    points, at, counts = _padded(texts)
    text = np.repeat(np.arange(len(counts)), counts)
    h = _hashes(points, at, np.repeat(_lang_seeds(langs), counts))
    order = np.lexsort((text, h))
    if not len(order):
        return
    h, text = h[order], text[order]
    pair = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])]))
    n = np.diff(np.append(pair, len(h)))
    gram = np.flatnonzero(np.concatenate([[True], h[pair][1:] != h[pair][:-1]]))
    edge = np.append(gram, len(pair))
    for k in range(0, len(gram), 20_000):
        part = edge[k:k + 20_001]
        lo, hi = part[0], part[-1]
        first = order[pair[part[:-1]]]
        whole = np.stack([points[at[first] - (ORDER - 1) + j] for j in range(ORDER)], 1).astype("<u4").tobytes().decode("utf-32-le")
        lists = [pa.ListArray.from_arrays(pa.array((part - lo).astype(np.int32)), pa.array(x)) for x in (rows[text[pair[lo:hi]]], n[lo:hi])]
        yield pa.RecordBatch.from_arrays([pa.array([langs[t] for t in text[pair[part[:-1]]]]), pa.array([whole[i * ORDER:(i + 1) * ORDER] for i in range(len(first))]), *lists], names=["lang", "gram", "rows", "ns"])


def _resolve(grams: DataFrame, model: DataFrame) -> DataFrame:
    """(lang, gram, logp) for distinct n-grams: the longest known order, plus the back-off weights on the way."""
    single = lambda c: F.col(c).cast("float").cast("double")  # noqa: E731  as in the arrays
    done, todo = None, grams.withColumn("sum", F.lit(0.0))
    for k in range(ORDER, -1, -1):
        level = model.where(F.col("k") == k).select("lang", F.col("gram").alias("tail"), single("logp").alias("own"))
        tail = F.substring("gram", ORDER - k + 1, k) if k else F.lit("")
        tried = todo.withColumn("tail", tail).join(level, ["lang", "tail"], "left")
        got = tried.where(F.col("own").isNotNull()).select("lang", "gram", (F.col("sum") + F.col("own")).alias("logp"))
        done = got if done is None else done.unionByName(got)
        todo = tried.where(F.col("own").isNull()).select("lang", "gram", "sum")
        if k > 1:
            before = model.where(F.col("k") == k - 1).select("lang", F.col("gram").alias("ctx"), single("backoff").alias("b"))
            todo = todo.withColumn("ctx", F.substring("gram", ORDER - k + 1, k - 1)).join(before, ["lang", "ctx"], "left").select("lang", "gram", (F.col("sum") + F.coalesce("b", F.lit(0.0))).alias("sum"))
    return done


def _score_by_join(docs: DataFrame, model: DataFrame) -> DataFrame:
    """The same scores by joins, for a model too large to broadcast.

    Each chunk of documents sends one row per distinct n-gram, so a frequent
    one comes once a chunk (AQE splits what is still hot); the distinct
    n-grams of all documents are looked up order by order, as in ``_Model``.
    Equal rows share a key; the mean over their characters is the same.
    """
    docs = docs.withColumn("row", F.xxhash64("doc_id", "lang", "text"))
    grams = common.map_chunks(common.plain_ids(docs, "row", "lang", "text"), _spread, "lang string, gram string, rows array<long>, ns array<long>")
    best = common.cut(_resolve(count_ngrams(docs, everything=True).drop("n"), model), "resolved")
    each = grams.join(best, ["lang", "gram"]).select("logp", F.explode(F.arrays_zip("rows", "ns")).alias("x"))
    sums = each.groupBy(F.col("x.rows").alias("row")).agg(F.sum(F.col("x.ns") * F.col("logp")).alias("logp"), F.sum("x.ns").alias("n_scored"))
    return common.cut(_features_only(docs).join(sums, "row", "left").drop("row").withColumn("n_scored", F.coalesce("n_scored", F.lit(0))), "scores")


def scores(docs: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, lang, base counts, n_scored, logp): the corpus scored by the model trained on it.

    The model is broadcast when its measured size is within ``broadcast_bytes``
    and joined otherwise.
    """
    model, entries = _trained(docs)
    if entries * 16 <= broadcast_bytes:
        arrays = common.cut(hash_arrays(model, min(64, common.shards_for(docs))), "arrays")
        return _score_by_broadcast(docs, arrays)
    return _score_by_join(docs, model)


# --- bands ------------------------------------------------------------------------------------------

def _median(df: DataFrame, value: str, out: str) -> DataFrame:
    """(lang, out): exact lower median per language; every task sends its counts of the grid's values only."""
    return common.cut(df.groupBy("lang").agg(F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{value}`)").alias(out)), out)


def judge(scored: DataFrame, lower: float = LOWER, upper: float = UPPER) -> DataFrame:
    """Add perplexity, the language's band, base_failed and kept."""
    mean = F.try_divide(-F.col("logp"), F.col("n_scored"))
    scored = scored.withColumn("lang", F.coalesce("lang", F.lit(_NO_LANG))).withColumn("grid", F.floor(F.when(F.col("n_words") >= MIN_WORDS, mean) * GRID))
    narrow = F.sqrt(F.least(F.lit(1.0), F.col("n_scored") / REFERENCE_CHARS))
    base = scored.where(F.col("grid").isNotNull()).select("lang", "grid", narrow.alias("narrow"))
    mid = _median(base, "grid", "mid")
    spread = _median(base.join(mid, "lang").select("lang", F.floor(F.abs(F.col("grid") - F.col("mid")) * F.col("narrow")).alias("off")), "off", "off")
    bands = common.cut(mid.join(spread, "lang").select("lang", (F.col("mid") / GRID).alias("mid"), F.greatest(F.col("off") / GRID * 1.4826, F.lit(LEAST_SPREAD)).alias("spread")), "bands")
    out = scored.join(bands, "lang", "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    wide = F.col("spread") / F.greatest(narrow, F.lit(1e-3))
    low, high = F.col("mid") - lower * wide, F.col("mid") + upper * wide
    return out.select("doc_id", *_COUNTS, failed.alias("base_failed"), (~failed & F.coalesce(mean.between(low, high), F.lit(False))).alias("kept"),
                      F.exp(mean).alias("perplexity"), F.exp(low).alias("band_low"), F.exp(high).alias("band_high"))


def quality(docs: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document: base counts, perplexity, band and verdict."""
    return judge(scores(docs, broadcast_bytes))
