"""Sharding, hard negatives and lexical search against brute-force versions, odd rows included."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from streamguard.llm import common, hardneg, lexrank, sharding

SCHEMA = "doc_id long, text string, cell string, shard int, turn string, bag string, hash string, item int"


def documents():
    rng = random.Random(11)
    words = [f"W{i}" for i in range(50)] + ["élan", "ÉLAN", "x", "7"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(1, 90))) for _ in range(260)]
    texts += [None, "", " \t--\n", "\x01", "w1", texts[0], texts[0] + "!", "a" * 70000, "w1 " * 30000]
    rows = [(i, t, "c", i, "t", "b", "h", 1) for i, t in enumerate(texts)]
    return [*rows, rows[5], rows[5], *[(300, "w2 same", None, None, None, None, None, None)] * 90, (None, "w3 w4", *[None] * 6), (None, None, *[None] * 6)]


@pytest.fixture(scope="module")
def docs(spark):
    common.bounded_batches(spark)
    return common.cut(spark.createDataFrame(documents(), SCHEMA))


def plain(rows):
    return sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows)


def by_hand(keyed, owners, shards, room, weigh):
    """One document after another: rounds of (shard, turn) order; ``owners(closed)`` gives the cells' shards."""
    left, placed, walking, hops = list(room), [], list(keyed), 0
    while walking:
        owner = owners([s for s in range(shards) if left[s] <= 0])
        per, later = {}, []
        for r in walking:
            per.setdefault(owner[r.cell], []).append(r)
        for s, rows in per.items():
            for r in sorted(rows, key=lambda r: (r.turn, r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.tie)):
                if left[s] > 0:
                    placed.append((r.tie, s, hops))
                    left[s] -= weigh(r)
                else:
                    later.append(r)
        walking, hops = later, hops + 1
    return sorted(placed)


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_ring_equals_a_plain_one(spark, docs, monkeypatch, law):
    shards, replicas = 7, 16
    kept = {}
    monkeypatch.setattr(sharding, "keyed", lambda d, bits, seed, f=sharding.keyed: kept.setdefault("t", common.cut(f(d, bits, seed))))
    got = sharding.place(docs, shards, law, replicas).collect()
    bits = sharding._cell_bits(shards, replicas)
    owners = lambda closed: {r.cell: r.shard for r in sharding.ring(spark, shards, replicas, bits, closed).collect()}
    rows = kept["t"].collect()
    assert len(owners([])) == 1 << bits and set(owners([1, 3]).values()) == {0, 2, 4, 5, 6}
    room = sharding.capacities(law, shards, len(rows), sum(r.size for r in rows), 0.02)
    want = by_hand(rows, owners, shards, room, (lambda r: 1) if law == "rows" else lambda r: r.size)
    key = {r.tie: r for r in rows}
    assert sorted((str(key[t].doc_id), key[t].text_crc32, s, h) for t, s, h in want) == sorted((str(r.doc_id), r.text_crc32, r.shard, r.hops) for r in got)
    for s in range(shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_ring_contract(spark, docs):
    texts = [(r[0], (r[1] or "").encode()) for r in documents()]
    got = sharding.report(docs).collect()
    assert plain(got) == sorted((str(i), len(t) + 16, zlib.crc32(t)) for i, t in texts)
    counts = Counter(r.shard for r in got)
    assert set(counts) <= set(range(40)) and max(counts.values()) - min(counts[s] for s in range(40)) <= 1
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    assert [r.asDict() for r in sorted(got, key=lambda r: (r.shard, r.slot))] == [r.asDict() for r in sorted(sharding.report(docs).collect(), key=lambda r: (r.shard, r.slot))]
    assert sharding.report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_ring_moves_little_when_a_shard_is_added(spark):
    docs = spark.range(6000).selectExpr("id as doc_id", "concat('text ', id) as text")
    a, b = ({r.doc_id: r.shard for r in sharding.place(docs, n).collect()} for n in (40, 41))
    moved = [i for i in a if a[i] != b[i]]
    assert len(moved) < 0.08 * len(a) and sum(b[i] == 40 for i in moved) == sum(s == 40 for s in b.values())


def test_bytes_law_bounds_every_shard(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "repeat('x', cast(id % 977 as int)) as text")
    got = sharding.place(docs, 10, "bytes", slack=0.01).collect()
    load = Counter()
    for r in got:
        load[r.shard] += r.size
    mean = sum(load.values()) / 10
    assert max(load.values()) <= 1.01 * mean + 977 + 17 and min(load.values()) > 0.8 * mean


def vectors():
    rng = np.random.default_rng(12)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 20)], int(rng.integers(0, 4))) for i in range(260)]
    rows += [(i, [0.25] * 20, 1) for i in range(300, 320)]  # ties
    rows += [(400, None, 1), (401, [nan] * 20, 1), (402, [inf] + [0.0] * 19, 1), (403, [None] + [1.0] * 19, 2), (404, [], 1), (405, [0.5] * 20, None), (None, [0.9] * 20, 1)]
    rows += [(450, [0.5, -0.5], 1), (451, [0.5, -0.25], 1), (452, [0.5, 0.0], 2), (453, [0.3, 0.0], 2)]  # another length
    return [*rows, rows[50], rows[51], rows[3], rows[3], (500, [1e6] * 20, 3), (501, [-1e6] * 20, 3), (502, [5e5] * 20, 2)]


def mined(rows):
    use = [(i, [math.floor(256 * x) for x in np.float32(v).astype(float)], (y + 1) % 10 if i % 7 == 0 else y) for i, v, y in rows
           if i is not None and v and y is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v, y in use:
        if i % 50:
            continue
        got = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, z) for j, w, z in use if j != i and len(w) == len(v))
        for s, j, z in [g for g in got if g[2] == y][:5]:
            near = [g for g in got if g[2] != y and 50 * -s <= 100 * -g[0] <= 95 * -s]
            out += [(i, j, k + 1, g[1], -s, -g[0]) for k, g in enumerate(near[:3])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(2048, 65536), (16, 16)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(hardneg, "CANDIDATE_BLOCK", blocks)
    monkeypatch.setattr(hardneg, "ANCHOR_BLOCK", 3 if blocks[0] == 16 else 256)
    df = spark.createDataFrame([(*r, "x", 1) for r in vectors()], "vec_id long, embedding array<float>, label int, dims string, anchor int")
    got = sorted(tuple(r)[:6] for r in hardneg.mine(df).collect())
    assert got == mined(vectors()) and len({r[0] for r in got}) > 4
    assert hardneg.mine(df.where("false")).collect() == []


def test_tables_give_exact_products():
    rng = np.random.default_rng(13)
    for dims, most in ((1, 3), (8, 300), (19, 1 << 20), (64, 256)):
        a, b = rng.integers(-most, most, (5, dims)), rng.integers(-most, most, (40, dims))
        planes = hardneg.bit_planes(b, most.bit_length() + 1)
        assert (hardneg.whole_numbers(planes, dims) == b).all()
        assert (hardneg.scores(hardneg.subset_sums(a), planes) == b @ a.T).all()


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items):
    split = lambda t: TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    bags = [(i, Counter(split(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n, total, df = len(bags), sum(b[2] for b in bags), Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for i, b, size in bags:
            m = 50 + 50 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * b[t] // (1000 * b[t] + 20 * m)) for t in set(split(text)) if b[t])
            if s > 0:
                found.append((-s, i is None, i))
        out += [(item, k + 1, f[2], -f[0]) for k, f in enumerate(sorted(found, key=lambda f: f[:2] + (f[2] or 0,))[:50])]
    return sorted(out, key=str)


ITEMS = [(1, "W1, w2; élan"), (2, "w3-w4 w3"), (3, None), (4, "..."), (5, "nowhere"), (6, "a" * 70000 + " w9"), (7, " ".join(f"w{i}" for i in range(50))), (7, "x 7"), (None, "ÉLAN w1"), (8, "same")]


@pytest.mark.parametrize("pairs,dense", [(500_000, 1 << 21), (9, 100)])
def test_search_equals_brute_force(spark, docs, monkeypatch, pairs, dense):
    monkeypatch.setattr(lexrank, "BLOCK_PAIRS", pairs)
    monkeypatch.setattr(lexrank, "DENSE", dense)
    items = spark.createDataFrame([(*r, 1) for r in ITEMS], "item_id long, text string, item int")
    got = lexrank.search(docs, items).collect()
    assert sorted((tuple(r) for r in got), key=str) == ranked([r[:2] for r in documents()], ITEMS)
    assert lexrank.search(docs.where("false"), items).collect() == [] and lexrank.search(docs, items.where("false")).collect() == []


def test_equal_bags_are_scored_once(spark):
    rows = [(i, "red fish" if i % 2 else "RED, fish!") for i in range(400)] + [(900, "red red fish"), (901, "blue fish")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = lexrank.search(docs, spark.createDataFrame([(1, "red")], "item_id long, text string")).collect()
    assert [r.doc_id for r in sorted(found, key=lambda r: r.rank)][:3] == [900, 0, 1] and len(found) == 50
    known = spark.sparkContext.broadcast(lexrank.Vocabulary(*(c.to_numpy() for c in (lexrank.item_terms(spark.createDataFrame([(1, "red")], "item long, text string")).toArrow().columns))))
    groups = lexrank.classes(lexrank.bags(docs, known), 402, 805).collect()
    assert sorted(len(g.members) for g in groups) == [1, 50] and min(groups, key=lambda g: -len(g.members)).members == list(range(50))
