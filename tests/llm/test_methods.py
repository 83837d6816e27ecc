"""Each operator against a brute-force version, an exact round trip or its SQL."""

import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from streamguard.llm import common, maintext, minhash, packing, perplexity, queries, substring, tokens, warc
from streamguard.llm.wordhash import Texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, SF)
    assert set(got.columns) == set(want.columns)
    order = sorted(want.columns)
    rows = lambda data: sorted((tuple(map(str, r)) for r in data))
    assert rows(tuple(r[c] for c in order) for r in got.collect()) == rows(tuple(r[want.columns.index(c)] for c in order) for r in want.fetchall())


def near_copies(n=70, seed=2):
    """One bucket-filling group of edited copies, and others."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(150)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.choice((1, 2, 4, 8))):
            words[rng.randrange(150)] = f"x{rng.randrange(10 ** 6)}"
        out.append((i, " ".join(words)))
    return out + [(100 + i, " ".join(f"y{rng.randrange(10 ** 6)}" for _ in range(80))) for i in range(20)]


def brute_components(rows, width):
    sets = {}
    for i, t in rows:
        w = WORD.findall(t.lower())
        sets[i] = {tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


@pytest.mark.parametrize("paired", [1000, 2])
def test_near_duplicates_by_pairs_and_by_blocks(spark, monkeypatch, paired):
    monkeypatch.setattr(minhash, "PAIRED", paired)
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rows = near_copies()
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows, 5)


def test_scores_by_join_equal_scores_by_broadcast(spark):
    docs = common.cut(spark.read.parquet(f"{SF}/documents.parquet").limit(60))
    key = lambda r: r.doc_id
    a, b = (sorted(perplexity.scores(docs, limit).collect(), key=key) for limit in (1 << 40, 0))
    assert len(a) == len(b) == 60
    for x, y in zip(a, b, strict=True):
        assert (x.n_words, x.n_repeat_words, x.n_scored) == (y.n_words, y.n_repeat_words, y.n_scored)
        assert abs((x.logp or 0) - (y.logp or 0)) <= 1e-6 * abs(x.logp or 1)


def test_untrained_language_scores_alike_by_join_and_broadcast(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    prose = [(i, " ".join(rng.choices(words, k=60)), "en") for i in range(6)]
    code = [(10 + i, " ".join(f"{w} |" for w in rng.choices(words, k=60)), lang) for i, lang in enumerate(("c", "c", "c", None))]
    docs = common.cut(spark.createDataFrame(prose + code, "doc_id long, text string, lang string"))
    a, b = ({r.doc_id: r for r in perplexity.quality(docs, limit).collect()} for limit in (1 << 40, 0))
    for i, text, _ in code:
        assert not a[i].base_failed and a[i].kept and b[i].kept
        assert a[i].perplexity == pytest.approx(perplexity.CODE_POINTS, rel=1e-5) and b[i].perplexity == pytest.approx(a[i].perplexity, rel=1e-5), text
    assert [a[i].kept for i in range(6)] == [b[i].kept for i in range(6)]


def test_model_is_a_distribution(spark):
    rng = random.Random(3)
    docs = [(i, " ".join("".join(rng.choices("abc", k=rng.randrange(1, 6))) for _ in range(60)), "en") for i in range(4)]
    model = perplexity.train(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()
    assert {r.k for r in model} == {0, 1, 2, 3, 4, 5}
    for k in (1, 2, 5):
        for ctx in {r.gram[:-1] for r in model if r.k == k}:
            assert 0 < sum(np.exp(r.logp) for r in model if r.k == k and r.gram[:-1] == ctx) <= 1 + 1e-9


def test_base_counts():
    rng = random.Random(4)
    texts = [" ".join(rng.choices("a b c dd é# *x".split(), k=rng.randrange(60))) + rng.choice(("\n", "\nx\nx", "")) for _ in range(40)] + ["", " \n "]
    import pyarrow as pa
    got = perplexity.features(Texts(pa.array(texts)))
    for i, t in enumerate(texts):
        w = WORD.findall(t)
        win = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
        cover = {k + j for k, x in enumerate(win) if win.count(x) > 1 for j in range(8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover)
        assert tuple(int(got[c][i]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want


@pytest.mark.parametrize("texts", [["ab", "a\na"], ["", "a\na\nb"], ["x\n", "", None, "a b\na b", "a b"], ["a\n", "\na\na\n", "a"]])
def test_first_lines_behind_other_texts_count(texts):
    import pyarrow as pa
    got = perplexity.features(Texts(pa.array(texts, pa.string())))["n_dup_lines"].tolist()
    lines = [[x for x in (t or "").split("\n") if WORD.search(x)] for t in texts]
    assert got == [len(x) - len(set(x)) for x in lines]


def test_junk_is_rejected_and_clean_text_kept(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = perplexity.quality(docs).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed").toPandas()
    assert got[got.quality == 1].kept.mean() > 0.99 and got[got.quality == 0].kept.mean() < 0.2


def test_repeated_passages_in_small_chunks(spark, monkeypatch):
    """Windows judged over many chunks and shards, repeated rows included."""
    rng = random.Random(5)
    shared = [" ".join(f"s{rng.randrange(10 ** 6)}" for _ in range(30)) for _ in range(3)]
    rows = []
    for i in range(60):
        own = [f"o{rng.randrange(10 ** 6)}" for _ in range(20)]
        rows.append((i, " ".join([*own[:10], *rng.sample(shared, 2), *own[10:], "\n"])))
    rows += [rows[7], (None, rows[0][1]), (99, None)]
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - 12):
            if i is not None:
                key = tuple(w[k:k + 13])
                first[key] = min(first.get(key, i), i)
    want = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = {k + j for k in range(len(w) - 12) if i is not None and first[tuple(w[k:k + 13])] < i for j in range(13)}
        want.append((str(i), len(w), len(gone)))
    monkeypatch.setattr(substring, "CHUNK_BYTES", 3000)
    got = substring.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed) for r in got) == sorted(want)


def test_plan_packs_everything_tightly():
    rng = random.Random(6)
    for _ in range(30):
        counts = {}
        for _ in range(rng.randrange(1, 400)):
            s = rng.choice((rng.randrange(1, 1025), rng.randrange(1, 200)))
            counts[s] = counts.get(s, 0) + rng.randrange(1, 5)
        slots = packing.plan(counts)
        fill = {}
        seen = {s: 0 for s in counts}
        for s, lo, hi, base, k, off in slots:
            seen[s] += hi - lo
            for r in range(hi - lo):
                fill.setdefault(base + r // k, []).append((off + r % k * s, s))
        assert seen == counts
        for parts in fill.values():
            at = 0
            for off, s in sorted(parts):
                assert off == at
                at += s
            assert at <= 1024
        assert len(fill) <= 1.25 * -(-sum(s * n for s, n in counts.items()) // 1024) + 2


def test_ids_equal_the_tokenizer():
    import pyarrow as pa
    from tokenizers import Tokenizer
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|startoftext|>x<|ENDOFTEXT|> y", "x" * 3 + "<|endoftext|><|endoftext|>", "no <|end of text|>",
             "Hello  world\n\n it's  a test", " lead", "trail ", "a  b", "x 　y z", "don't <|endoftext|> stop", "", "\t\n", "é é  é", "\x01 a\x01b c", "1 234,5 ́x"] * 2
    for name, cuts in (("byte_bpe_50k.json", "blank"), ("word_bpe_49k.json", "word")):
        whole = Tokenizer.from_file(queries.tokenizer(name))
        encoder = tokens.Encoder(queries.tokenizer(name), cuts)
        for _ in range(2):
            ids, bounds = encoder.encode(Texts(pa.array(texts)))
            assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
            encoder._settle()


def _odd_texts():
    rng = random.Random(9)
    words = ["the", "cat", "sat", "Ünïcode", "x" * 30, "1 234", "\n", "\t\t", "<|endoftext|>", "☃", "it's"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(60))) for _ in range(40)]
    return [(i, t) for i, t in enumerate([*texts, None, "", " ".join(rng.choices(words[:5], k=4000)), texts[0], "a" * 5000])] + [(3, texts[3]), (None, "null id")]


def _plain_ids(name):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(queries.tokenizer(name))
    return lambda text: [*plain.encode(text or "", add_special_tokens=False).ids, 2]


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packed_pieces_equal_a_plain_tokenizer(spark):
    ids = _plain_ids("byte_bpe_50k.json")
    got = packing.pack(packing.pieces(spark.createDataFrame(_odd_texts(), "doc_id long, text string"), queries.tokenizer("byte_bpe_50k.json"))).collect()
    want = []
    for i, text in _odd_texts():
        own = ids(text)
        at, piece = 0, 0
        size = len(own) if len(own) <= 1024 else len(own) % 1024 or 1024
        while at < len(own):
            want.append((str(i), piece, at, size, _crc(own[at:at + size])))
            at, piece, size = at + size, piece + 1, 1024
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    fill = {}
    for r in got:
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(fill) <= -(-sum(r.length for r in got) // 1024) + 2


def test_token_files_equal_a_plain_tokenizer(spark):
    from streamguard.llm import tokenfile
    ids = _plain_ids("word_bpe_49k.json")
    rows = [r for r in _odd_texts() if r[0] is not None and r != (3, dict(_odd_texts())[3])] + [(77, "last <|startoftext|>")]
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in tokenfile.round_trip(spark.createDataFrame(rows, "doc_id long, text string"), queries.tokenizer("word_bpe_49k.json")).collect())
    want, at = [], 0
    for i, text in sorted(rows, key=lambda r: r[0]):
        own = ids(text)
        want.append((i, at, len(own), _crc(own)))
        at += len(own)
    assert got == want


def test_warc_long_record_and_damage():
    big = bytes(17 << 20)
    data = warc.member(warc.record(1, "http://x/\r\n", big, None)) + warc.member(warc.record(2, None, b"", None)) + warc.member(warc.record(3, "u", big, 1))
    assert data[-1] == 0
    got = [warc.parse(x) for x in warc.read_members(data[k:k + 1000] for k in range(0, len(data), 1000))]
    assert [(r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got] == [(1, 17 << 20, "response", None), (2, 0, "response", None), (3, 17 << 20, "revisit", 1)]
    assert got[0]["payload"] == big and got[0]["payload_digest"] == got[2]["payload_digest"]
    with pytest.raises((ValueError, zlib.error)):
        list(warc.read_members([data[:5000]]))


def test_cut_is_minimal():
    rng = random.Random(7)
    for _ in range(60):
        n = rng.randrange(1, 9)
        unary = [rng.randrange(-50, 51) for _ in range(n)]
        ties = {(i, j): rng.randrange(0, 40) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5}
        cost = lambda x: sum(max(0, u) if not k else max(0, -u) for u, k in zip(unary, x, strict=True)) + sum(w for (i, j), w in ties.items() if x[i] != x[j])  # noqa: B023,E731
        best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
        assert cost(maintext.cut(unary, ties)) == best


def test_main_text_of_a_page():
    page = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><header>Site</header><nav><ul><li><a href=x>Home</a></ul></nav>
    <div class="cookie-notice">We use cookies on this site, please accept them all now.</div><article><h1>A &amp; B</h1><p>First   line<br>goes on.<p>Second one.</p><div class="ad">Buy it.</div></article>
    <div id="comments"><p>I liked this article a lot, thank you for writing it all down.</p></div><form>Name <input></form><footer>&copy; me</footer>"""
    assert maintext.main_text(page) == "A & B\nFirst line goes on.\nSecond one."
    assert maintext.main_text("") == ""


@pytest.mark.parametrize("inside", ["<svg class='i'/>", "<svg width=1 />", "<svg/>", "<math/>", "<button>", "<video src=x>", "<audio src='x'>", "<canvas>", "<object data=x>", "<select>", "<svg><path d='M0'><title/>",
                                    "<video><p>No video here.</p></video>", "<template>a<template>b</template>c</template>", "<button>Buy</button>", "<svg><g/><text>icon</text></svg>", "<script>var a = '<p>';</script>"])
def test_no_text_is_lost_behind_an_element(inside):
    long = "This sentence belongs to the article and is long enough to be kept, whatever stands before it."
    assert maintext.main_text(f"<body><article><p>{long}</p>{inside}<p>{long}</p><p>The end.</p></article></body>") == f"{long}\n{long}\nThe end."


def test_formulas_stay_in_the_text():
    page = "<article><p>The energy is <math><mi>E</mi><mo>=</mo><mi>m</mi><semantics><annotation encoding='application/x-tex'>tex</annotation></semantics></math> as everybody knows, and it is kept.</p></article>"
    assert maintext.main_text(page) == "The energy is E=m as everybody knows, and it is kept."


@pytest.mark.parametrize("attributes,kept", [('data-hidden="false"', True), ('title="A hidden gem"', True), ('aria-label="hidden costs"', True), ('data-role="header"', True), ("data-x='class=\"ad\"'", True),
                                             ("hidden", False), ('HIDDEN=""', False), ('aria-hidden="true"', False), ("aria-hidden=false", True), ('class="x ad"', False), ('data-a=b style="display: none"', False)])
def test_attributes_are_read_name_by_name(attributes, kept):
    long = "This sentence belongs to the article and is long enough to be kept, whatever stands before it."
    assert maintext.main_text(f"<body><article {attributes}><p>{long}</p></article></body>") == (long if kept else "")


def test_licences_inherit_from_the_nearest_directory(spark):
    from streamguard.llm.licences import scan
    apache, mit = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."
    files = [(1, "LICENSE", mit), (2, "lib/COPYING", apache), (3, "lib/x/a.c", "int x;"), (4, "b.c", "plain words here"), (5, "lib/x/c.c", "some code\n" + mit + "\nmore code and words and things"), (6, "libs/z.c", None), (7, None, "text")]
    got = {r.key: (r.licence, r.origin, r.inherited_from) for r in scan(spark.createDataFrame(files, "key long, path string, text string")).collect()}
    assert got[3] == ("Apache-2.0", "directory", "lib") and got[4] == ("MIT", "directory", "") and got[5] == ("MIT", "header", None)
    assert got[6] == ("MIT", "directory", "") and got[7] == (None, "none", None) and got[2][0] == "Apache-2.0"


def test_every_term_of_a_licence_line_weighs_by_its_documents(spark):
    import math

    from streamguard.llm.licences import TEMPLATES, scan
    line, prose = "The photographs in this article are released under the MIT License.", "The photographs in this article are old, and the file is yours."
    split = lambda t: re.findall("[a-z0-9]+", t.lower())
    got = []
    for n in (40, 400):
        texts = [line] * (n // 40) + [prose] * (n // 2) + ["plain words here"] * (n - n // 40 - n // 2)
        idf = lambda t: math.log((1 + n) / (1 + sum(t in split(x) for x in texts)))  # noqa: B023,E731
        own, goal = ({t: split(x).count(t) * idf(t) for t in split(x)} for x in (line, dict(TEMPLATES)["MIT"]))
        want = sum(w * goal.get(t, 0) for t, w in own.items()) / math.hypot(*own.values()) / math.hypot(*goal.values())
        rows = scan(spark.createDataFrame([(i, f"d{i}/a", t) for i, t in enumerate(texts)], "key long, path string, text string"), 0.5).where("key = 0").collect()
        assert rows[0].licence == "MIT" and abs(rows[0].cosine - want) < 2e-6
        got.append(rows[0].cosine)
    assert got[1] > 0.9


def test_word_hashes_hold_a_bounded_part_of_a_chunk():
    """Prefix sums of a chunk's bytes are held block by block; long texts, empty ones and any order give the same hashes."""
    import pyarrow as pa
    import tracemalloc
    from streamguard.llm import wordhash
    rng = random.Random(4)
    words = [" ".join(f"w{rng.randrange(5000)}" for _ in range(n)) for n in [300] * 900 + [60_000, 0, 0, 5]]
    chunk = Texts(pa.array(words))
    whole = wordhash.range_hashes(wordhash._byte_values()[chunk.data], chunk.start, chunk.end)
    texts = wordhash.range_hashes(wordhash._byte_values()[chunk.data], chunk.bounds[:-1], chunk.bounds[1:])
    assert (chunk.byte_hashes(chunk.bounds[:-1], chunk.bounds[1:]) == texts).all()
    assert (chunk.byte_hashes(chunk.start[::-1], chunk.end[::-1]) == whole[::-1]).all()
    wordhash._powers.clear()
    tracemalloc.start()
    try:
        got = chunk.word_hashes()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (got == whole).all()
    assert peak < 12 * len(chunk.data)


@pytest.mark.parametrize("tile_bytes", [1, 3 * 16 * 5 * 8, 32 << 20])
def test_leaves_are_sent_once_per_tile(spark, monkeypatch, tile_bytes):
    """Links and components of a crowded cloud, whatever the tiles; the rows sent follow the tiles, not the pairs."""
    from streamguard.llm import gridjoin
    monkeypatch.setattr(gridjoin, "LEAF", 16)
    monkeypatch.setattr(gridjoin, "TILE_BYTES", tile_bytes)
    seen, dealt = [], gridjoin._dealt
    monkeypatch.setattr(gridjoin, "_dealt", lambda pairs, *rest: seen.append((pairs.count(), rest[1], (out := dealt(pairs, *rest)).count())) or out)
    rng = np.random.default_rng(8)
    x = (rng.normal(size=(300, 5)) + [2, 0, 0, 0, 0]).astype(np.float32)
    got = {r.vec_id: (r.n_links, r.component_id) for r in gridjoin.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")).collect()}
    z = x.astype(float) / np.sqrt((x.astype(float) ** 2).sum(axis=1, keepdims=True))
    near = z @ z.T >= gridjoin.COSINE
    low = np.arange(300)
    while (new := np.where(near, low[None, :], 300).min(axis=1)).tolist() != low.tolist():
        low = new
    assert got == {i: (int(near[i].sum()) - 1, int(low[i])) for i in range(300)}
    pairs, width, sent = seen[0]
    assert width == max(1, min(tile_bytes // 640, width)) and (width == 1 or sent < pairs)
