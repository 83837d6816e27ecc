"""The registered queries of this package: name -> fn(spark, sf_dir), and DuckDB text where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import bounded_batches

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark, sf_dir):
            bounded_batches(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op2_perplexity")
def op2_perplexity(spark, sf_dir):
    """Base rules and perplexity bands over all documents."""
    from .perplexity import quality
    return quality(table(spark, sf_dir, "documents"))


@query("op10_minhash", oracle="""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
  ELSE list_distinct([array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)]) END AS sh FROM w),
e AS (SELECT doc_id, unnest(sh) AS g FROM s),
n AS (SELECT doc_id, count(*) AS n FROM e GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (WITH RECURSIVE r(x, y) AS (SELECT a, b FROM u UNION SELECT r.x, u.b FROM r JOIN u ON u.a = r.y) SELECT x, min(y) AS m FROM r GROUP BY 1)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m, s.doc_id)) AS component_id,
  s.doc_id = least(s.doc_id, coalesce(m, s.doc_id)) AS kept
FROM s LEFT JOIN reach ON reach.x = s.doc_id
""")
def op10_minhash(spark, sf_dir):
    """Near-duplicate components over all documents, four-word shingles at 0.8."""
    from .minhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), width=4, pct=80)


@query("op4_substring", oracle="""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i, ws FROM w WHERE len(ws) >= 13),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM p),
m AS (SELECT g, min(doc_id) AS first FROM g GROUP BY 1),
lost AS (SELECT doc_id, list(i) AS pos FROM g JOIN m USING (g) WHERE first < doc_id GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, unnest(flatten([range(x, x + 13) FOR x IN pos])) AS i FROM lost),
k AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string([ws[i] FOR i IN range(1, len(ws) + 1) IF gone IS NULL OR NOT list_contains(gone, i)], ' ')) AS kept_sha256
FROM w LEFT JOIN k ON k.doc_id = w.doc_id
""")
def op4_substring(spark, sf_dir):
    """Repeated 13-word windows taken out of all documents."""
    from .substring import digests
    return digests(table(spark, sf_dir, "documents"), width=13)


def tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op3_mixing", oracle="""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
w AS (SELECT source, source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM s),
r AS (SELECT *, 3 * source_size AS cap, CAST(3 * source_size AS DOUBLE) / weight AS ratio FROM w),
b AS (SELECT *, coalesce(sum(cap) OVER p, 0) AS caps, coalesce(sum(weight) OVER p, 0) AS weights, sum(source_size) OVER () AS t, sum(weight) OVER () AS ws
  FROM r WINDOW p AS (ORDER BY ratio, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min(CAST(t - caps AS DOUBLE) / CAST(ws - weights AS DOUBLE), ratio) AS level FROM b WHERE CAST(t - caps AS DOUBLE) / CAST(ws - weights AS DOUBLE) <= ratio),
g AS (SELECT source, source_size, least(coalesce(level, 0) * weight, CAST(cap AS DOUBLE)) AS target,
  CAST(('0x' || substr(md5('mix:' || coalesce(source, chr(0) || 'null')), 1, 12)) AS BIGINT) / 281474976710656.0 AS u FROM b, l),
x AS (SELECT doc_id, d.source, size, source_size, target, u, row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id NULLS FIRST) AS k,
  coalesce(target / nullif(source_size, 0), 0) AS e FROM d JOIN g ON g.source IS NOT DISTINCT FROM d.source),
c AS (SELECT *, CAST(least(floor(e * k + u) - floor(e * (k - 1) + u), 3) AS BIGINT) AS copies FROM x)
SELECT doc_id, source, size, source_size, target, copies, copies * size AS taken FROM c
""")
def op3_mixing(spark, sf_dir):
    """Systematic sampling of all documents towards their sources' targets."""
    from .mixing import report
    return report(table(spark, sf_dir, "documents"))


@query("op5_packing")
def op5_packing(spark, sf_dir):
    """All documents as token pieces packed into sequences of 1024."""
    from .packing import pack, pieces
    return pack(pieces(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json")))


@query("op9_tokens")
def op9_tokens(spark, sf_dir):
    """All documents' token ids written to files and reported from them."""
    from .tokenfile import round_trip
    return round_trip(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@query("op7_warc", oracle="""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, upper(sha1(coalesce(html, ''))) AS hex FROM pages),
f AS (SELECT hex, min(page_id) AS first FROM p GROUP BY 1),
b AS (SELECT hex, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(substr(bits, 5 * i + 1, 5) AS BIT)::INT, 1) FOR i IN range(32)], '') AS b32
  FROM (SELECT hex, array_to_string([substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * (instr('0123456789ABCDEF', substr(hex, j, 1)) - 1) + 1, 4) FOR j IN range(1, 41)], '') AS bits FROM f))
SELECT page_id, payload_bytes, b32 AS payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to
FROM p JOIN f USING (hex) JOIN b USING (hex)
""")
def op7_warc(spark, sf_dir):
    """All pages written as WARC archives and reported from them."""
    from .warc import round_trip
    return round_trip(table(spark, sf_dir, "pages")).drop("url")


@query("op8_maintext")
def op8_maintext(spark, sf_dir):
    """Main text of all pages."""
    from .maintext import extract
    return extract(table(spark, sf_dir, "pages"))


@query("op1_gridjoin", oracle="""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
n AS (SELECT a, count(*) AS n FROM l GROUP BY 1),
reach AS (WITH RECURSIVE r(x, y) AS (SELECT a, b FROM l UNION SELECT r.x, l.b FROM r JOIN l ON l.a = r.y) SELECT x, min(y) AS m FROM r GROUP BY 1)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN reach ON reach.x = vec_id
""")
def op1_gridjoin(spark, sf_dir):
    """Vectors within cosine 0.9 of each other, and their components, over all embeddings."""
    from .gridjoin import near_vectors
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query("op6_licences", oracle="""
WITH f AS (SELECT doc_id, coalesce(source, '') || '/' || coalesce(lang, '') || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path, coalesce(text, '') AS text FROM documents),
t AS (SELECT licence, unnest(regexp_extract_all(lower(body), '[a-z0-9]+')) AS term FROM (VALUES
  ('Apache-2.0', 'Licensed under the Apache License, Version 2.0.'),
  ('BSD-3-Clause', 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met'),
  ('CC-BY-4.0', 'This work is licensed under a Creative Commons Attribution 4.0 International License.'),
  ('CC-BY-NC-4.0', 'Licensed under CC BY-NC 4.0.'),
  ('GPL-3.0', 'This work is licensed under the GNU General Public License, version 3.'),
  ('MIT', 'Released under the MIT License.'),
  ('MPL-2.0', 'This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.'),
  ('Unlicense', 'This is free and unencumbered software released into the public domain.')) x(licence, body)),
tf AS (SELECT licence, term, count(*) AS tf FROM t GROUP BY 1, 2),
n AS (SELECT count(*) AS n FROM f),
words AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+') AS ws FROM f),
seen AS (SELECT term, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest(ws) AS term FROM words) WHERE term IN (SELECT term FROM tf) GROUP BY 1),
idf AS (SELECT term, ln((1.0 + n) / (1.0 + coalesce(df, 0))) AS idf FROM (SELECT DISTINCT term FROM tf) LEFT JOIN seen USING (term), n),
w AS (SELECT licence, term, tf * idf AS w FROM tf JOIN idf USING (term)),
goal AS (SELECT licence, term, w / norm AS g FROM w JOIN (SELECT licence, sqrt(sum(w * w)) AS norm FROM w GROUP BY 1) USING (licence)),
split AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS body, generate_subscripts(string_split(text, chr(10)), 1) AS line FROM f),
lines AS (SELECT doc_id, line, regexp_extract_all(low, '[a-z0-9]+') AS ws FROM (SELECT *, translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM split)
  WHERE regexp_matches(low, 'licen[cs]|redistribution|copyright|spdx|public domain')),
c AS (SELECT doc_id, line, term, count(*) AS tf FROM (SELECT doc_id, line, unnest(ws) AS term FROM lines) GROUP BY 1, 2, 3),
x AS (SELECT doc_id, line, term, tf * coalesce(idf, ln((1.0 + n) / 2.0)) AS w FROM c LEFT JOIN idf USING (term), n),
norms AS (SELECT doc_id, line, sqrt(sum(w * w)) AS norm FROM x GROUP BY 1, 2),
dots AS (SELECT doc_id, line, licence, sum(w * g) AS dot FROM x JOIN goal USING (term) GROUP BY 1, 2, 3),
close AS (SELECT doc_id, line, licence, round(dot / nullif(norm, 0), 6) AS cosine FROM dots JOIN norms USING (doc_id, line)),
hit AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY cosine DESC, licence) AS k FROM close WHERE cosine >= 0.7),
own AS (SELECT doc_id, arg_min(licence, (-cosine, licence)) AS own, max(cosine) AS cosine, sum(len(ws)) AS matched FROM hit JOIN lines USING (doc_id, line) WHERE k = 1 GROUP BY 1),
j AS (SELECT f.doc_id, path, regexp_replace(path, '/[^/]*$', '') AS dir, len(ws) AS n_terms, own, cosine, matched FROM f JOIN words USING (doc_id) LEFT JOIN own USING (doc_id)),
speaks AS (SELECT dir, min(own) AS theirs FROM j WHERE own IS NOT NULL AND 2 * matched >= n_terms GROUP BY 1),
up AS (SELECT DISTINCT dir, dir AS above, 2 AS depth FROM j UNION SELECT DISTINCT dir, string_split(dir, '/')[1], 1 FROM j),
near AS (SELECT up.dir, arg_max(theirs, depth) AS theirs, arg_max(above, depth) AS above FROM up JOIN speaks ON speaks.dir = above GROUP BY 1)
SELECT doc_id, path, coalesce(own, theirs) AS licence, cosine, CASE WHEN own IS NOT NULL THEN 'header' WHEN theirs IS NOT NULL THEN 'directory' ELSE 'none' END AS origin,
  CASE WHEN own IS NULL THEN above END AS inherited_from
FROM j LEFT JOIN near USING (dir)
""")
def op6_licences(spark, sf_dir):
    """Licence of every document, its path being source/lang/doc_id.txt."""
    from pyspark.sql import functions as F

    from .licences import scan
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return scan(docs.select(F.col("doc_id").alias("key"), path.alias("path"), "text")).withColumnRenamed("key", "doc_id")


@query("op11_ring")
def op11_ring(spark, sf_dir):
    """All documents in 40 shards of equally many rows, by a ring with bounded loads."""
    from .sharding import report
    return report(table(spark, sf_dir, "documents"))


@query("op12_hardneg", oracle="""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(256 * x) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r, a.vec_id AS anchor_id, b.r AS br, b.vec_id AS other_id, a.label = b.label AS same,
  CAST(list_inner_product(CAST(a.e AS DOUBLE[]), CAST(b.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
p AS (SELECT r, anchor_id, other_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY r ORDER BY score DESC, other_id) AS positive_rank FROM s WHERE same),
n AS (SELECT p.anchor_id, positive_id, positive_rank, other_id AS negative_id, positive_score, s.score AS negative_score,
  row_number() OVER (PARTITION BY p.r, positive_rank ORDER BY s.score DESC, other_id) AS rank
  FROM p JOIN s ON s.r = p.r AND NOT same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score WHERE positive_rank <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INT) AS rank, negative_id, positive_score, negative_score, CAST(positive_rank AS INT) AS positive_rank FROM n WHERE rank <= 3
""")
def op12_hardneg(spark, sf_dir):
    """Hard negatives of every anchor and positive, over all embeddings."""
    from .hardneg import mine
    return mine(table(spark, sf_dir, "embeddings"))


@query("op13_lexical", oracle="""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
d AS (SELECT r, doc_id, ws, CAST(len(ws) AS BIGINT) AS n FROM t WHERE len(ws) > 0),
c AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(n) AS BIGINT) AS l FROM d),
i AS (SELECT row_number() OVER () AS k, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS terms FROM benchmark),
q AS (SELECT k, item_id, unnest(terms) AS term FROM i),
f AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(ws) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY 1, 2),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM f, c GROUP BY term, nn),
p AS (SELECT f.r, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * nn) // l))) AS part FROM f JOIN w USING (term) JOIN d ON d.r = f.r, c),
s AS (SELECT k, item_id, r, CAST(sum(part) AS BIGINT) AS score FROM q JOIN p USING (term) GROUP BY 1, 2, 3)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (SELECT k, item_id, doc_id, score, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id) AS rank FROM s JOIN d USING (r) WHERE score > 0) WHERE rank <= 50
""")
def op13_lexical(spark, sf_dir):
    """The 50 best documents of every benchmark item, over all documents."""
    from .lexrank import search
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
