"""Licence scans: TF-IDF cosine of licence lines to templates, and inheritance down directories (operator 6).

Every line of every whole text that names a licence term is a candidate
header; its sparse TF-IDF vector is compared with the templates'.  Document
frequencies of all terms of candidate lines and templates are counted over all
documents.  A file's own licence is the
template of the best line at or above the threshold.  A licence file (by its
name, or because at least half of its words lie in matching lines) also
speaks for its directory, and a file without a licence of its own takes that
of the nearest directory above it which has one.

All joins are between the terms of candidate lines and their frequencies (read
back, so that Spark can split a hot term), with tables bounded by the templates'
vocabulary, or between directories: each distinct directory is resolved once,
and files then join their directory.

Defined results: a null text has no licence of its own; a null path has no
directory and inherits nothing; ties go to the template first in name order;
a directory with several licence files takes the smallest name; repeated rows
are judged each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

# Notices that stand at the head of files, by licence.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
THRESHOLD = 0.7
TERM = "[a-z0-9]+"
#: A candidate line names one of these.
CANDIDATE = "licen[cs]|redistribution|copyright|spdx|public domain"
FILE_NAME = "^(licen[cs]e|copying|unlicense)([.-].*)?$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _terms(text):
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(TERM), 0)


def scan(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(path, licence, cosine, origin, inherited_from) for every row of (path, text, key); ``key`` identifies rows."""
    spark = files.sparkSession
    templates = spark.createDataFrame(list(TEMPLATES), "licence string, body string").withColumn("term", F.explode(_terms("body"))).groupBy("licence", "term").agg(F.count("*").alias("tf"))
    mine = files.select("key", "path", F.coalesce("text", F.lit("")).alias("text"))
    lines = mine.select("key", F.posexplode(F.split("text", "\n")).alias("line", "body")).where(F.translate("body", _UPPER, _LOWER).rlike(CANDIDATE))
    lines = common.cut(lines.select("key", "line", _terms("body").alias("terms")), "lines")
    counts = common.cut(lines.select("key", "line", F.explode("terms").alias("term")).groupBy("key", "line", "term").agg(F.count("*").alias("tf")), "counts")

    seen = mine.select(F.explode(F.array_distinct(_terms("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    n = files.count()
    terms = counts.select("term").union(templates.select("term")).distinct()
    idf = common.cut(terms.join(seen, "term", "left").select("term", F.log((1.0 + n) / (1.0 + F.coalesce("df", F.lit(0)))).alias("idf")), "idf")

    goal = templates.join(idf, "term").select("licence", "term", (F.col("tf") * F.col("idf")).alias("w"))
    goal = goal.join(goal.groupBy("licence").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm")), "licence").select("licence", "term", F.try_divide("w", "norm").alias("w"))
    goal = common.cut(goal, "templates")  # as many rows as the templates have terms: bounded, so it may be broadcast
    weights = common.cut(counts.join(idf, "term").select("key", "line", "term", (F.col("tf") * F.col("idf")).alias("w")), "weights")
    norms = weights.groupBy("key", "line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weights.join(F.broadcast(goal.select("licence", "term", F.col("w").alias("g"))), "term").groupBy("key", "line", "licence").agg(F.sum(F.col("w") * F.col("g")).alias("dot"))
    close = dots.join(norms, ["key", "line"]).select("key", "line", "licence", F.round(F.try_divide("dot", "norm"), 6).alias("cosine")).where(F.col("cosine") >= threshold)
    words = lines.select("key", "line", F.size("terms").alias("n"))
    best = close.groupBy("key", "line").agg(F.min(F.struct((-F.col("cosine")).alias("less"), "licence")).alias("best"))
    hit = best.select("key", "line", (-F.col("best.less")).alias("top"), F.col("best.licence").alias("licence"))
    own = hit.join(words, ["key", "line"]).groupBy("key").agg(F.min(F.struct((-F.col("top")).alias("less"), "licence")).alias("best"), F.sum("n").alias("matched"))
    own = own.select("key", F.col("best.licence").alias("own"), (-F.col("best.less")).alias("cosine"), "matched")

    parts = F.split("path", "/")
    base = F.translate(F.element_at(parts, -1), _UPPER, _LOWER)
    judged = mine.select("key", "path", F.size(_terms("text")).alias("n_terms"), base.rlike(FILE_NAME).alias("named"),
                         F.when(F.col("path").isNotNull(), F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/")).alias("dir")).join(own, "key", "left")
    judged = common.cut(judged, "judged")
    speaks = judged.where(F.col("own").isNotNull() & F.col("dir").isNotNull() & (F.coalesce("named", F.lit(False)) | (2 * F.col("matched") >= F.col("n_terms"))))
    speaks = speaks.groupBy("dir").agg(F.min("own").alias("theirs")).withColumnRenamed("dir", "above")
    dirs = judged.where(F.col("dir").isNotNull()).select("dir").distinct()
    steps = F.split("dir", "/")
    above = dirs.select("dir", F.explode(F.sequence(F.lit(0), F.size(steps))).alias("depth")).withColumn("above", F.when(F.col("depth") == 0, F.lit("")).otherwise(F.array_join(F.slice(steps, 1, F.col("depth")), "/")))
    # read back, so that both sides of the join are plain and Spark can split a hot directory
    nearest = common.cut(above.join(speaks, "above").groupBy("dir").agg(F.max_by(F.struct("theirs", "above"), "depth").alias("got")), "nearest")
    out = judged.join(nearest, "dir", "left")
    taken = F.col("own").isNull() & F.col("got").isNotNull()
    return out.select("key", "path", F.coalesce("own", F.col("got.theirs")).alias("licence"), "cosine",
                      F.when(F.col("own").isNotNull(), "header").when(taken, "directory").otherwise("none").alias("origin"), F.when(taken, F.col("got.above")).alias("inherited_from"))
