"""Correlations from Gram matrices and the whole-column description, against pandas."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from streamguard.operators import gram
from streamguard.operators import stats as ST


def _frame(n=4_000, seed=3):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=n)
    x = pd.DataFrame({
        "a": a, "far": 1.7e9 + a + rng.normal(size=n), "huge": 1e180 * (a + rng.normal(size=n)),
        "gaps": np.where(rng.random(n) < 0.4, np.nan, a ** 2), "other": np.where(rng.random(n) < 0.3, np.nan, a),
        "same": np.full(n, 0.1), "none": np.full(n, np.nan), "few": [np.nan] * (n - 1) + [2.0],
        "attack": (rng.random(n) < 0.2).astype(int)})
    # constant where gaps has a value, not elsewhere
    x["masked"] = np.where(x["gaps"].isna(), a, 7.3)
    return x


FEATURES = ["a", "far", "huge", "gaps", "other", "same", "none", "few", "masked"]


def _expected(x, cols):
    out = {}
    for i, p in enumerate(cols):
        for q in cols[i + 1:]:
            b = x[[p, q]].dropna()
            constant = len(b) < 2 or b[p].nunique() < 2 or b[q].nunique() < 2
            s = 1e180 if "huge" in (p, q) else 1.0
            u, v = b[p] / (s if p == "huge" else 1), b[q] / (s if q == "huge" else 1)
            out[p, q] = (len(b), None if constant else float(np.corrcoef(u, v)[0, 1]))
    return out


def _same(got, want):
    assert set(got) == set(want)
    for k, (n, c) in want.items():
        assert got[k][0] == n, k
        assert (c is None) == (got[k][1] is None), (k, c, got[k])
        assert c is None or abs(c - got[k][1]) < 1e-9, (k, c, got[k])


def test_correlations_of_complete_pairs(spark):
    x = _frame()
    df = spark.createDataFrame(x).repartition(5)  # NaN stands for missing here
    got = {(r.fa, r.fb): (r.n, r["corr"]) for r in gram.correlations(df, FEATURES).collect()}
    _same(got, _expected(x, FEATURES))


def test_correlations_by_group_with_a_null_group(spark):
    x = _frame()
    df = spark.createDataFrame(x).withColumn("g", F.when(F.col("attack") == 1, "x"))
    rows = gram.correlations(df, FEATURES, ["g"]).collect()
    for key, part in (("x", x[x.attack == 1]), (None, x[x.attack == 0])):
        _same({(r.fa, r.fb): (r.n, r["corr"]) for r in rows if r.g == key}, _expected(part, FEATURES))


def test_correlations_pass_over_infinite_values_and_empty_tables(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (float("inf"), 1.0), (3.0, float("-inf")), (None, 5.0)],
                               "p double, q double")
    r = gram.correlations(df, ["p", "q"]).collect()
    assert [(x.fa, x.fb, x.n) for x in r] == [("p", "q", 2)] and abs(r[0]["corr"] - 1.0) < 1e-12
    assert gram.correlations(df.filter("p > 100 and p < 101"), ["p", "q"]).collect() == []


def test_corr_delta_fills_medians_by_label(spark):
    x = _frame()
    mats = {}
    for lab in (0, 1):
        sub = x[x.attack == lab][FEATURES]
        sub = sub.dropna(axis=1, thresh=int(0.5 * len(sub)))
        # pandas loses digits of large offsets; the subtraction is exact
        sub = sub.drop(columns="huge").assign(far=sub["far"] - 1.7e9)
        mats[lab] = sub.fillna(sub.median()).corr().clip(-1, 1)
    got = {(r.feature_a, r.feature_b): r.corr_delta
           for r in ST.corr_delta(spark.createDataFrame(x), FEATURES).collect() if "huge" not in (r[0], r[1])}
    cols = [c for c in mats[0].columns if c != "same"]
    want = {(p, q): mats[1].loc[p, q] - mats[0].loc[p, q] for i, p in enumerate(cols) for q in cols[i + 1:]}
    assert set(got) == set(want) and {"none", "few"}.isdisjoint(cols)
    assert {k: (got[k], want[k]) for k in want if not abs(got[k] - want[k]) < 1e-9} == {}


def test_describe_text_top_ties_and_nulls(spark):
    rows = [("b", 1, None), ("a", 2, None), ("b", 2, None), ("a", 1, None), (None, 3, None), ("", 4, None)]
    got = {r[0]: tuple(r)[1:] for r in ST.describe_text(
        spark.createDataFrame(rows, "t string, n int, e string"), ["t", "n", "e"]).collect()}
    assert got == {"t": (5, 3, "a", 2), "n": (6, 4, "1", 2), "e": (0, 0, None, None)}


def test_describe_text_of_a_column_of_unique_values(spark):
    df = spark.range(50_000).select(F.col("id").cast("string").alias("u"), F.lit("k").alias("k"))
    got = {r[0]: tuple(r)[1:] for r in ST.describe_text(df, ["u", "k"]).collect()}
    assert got == {"u": (50_000, 50_000, "0", 1), "k": (50_000, 1, "k", 50_000)}


def test_variances_ask_for_nothing_else(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (3.0, 2.0, None), (None, 2.0, None)], "a double, b double, c double")
    asked = []

    class Watched:
        def agg(self, *cols):
            asked.extend(cols)
            return df.agg(*cols)
    assert ST.variances(Watched(), ["a", "b", "c"]) == {"a": 2.0, "b": 0.0, "c": None}
    assert len(asked) == 6
    assert ST.variances(df, []) == {}


def test_wide_stages_stay_within_methods_that_the_jvm_compiles(spark):
    from streamguard.operators.prepare import Prepared
    from streamguard.session import prepare
    prepare(spark)
    names = [f"x{i}" for i in range(41)]
    df = spark.range(64).select("id", *[(F.col("id") * (i + 3) % 101).cast("double").alias(c) for i, c in enumerate(names)])
    out = Prepared.fit(df, names).transform(df)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000  # HotSpot's own limit
    rows = out.collect()
    assert len(rows) == 64 and all(abs(sum(r[c] for r in rows)) < 1e-9 for c in names)
