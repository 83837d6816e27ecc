"""Run registered queries in Spark and their DuckDB text; compare as multisets.

    python -m streamguard.plans.check /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _canon(v.item())
    return v


def _rows(records, cols):
    out = []
    for r in records:
        out.append(tuple(_canon(r[c]) for c in cols))
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, sf_dir: str, name: str) -> dict:
    from .registry import QUERIES
    q = QUERIES[name]
    t0 = time.time()
    sdf = q.build(spark, sf_dir)
    srows = [r.asDict() for r in sdf.collect()]
    t_spark = time.time() - t0
    scols = sorted(sdf.columns)
    res = {"name": name, "ref": q.ref, "rows": len(srows), "spark_sec": round(t_spark, 2)}
    if q.oracle is None:
        res["status"] = "no-oracle"
        return res
    rel = con.sql(q.oracle)
    ocols = sorted(rel.columns)
    orows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    if scols != ocols:
        res["status"] = f"COLUMNS spark={scols} oracle={ocols}"
        return res
    if len(srows) != len(orows):
        res["status"] = f"ROWCOUNT spark={len(srows)} oracle={len(orows)}"
        return res
    a, b = _rows(srows, scols), _rows(orows, ocols)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        res["status"] = f"VALUES {diff}"
        return res
    res["status"] = "ok"
    return res


def main(argv):
    from . import catalog  # noqa: F401  (registers queries)
    from ..session import local_session
    from .registry import QUERIES
    sf_dir = argv[0]
    names = argv[1:] or list(QUERIES)
    spark = local_session()
    con = duckdb_connection(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, sf_dir, n)
        except Exception as e:  # report and go on
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("ok", "no-oracle"):
            bad += 1
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} fine")


if __name__ == "__main__":
    main(sys.argv[1:])
