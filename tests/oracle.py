"""Compares a registered query with its SQL twin in DuckDB."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if hasattr(v, "as_tuple"):
        return float(f"{float(v):.9g}")
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is not None, str(type(x).__name__ in ("str",)), str(x)) for x in row)


def compare(spark_df, con, sql) -> list[str]:
    cols = sorted(spark_df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in spark_df.collect()), key=_key)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != cols:
        return [f"columns differ: {cols} / {sorted(names)}"]
    at = [names.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in at) for r in result.fetchall()), key=_key)
    faults = []
    if len(got) != len(want):
        faults.append(f"rows {len(got)} / {len(want)}")
    if not want:
        faults.append("both sides are empty" if not got else "SQL gives no row")
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            bad = [(c, a, b) for c, a, b in zip(cols, g, w) if a != b or type(a) is not type(b)]
            faults.append(f"{bad[:4]}")
            if len(faults) > 3:
                break
    return faults


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from riskweave.session import local_session

    sf = sys.argv[1]
    names = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = duck(sf), entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        started = time.time()
        try:
            df = fn(spark, sf)
            if name in sqls:
                faults = compare(df, con, sqls[name])
            else:
                n = df.count()
                faults = [] if n else ["no rows"]
                name += f" (rows only: {n})"
        except Exception as e:  # report and go on with the next query
            faults = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(faults)
        print(f"{'FAIL' if faults else 'ok  '} {name} {time.time() - started:.1f}s", *faults, sep="\n     " if faults else "", flush=True)
    print("failed:", bad)
