"""Compare registered Spark queries with their DuckDB oracle SQL.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
Prints one line per key: OK / MISMATCH with row counts and a diff sample.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "isoformat"):
        import pandas as pd
        return pd.Timestamp(v).isoformat()
    try:
        import pandas as pd
        if v is pd.NA or v is pd.NaT:
            return None
    except Exception:
        pass
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, sf_dir: str, keys: list[str] | None = None) -> dict[str, str]:
    import __spark_entry__ as ent

    qs, sqls = ent.queries(), ent.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in keys or list(qs):
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            results[k] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(k, results[k], flush=True)
            continue
        t1 = time.time()
        if k not in sqls:
            results[k] = f"NO ORACLE rows={len(sdf)}"
            print(k, results[k], flush=True)
            continue
        try:
            ddf = con.sql(sqls[k]).df()
        except Exception as e:  # noqa: BLE001
            results[k] = f"DUCK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(k, results[k], flush=True)
            continue
        sc, sr = rows_of(sdf)
        dc, dr = rows_of(ddf)
        if sc != dc:
            results[k] = f"COLUMNS spark={sc} duck={dc}"
        elif len(sr) != len(dr):
            results[k] = f"ROWCOUNT spark={len(sr)} duck={len(dr)}"
        elif sr != dr:
            diff = [(a, b) for a, b in zip(sr, dr) if a != b][:2]
            results[k] = f"VALUES rows={len(sr)} first diffs={diff}"
        else:
            results[k] = f"OK rows={len(sr)} spark={t1 - t0:.1f}s"
        print(k, results[k], flush=True)
    return results


if __name__ == "__main__":
    from ordermart.config import build_local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = build_local_session(8)
    res = compare(spark, sf, keys)
    bad = [k for k, v in res.items() if not v.startswith("OK")]
    print(f"\n{len(res) - len(bad)}/{len(res)} OK; not OK: {bad}")
