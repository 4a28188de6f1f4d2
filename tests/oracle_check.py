"""Run registered queries against their DuckDB oracle the way the driver does.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 9)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = []
    for rec in df[cols].astype(object).itertuples(index=False):
        rows.append(tuple(_norm(None if (not isinstance(x, (list, tuple)) and pd.isna(x)) else x) for x in rec))
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark, sf_dir: str, names: list[str] | None = None) -> dict[str, dict]:
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        rec = {"has_oracle": name in sqls}
        try:
            t = time.time()
            sdf = qs[name](spark, sf_dir).toPandas()
            rec["spark_s"] = round(time.time() - t, 2)
            rec["rows"] = len(sdf)
            if name in sqls:
                t = time.time()
                odf = con.execute(sqls[name]).df()
                rec["duck_s"] = round(time.time() - t, 2)
                rec["oracle_rows"] = len(odf)
                rec["schema"] = sorted(sdf.columns) == sorted(odf.columns)
                if rec["schema"]:
                    a, b = canon(sdf), canon(odf)
                    rec["values"] = a == b
                    if not rec["values"]:
                        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
                        rec["example"] = str(diff)[:600]
                else:
                    rec["cols"] = (sorted(sdf.columns), sorted(odf.columns))
        except Exception as exc:  # noqa: BLE001
            rec["error"] = repr(exc)[:800]
        out[name] = rec
        print(name, rec, flush=True)
    return out


if __name__ == "__main__":
    from barspark.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session()
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v.get("has_oracle") and not v.get("values")]
    print("MISMATCH/ERROR:", bad)
