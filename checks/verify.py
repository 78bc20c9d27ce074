"""Run registered queries against their SQL twins: python -m checks.verify [sf] [prefix ...]"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

from checks import load
from tidewell.session import local_session


def canon(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        s = df[c]
        if str(s.dtype).startswith("datetime"):
            df[c] = s.astype("datetime64[us]").astype(str)
        elif s.dtype == object and s.map(lambda x: isinstance(x, (pd.Timestamp,))).any():
            df[c] = pd.to_datetime(s).astype("datetime64[us]").astype(str)
        elif pd.api.types.is_numeric_dtype(s) and not pd.api.types.is_bool_dtype(s):
            df[c] = s.astype(float).round(6) + 0.0
            df[c] = df[c].map(lambda x: "" if pd.isna(x) else repr(float(x)))
        else:
            df[c] = s.map(lambda x: "" if x is None or (not isinstance(x, (list, np.ndarray)) and pd.isna(x)) else str(x))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def main(sf: str, wanted: list[str]) -> int:
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    qs, sql = load()
    bad = 0
    for name, fn in qs.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t = time.time()
        try:
            got = fn(spark, sf).toPandas()
        except Exception as e:
            bad += 1
            print(f"FAIL {name}: {type(e).__name__} {str(e)[:600]}", flush=True)
            continue
        t = time.time() - t
        if name not in sql:
            print(f"rows {name}: {len(got)} ({t:.1f}s)", flush=True)
            continue
        try:
            want = con.execute(sql[name]).df()
        except Exception as e:
            bad += 1
            print(f"SQL  {name}: {str(e)[:500]}", flush=True)
            continue
        if sorted(got.columns) != sorted(want.columns):
            bad += 1
            print(f"COLS {name}: {sorted(got.columns)} {sorted(want.columns)}", flush=True)
            continue
        a, b = canon(got), canon(want)
        if a.equals(b):
            types = {c: (str(got[c].dtype), str(want[c].dtype)) for c in got.columns if str(got[c].dtype) != str(want[c].dtype)}
            print(f"ok   {name}: {len(a)} ({t:.1f}s) {types or ''}", flush=True)
            if len(a) == 0:
                print(f"     EMPTY {name}", flush=True)
        else:
            bad += 1
            print(f"DIFF {name}: rows {len(a)} {len(b)} ({t:.1f}s)", flush=True)
            m = a.merge(b, how="outer", indicator=True)
            print(m[m._merge != "both"].head(8).to_string(), flush=True)
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    base = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    sys.exit(1 if main(base, args) else 0)
