"""Run every registered query against its DuckDB statement (like the
driver's correctness gate): row count, column names, order-insensitive
values. Usage: python tests/oracle_check.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

EXACT = os.environ.get("ORACLE_EXACT") == "1"

SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "boolean": "BOOLEAN"}

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, repr(v) if EXACT else f"{v:.12g}")
    if isinstance(v, bool):
        return (3, str(v))
    if isinstance(v, int):
        return (2, repr(float(v)) if EXACT else f"{float(v):.12g}") if abs(v) < 2**53 else (4, str(v))
    return (5, str(v))


def rows_of(records, cols):
    return sorted(tuple(_norm(r[c]) for c in cols) for r in records)


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, names=None) -> dict[str, dict]:
    import __spark_entry__ as E

    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or sql:
        t0 = time.time()
        sdf = qs[name](spark, sf_dir)
        s_cols = sorted(sdf.columns)
        s_rows = [r.asDict() for r in sdf.collect()]
        t1 = time.time()
        res = con.sql(sql[name])
        s_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in sdf.schema.fields}
        d_types = dict(zip(res.columns, map(str, res.types)))
        d_cols = sorted(res.columns)
        d_rows = [dict(zip(res.columns, r)) for r in res.fetchall()]
        ok_cols = s_cols == d_cols
        ok_n = len(s_rows) == len(d_rows)
        ok_v = ok_cols and rows_of(s_rows, s_cols) == rows_of(d_rows, d_cols)
        out[name] = dict(cols=ok_cols, rows=ok_n, values=ok_v, types=s_types == d_types, n=len(s_rows),
                         n_oracle=len(d_rows), spark_s=round(t1 - t0, 2))
        if s_types != d_types:
            out[name]["type_diff"] = {c: (s_types.get(c), d_types.get(c)) for c in s_types
                                      if s_types.get(c) != d_types.get(c)}
        if not ok_cols:
            out[name]["col_diff"] = (s_cols, d_cols)
        elif not ok_v:
            a, b = rows_of(s_rows, s_cols), rows_of(d_rows, d_cols)
            sa, sb = set(a), set(b)
            out[name]["only_spark"] = [x for x in a if x not in sb][:3]
            out[name]["only_oracle"] = [x for x in b if x not in sa][:3]
    return out


if __name__ == "__main__":
    from tunestats.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = local_session(8)
    res = compare(spark, sf, names)
    bad = 0
    for k, v in res.items():
        flag = "OK " if v["values"] and v["rows"] and v["types"] else "BAD"
        bad += flag == "BAD"
        print(flag, k, {x: y for x, y in v.items() if x not in ("cols", "rows", "values", "types")})
    print(f"{len(res) - bad}/{len(res)} match")
