"""Compare a registered Spark query with its DuckDB SQL: row count, column names and an
order-insensitive hash of the values (columns sorted by name)."""

from __future__ import annotations

import hashlib
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6) + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[list[str], str, list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return cols, hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def compare(spark, name: str, fn, sql: str | None, data_dir: str, con=None, verbose: bool = False) -> dict:
    t0 = time.time()
    sdf = fn(spark, data_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"query": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["check"] = "rows-only"
        return res
    con = con or duck(data_dir)
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    scols, sh, sl = digest(sdf.columns, srows)
    dc, dh, dl = digest(dcols, drows)
    res.update({"duck_rows": len(drows), "cols_match": scols == dc, "hash_match": sh == dh})
    res["ok"] = res["cols_match"] and res["hash_match"] and len(srows) == len(drows)
    if verbose and not res["ok"]:
        res["spark_cols"], res["duck_cols"] = scols, dc
        a, b = set(sl), set(dl)
        res["only_spark"] = sorted(a - b)[:5]
        res["only_duck"] = sorted(b - a)[:5]
    return res


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from leadlens.session import local_session

    data_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = local_session(8)
    con = duck(data_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for n, f in qs.items():
        if only and n not in only:
            continue
        try:
            r = compare(spark, n, f, sqls.get(n), data_dir, con, verbose=True)
        except Exception as e:  # report and continue
            r = {"query": n, "ok": False, "error": repr(e)[:800]}
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print("FAILED", bad)
