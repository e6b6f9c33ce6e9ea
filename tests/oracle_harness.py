"""Run each registered Spark query and its DuckDB oracle, compare results.

Comparison: column names (sorted), row count, and the multiset of rows with
values normalised (floats exact, times as ISO text). Usable from pytest and
as a script: ``python tests/oracle_harness.py /root/testdata/sf0.01 [names]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(float(v))
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item") and not isinstance(v, (list, tuple)):
        return _norm(v.item())
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return str(v)


def rows_of(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda t: tuple((x is None, str(x)) for x in t))
    return cols, out


def compare(spark, sf_dir: str, name: str, query, sql: str, con) -> dict:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    t2 = time.time()
    sc, sr = rows_of(list(sdf.columns), srows)
    dc, dr = rows_of(dcols, drows)
    res = {"name": name, "spark_rows": len(sr), "oracle_rows": len(dr),
           "schema": sc == dc, "rows": len(sr) == len(dr), "values": sc == dc and sr == dr,
           "spark_s": round(t1 - t0, 2), "oracle_s": round(t2 - t1, 2)}
    if not res["values"]:
        if sc != dc:
            res["detail"] = f"columns spark={sc} oracle={dc}"
        else:
            diff_s = [r for r in sr if r not in set(dr)][:3]
            diff_d = [r for r in dr if r not in set(sr)][:3]
            res["detail"] = f"spark-only={diff_s} oracle-only={diff_d}"
    return res


def main(argv):
    from tessera.session import local_session
    import __spark_entry__ as entry
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = local_session()
    con = duck_connection(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            print(f"{name:24s} (no oracle)")
            continue
        try:
            r = compare(spark, sf_dir, name, fn, sqls[name], con)
        except Exception as e:  # report and continue
            bad += 1
            print(f"{name:24s} ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        ok = r["values"]
        bad += not ok
        print(f"{name:24s} {'OK ' if ok else 'BAD'} rows={r['spark_rows']}/{r['oracle_rows']} "
              f"spark={r['spark_s']}s duck={r['oracle_s']}s {r.get('detail', '')[:600]}")
    print(f"mismatches: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
