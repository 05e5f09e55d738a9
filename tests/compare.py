"""Run a query on Spark and its SQL twin on DuckDB and compare all rows.

``python -m tests.compare [sf_dir] [name-prefix ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb

from surelake.plans.views import TABLES


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def canon(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, float):
        return "nan" if v != v else float(v)
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v))
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    return v


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(canon(r[i]) for i in order) for r in data]
    return [cols[i] for i in order], sorted(out, key=repr)


def compare(spark_df, con, sql) -> str | None:
    """None when equal, else a short description of the difference."""
    rel = con.sql(sql)
    d_cols, d_rows = rows(list(rel.columns), rel.fetchall())
    s_cols, s_rows = rows(list(spark_df.columns), [tuple(r) for r in spark_df.collect()])
    if s_cols != d_cols:
        return f"columns {s_cols} vs {d_cols}"
    if len(s_rows) != len(d_rows):
        diff = list((set(s_rows) ^ set(d_rows)))[:4]
        return f"rows {len(s_rows)} vs {len(d_rows)}: {diff}"
    if s_rows != d_rows:
        a, b = set(s_rows), set(d_rows)
        return f"{len(a - b)} of {len(s_rows)} rows differ: spark {sorted(a - b, key=repr)[:3]} duck {sorted(b - a, key=repr)[:3]}"
    types = {type(x).__name__ for r in s_rows[:200] for x in r if isinstance(x, tuple) and x[:1] == ("dec",)}
    if types:
        return "decimal column in output (cast to double)"
    if not s_rows:
        return "EMPTY result"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from surelake import session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = session.build("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    qs, os_ = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, q in qs.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        t = time.time()
        try:
            df = q(spark, folder)
            if name in os_:
                diff = compare(df, con, os_[name])
                msg = "ok" if diff is None else f"DIFF {diff}"
                if diff:
                    bad += 1
            else:
                msg = f"rows-only {len(df.collect())}"
        except Exception as e:  # noqa: BLE001
            bad += 1
            msg = f"ERROR {type(e).__name__} {str(e)[:600]}"
        print(f"{name:32s} {time.time() - t:6.2f}s {msg}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
