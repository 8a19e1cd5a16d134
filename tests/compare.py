"""Run a query and its SQL twin side by side and compare whole results."""

from __future__ import annotations

import decimal
import sys
import time

import duckdb

from agentlake.plans.views import TABLES


def _norm(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, (int, decimal.Decimal, float)):
        return round(float(v), 6)
    return str(v)


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=repr)


def compare(con, df, sql: str):
    """None when equal, else a short text."""
    left_cols, left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    right_cols, right = rows_of(cols, res.fetchall())
    if left_cols != right_cols:
        return f"columns {left_cols} vs {right_cols}"
    if len(left) != len(right):
        return f"rows {len(left)} vs {len(right)}; e.g. {[x for x in left if x not in set(right)][:2]} vs {[x for x in right if x not in set(left)][:2]}"
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(bad)} of {len(left)} differ, e.g. {bad[0]}" if bad else None


def main(argv):
    from agentlake.plans import load_all
    from agentlake.plans.registry import QUERIES, TWINS, as_entry, full_twin
    from agentlake.session import local_session

    load_all()
    sf = argv[0]
    names = [n for n in QUERIES if not argv[1:] or any(n.startswith(p) for p in argv[1:])]
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = duck(sf_dir)
    for n in names:
        t = time.time()
        try:
            df = as_entry(n)(spark, sf_dir)
            if n in TWINS:
                msg = compare(con, df, full_twin(n))
            else:
                msg = f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            msg = "ERROR " + str(e)[:600]
        print(f"{'ok  ' if msg is None else 'DIFF' if not msg.startswith('rows only') else 'rows'} {n} {time.time() - t:.1f}s {msg or ''}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
