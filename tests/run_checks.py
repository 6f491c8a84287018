"""Compare registered queries with DuckDB: python tests/run_checks.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from conformance.tables import SOURCES  # noqa: E402

TABLES = (*SOURCES, "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _row(values) -> tuple:
    out = []
    for v in values:
        if isinstance(v, bool) or v is None or isinstance(v, str):
            out.append(v)
        elif isinstance(v, (int, float)):
            out.append(float(v) + 0.0)
        else:
            out.append(str(v))
    return tuple(out)


def _sorted(rows) -> list:
    return sorted(rows, key=lambda r: [(v is None, str(type(v)), v if v is not None else 0) for v in r])


def compare(df, con, sql: str) -> str | None:
    """None if both sides hold the same rows, else what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: spark {sorted(df.columns)} duck {sorted(names)}"
    order = sorted(names)
    at = [names.index(n) for n in order]
    right = _sorted(_row(r[i] for i in at) for r in cur.fetchall())
    left = _sorted(_row(r) for r in df.select(*[f"`{n}`" for n in order]).collect())
    if len(left) != len(right):
        return f"rows differ: spark {len(left)} duck {len(right)}"
    if not left:
        return "no rows"
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        return f"{len(bad)} of {len(left)} rows differ in {order}:\n    spark {bad[0][0]}\n    duck  {bad[0][1]}"
    return None


def main() -> int:
    from marginlab.session import build_session
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session("local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        t0 = time.time()
        try:
            df = run(spark, sf_dir)
            problem = compare(df, con, sqls[name]) if name in sqls else f"rows only: {df.count()}"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - t0:.1f}s {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
