"""Run registered queries beside their SQL counterparts and compare the rows.

    python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, fn, oracle: str, sf_dir: str) -> str:
    """An empty string when equal, else what differs."""
    df = fn(spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(oracle)
    names = [d[0] for d in rel.description]
    types = {d[0]: str(d[1]) for d in rel.description}
    theirs = rows_of(names, rel.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    known = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
             "timestamp_ntz": "TIMESTAMP"}
    off = [(c, t, types[c]) for c, t in df.dtypes if known.get(t) != types[c]]
    if off:
        return f"types {off}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs, strict=True) if a != b]
    return f"{len(bad)} of {len(mine)} rows differ, first: {bad[0]}" if bad else ""


def main() -> int:
    sys.path.insert(0, ROOT)
    from __spark_entry__ import oracle_sql, queries
    from riskloom.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        "oracle", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    oracles = oracle_sql()
    for name, fn in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in oracles:
                verdict = compare(spark, con, name, fn, oracles[name], sf_dir)
            else:
                n = fn(spark, sf_dir).count()
                verdict = "" if n else "no rows"
                name += f" ({n} rows only)"
        except Exception as exc:  # report and go on with the next one
            verdict = f"{type(exc).__name__}: {str(exc)[:600]}"
        failed += bool(verdict)
        print(f"{'FAIL' if verdict else 'ok  '} {time.time() - start:6.2f}s {name} {verdict}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(), 1))
