"""Runs registered queries beside their DuckDB twins and compares names, types and rows.

python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark result and a DuckDB result; empty when equal."""
    cursor = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in cursor.description}
    names = sorted(theirs)
    problems = []
    if sorted(df.columns) != names:
        return [f"columns {sorted(df.columns)} != {names}"]
    for name, dtype in df.dtypes:
        if TYPES.get(dtype) != theirs[name]:
            problems.append(f"type of {name}: {dtype} / {theirs[name]}")
    order = [list(theirs).index(n) for n in names]
    expected = Counter(tuple(plain(row[i]) for i in order) for row in cursor.fetchall())
    got = Counter(tuple(plain(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect())
    if expected != got:
        missing, extra = expected - got, got - expected
        problems.append(f"rows {sum(got.values())} / {sum(expected.values())}; "
                        f"only sql {list(missing)[:2]}; only spark {list(extra)[:2]}")
    return problems


def main() -> int:
    from tidewright.plans.catalog import ORACLE_SQL, QUERIES
    from tidewright.session import build_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark = build_session("oracle", "local[8]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("OFF")
    con, failed = connect(sf_dir), 0
    for name in chosen:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLE_SQL:
                problems = compare(df, con, ORACLE_SQL[name])
                note = "equal"
            else:
                problems, note = [], f"{df.count()} rows, no twin"
        except Exception as error:  # noqa: BLE001
            problems, note = [f"{type(error).__name__}: {str(error)[:700]}"], ""
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:30s} {time.time() - start:6.2f}s "
              f"{note if not problems else ' | '.join(problems)}", flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} passed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
