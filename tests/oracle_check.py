"""Run every registered query beside its SQL and compare the rows.

Usage: python -m tests.oracle_check [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def compare(spark, con, sf_dir: str, query, sql: str) -> str:
    """Empty if both sides give the same bag of rows, else what differs."""
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    ours = Counter(tuple(row) for row in df.select(*names).collect())
    answer = con.execute(sql)
    theirs_names = [column[0] for column in answer.description]
    if sorted(theirs_names) != names:
        return f"columns {names} against {sorted(theirs_names)}"
    order = [theirs_names.index(name) for name in names]
    theirs = Counter(tuple(row[i] for i in order) for row in answer.fetchall())
    if ours == theirs:
        return ""
    extra, missing = ours - theirs, theirs - ours
    return f"{sum(ours.values())} against {sum(theirs.values())} rows; extra {list(extra)[:3]}; missing {list(missing)[:3]}"


def main() -> int:
    from tests.conftest import make_session

    sys.path.insert(0, str(Path(__file__).parent.parent))
    import __spark_entry__ as driver

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark, con = make_session(), connect(sf_dir)
    bad = 0
    for name, query in driver.queries().items():
        if (only and name not in only) or name not in driver.oracle_sql():
            continue
        started = time.time()
        problem = compare(spark, con, sf_dir, query, driver.oracle_sql()[name])
        bad += bool(problem)
        print(f"{name:24s} {time.time() - started:6.1f}s {problem or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
