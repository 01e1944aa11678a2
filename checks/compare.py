"""Run the registered queries beside their SQL and compare rows as sorted values.

``python -m checks.compare [sf_dir] [name ...]``
"""

from __future__ import annotations

import os
import sys
import time
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from checks.queries import REGISTRY
from checks.sql import ORACLE
from txnlake.session import BUILDER_OPTIONS

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


# Queries that SQL over the given tables can not express: they have to return rows.
WITHOUT_SQL = {"cat_file_inventory", "gl_stream_raw", "prof_gold_report"}
SHARED = os.environ.get("TXNLAKE_SHARED", "/tmp/txnlake-checks")


def session(cpus: int = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("txnlake-checks")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", SHARED)
    )
    for key, value in BUILDER_OPTIONS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(x):
    if isinstance(x, Decimal):
        return int(x) if x == int(x) else float(x)
    return x


def _equal(x, y) -> bool:
    """Equal, or doubles one unit of the sixth digit apart: a mean on the border rounds either way."""
    if isinstance(x, float) and isinstance(y, float):
        return abs(x - y) <= 1.1e-6
    return repr(x) == repr(y)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(spark, con, name: str, sf_dir: str) -> str:
    """Empty text when equal, else what differs."""
    df = REGISTRY[name](spark, sf_dir)
    cols, mine = _rows(df.columns, df.collect())
    if name not in ORACLE:
        return "no SQL" if name not in WITHOUT_SQL else "" if mine else "no rows"
    result = con.execute(ORACLE[name])
    want_cols, want = _rows([d[0] for d in result.description], result.fetchall())
    if cols != want_cols:
        return f"columns {sorted(set(cols) ^ set(want_cols))}"
    if len(mine) != len(want):
        return f"{len(mine)} rows, expected {len(want)}"
    wrong = [(a, b) for a, b in zip(mine, want) if not all(map(_equal, a, b))]
    if not wrong:
        return ""
    a, b = wrong[0]
    cells = [(c, x, y) for c, x, y in zip(cols, a, b) if not _equal(x, y)]
    return f"{len(wrong)} of {len(mine)} rows differ, first: {cells[:4]}"


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(REGISTRY)
    spark, con = session(), connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:500]}"
        bad += bool(problem)
        kind = "sql" if name in ORACLE else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {name} [{kind}] {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
