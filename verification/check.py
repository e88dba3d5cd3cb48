"""Compare the registered queries with their SQL counterparts in DuckDB.

    python verification/check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from verification.oracle import ORACLE  # noqa: E402
from verification.queries import QUERIES  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """An in-process database with the tables as views."""
    con = duckdb.connect()
    for table in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return con


def normalized(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples over columns in name order."""
    frame = frame[sorted(frame.columns)]

    def value(x):
        if x is None or x is pd.NaT or (isinstance(x, float) and x != x):
            return None
        if isinstance(x, (bool, str)):
            return x
        if isinstance(x, pd.Timestamp):
            return x.isoformat()
        return float(x)

    rows = [tuple(value(x) for x in row) for row in frame.astype(object).itertuples(index=False)]
    return sorted(
        rows, key=lambda row: [("", "") if x is None else (type(x).__name__, x) for x in row]
    )


def difference(mine: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """What differs between two results, or None."""
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} != {sorted(theirs.columns)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    for left, right in zip(normalized(mine), normalized(theirs), strict=True):
        if left != right:
            return f"{left} != {right}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        mine = QUERIES[name](spark, sf_dir).toPandas()
        took = time.time() - start
        if name in ORACLE:
            problem = difference(mine, con.execute(ORACLE[name]).df())
        else:
            problem = None if len(mine) else "no rows"
        failed += problem is not None
        kind = "sql" if name in ORACLE else "rows"
        print(f"{name:24} {len(mine):8} rows {took:7.2f} s {kind:5} {problem or 'ok'}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    arguments = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sys.exit(main(arguments[0], arguments[1:]))
