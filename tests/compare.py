"""Compare queries with their SQL: `python tests/compare.py [sf_dir] [query ...]`."""

import glob
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def differences(df, con, sql):
    """Rows only in Spark, rows only in SQL; columns are matched by name."""
    columns = sorted(df.columns)
    result = con.execute(f"SELECT * FROM ({sql})")
    names = [d[0] for d in result.description]
    assert sorted(names) == columns, (sorted(names), columns)
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(r[i] for i in order) for r in result.fetchall())
    ours = Counter(tuple(r) for r in df.select(*columns).collect())
    return ours - theirs, theirs - ours, sum(ours.values())


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    for name in chosen:
        start = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            if name in entry.oracle_sql():
                more, less, n = differences(df, con, entry.oracle_sql()[name])
                verdict = "ok" if not more and not less else f"DIFF {list(more.items())[:2]} {list(less.items())[:2]}"
            else:
                n, verdict = df.count(), "no sql"
        except Exception as error:  # noqa: BLE001
            n, verdict = 0, f"ERROR {str(error)[:1500]}"
        print(f"{name:32s} {n:8d} rows {time.time() - start:6.1f}s  {verdict}", flush=True)
