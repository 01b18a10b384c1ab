"""Compare registered queries with their SQL: ``python tests/check_oracle.py [sf_dir] [names]``."""

import glob
import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402


TIMES = {}


def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, name, sf_dir):
    """None if equal, else a description of the difference."""
    start = time.time()
    df = entry.queries()[name](spark, sf_dir)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    middle = time.time()
    relation = con.sql(entry.oracle_sql()[name])
    want = canonical(relation.columns, relation.fetchall())
    TIMES[name] = (middle - start, time.time() - middle)
    if got[0] != want[0]:
        return f"columns {got[0]} vs {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} vs {len(want[1])}"
    if got[1] == want[1]:
        return None
    off = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(off)} rows differ, first: {off[0]}"


def types(spark, con, name, sf_dir):
    df = entry.queries()[name](spark, sf_dir)
    relation = con.sql(entry.oracle_sql()[name])
    return sorted(df.dtypes), sorted(zip(relation.columns, map(str, relation.types)))


if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="checkpoints-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            if name in entry.oracle_sql():
                problem = compare(spark, con, name, sf_dir)
                if os.environ.get("TYPES"):
                    print("   ", *types(spark, con, name, sf_dir), sep="\n    ")
            else:
                rows = entry.queries()[name](spark, sf_dir).collect()
                problem = None if rows else "no rows"
        except Exception as error:  # keep going, report at the end
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name} {time.time() - start:.1f}s {[round(t, 1) for t in TIMES.get(name, ())]} {problem or ''}", flush=True)
    print("failed:", failed)
