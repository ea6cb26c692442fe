"""Run registered queries against their SQL twins: ``python tests/compare.py SF_DIR [key ...]``."""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def oracle_connection(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def difference(frame, connection, sql):
    """None when equal, else a short description."""
    rows = [tuple(r) for r in frame.collect()]
    cursor = connection.execute(sql)
    expected_columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(frame.columns) != sorted(expected_columns):
        return f"columns {sorted(frame.columns)} != {sorted(expected_columns)}"
    left, right = as_rows(frame.columns, rows), as_rows(expected_columns, expected)
    if left == right:
        return None
    only_left = [r for r in left if r not in set(right)][:3]
    only_right = [r for r in right if r not in set(left)][:3]
    return f"rows {len(left)} vs {len(right)}\n  spark: {only_left}\n  sql:   {only_right}"


def main(sf_dir, keys):
    import __spark_entry__ as entry
    from planlens.session import build_session

    spark = build_session("compare", **{
        "spark__ui__enabled": "false", "spark__sql__shuffle__partitions": "8",
        "spark__driver__memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for key in keys or queries:
        start = time.time()
        try:
            frame = queries[key](spark, sf_dir)
            if key in oracle:
                problem = difference(frame, connection, oracle[key])
                verdict = "ok" if problem is None else f"DIFFERS: {problem}"
            else:
                verdict = f"rows only: {frame.count()}"
        except Exception as error:  # report and go on to the next key
            verdict = f"ERROR: {str(error)[:1500]}"
        failed += verdict.startswith(("DIFFERS", "ERROR"))
        print(f"{key:<32} {time.time() - start:6.2f}s  {verdict}", flush=True)
    print(f"{failed} of {len(keys or queries)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
