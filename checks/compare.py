"""Run registered queries and their SQL side by side: ``python -m checks.compare SF_DIR [name ...]``."""

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _kind(type_name: str) -> str:
    return {"varchar": "string", "bigint": "bigint", "hugeint": "bigint"}.get(type_name.lower(), type_name.lower())


def spark_rows(df: DataFrame) -> tuple[dict[str, str], list[tuple]]:
    names = sorted(df.columns)
    return dict(df.dtypes), sorted(map(tuple, df.select(*names).collect()), key=repr)


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[dict[str, str], list[tuple]]:
    result = con.execute(sql)
    kinds = {d[0]: _kind(str(d[1])) for d in result.description}
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = [tuple(row[i] for i in order) for row in result.fetchall()]
    return kinds, sorted(rows, key=repr)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str:
    """An empty text if columns, types and rows agree; else what differs."""
    got_kinds, got = spark_rows(QUERIES[name](spark, sf_dir))
    want_kinds, want = sql_rows(con, ORACLE_SQL[name])
    if got_kinds != {k: v.replace(" ", "") for k, v in want_kinds.items()}:
        return f"schema {set(got_kinds.items()) ^ set(want_kinds.items())}"
    if len(got) != len(want):
        return f"{len(got)} rows, {len(want)} wanted"
    different = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    return f"{len(different)} of {len(got)} rows differ, first {different[0]}" if different else ""


if __name__ == "__main__":
    from claimledger.session import local_session

    session, directory = local_session("compare"), sys.argv[1]
    connection = database(directory)
    failed = 0
    for query in sys.argv[2:] or QUERIES:
        start = time.time()
        problem = compare(session, connection, directory, query)
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok':4} {query:28} {time.time() - start:6.2f}s {problem}", flush=True)
    sys.exit(failed)
