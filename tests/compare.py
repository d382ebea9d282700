"""Spark result against DuckDB result: same columns, same rows in any order."""

from __future__ import annotations

import sys

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(row[i] for i in order) for row in data]
    return sorted(names), sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short account of the first difference."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_names, want = rows(names, cur.fetchall())
    got_names, got = rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{dict(zip(got_names, g))} != {dict(zip(want_names, w))}"
        if [type(x) for x in g] != [type(x) for x in w]:
            return f"types {[type(x) for x in g]} != {[type(x) for x in w]} of {got_names}"
    return None


if __name__ == "__main__":
    import time

    sys.path.insert(0, "/root/repo")
    from __spark_entry__ import oracle_sql, queries
    from playbeat.session import get_spark

    sf = sys.argv[1]
    spark = get_spark(
        spark__master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__showConsoleProgress="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf), oracle_sql()
    wanted = sys.argv[2:] or list(queries())
    for name, fn in queries().items():
        if name in wanted:
            start = time.time()
            try:
                note = difference(fn(spark, sf), con, sqls[name]) if name in sqls else "no sql"
            except Exception as error:  # report and go on with the next query
                note = f"{type(error).__name__}: {str(error)[:1500]}"
            print(f"{name:28s} {time.time() - start:6.2f}s {note or 'ok'}"[:1800], flush=True)
