"""Run queries against their SQL and compare whole results."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _rows(table, columns):
    return sorted((tuple(str(v) for v in row) for row in zip(*[table[c].to_pylist() for c in columns])))


def _kinds(schema):
    return {f.name: str(f.type).replace("large_", "") for f in schema}


def compare(spark_table, sql_table) -> str:
    """'' when equal, else what differs."""
    columns = sorted(spark_table.column_names)
    if columns != sorted(sql_table.column_names):
        return f"columns {columns} / {sorted(sql_table.column_names)}"
    if spark_table.num_rows != sql_table.num_rows:
        return f"rows {spark_table.num_rows} / {sql_table.num_rows}"
    mine, theirs = _kinds(spark_table.schema), _kinds(sql_table.schema)
    kinds = {c: (mine[c], theirs[c]) for c in columns if mine[c] != theirs[c]}
    if kinds:
        return f"types {kinds}"
    a, b = _rows(spark_table, columns), _rows(sql_table, columns)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        return f"values differ in {len(wrong)} of {len(a)}: {columns} {wrong[0]}"
    return ""


def main() -> None:
    import __spark_entry__ as entry
    from ledgerloom.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in names or oracles:
        try:
            t0 = time.time()
            ours = queries[name](spark, sf_dir).toArrow()
            t1 = time.time()
            theirs = con.sql(oracles[name]).to_arrow_table()
            t2 = time.time()
            verdict = compare(ours, theirs) or f"ok {ours.num_rows} rows"
            print(f"{name}: {verdict} [spark {t1 - t0:.1f}s sql {t2 - t1:.1f}s]", flush=True)
        except Exception as e:  # report and go on with the next query
            print(f"{name}: FAILED {str(e)[:1500]}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
