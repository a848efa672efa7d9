"""Run the queries on Spark and their SQL on DuckDB and compare row by row.

    python -m verification.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    import duckdb

    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def in_name_order(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    named = [columns[i] for i in order]
    return named, sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(df, db, sql: str) -> str | None:
    """None where both engines agree in names, row count and every value; else what differs."""
    mine = in_name_order(df.columns, df.collect())
    result = db.execute(sql)
    theirs = in_name_order([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} against {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows against {len(theirs[1])}"
    differing = [(a, b) for a, b in zip(mine[1], theirs[1]) if repr(a) != repr(b)]
    if differing:
        return f"{len(differing)} of {len(mine[1])} rows, first {differing[0]}"
    return None


def main() -> int:
    from clientele.session import session
    from verification import oracle, queries

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries.DEFINITIONS)
    spark = session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    db, sql, all_queries = connect(folder), oracle.all_sql(), queries.all_queries()
    bad = 0
    for name in names:
        begin = time.time()
        try:
            found = difference(all_queries[name](spark, folder), db, sql[name])
        except Exception as error:  # noqa: BLE001 - one broken query must not hide the others
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - begin:.1f}s {found or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(main())
