"""Run registered queries against their SQL twins: python tests/compare.py [sf] [names...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


# Types the two engines spell differently but hash alike.
SAME = {"HUGEINT": "BIGINT", "INTEGER": "BIGINT", "SMALLINT": "BIGINT", "TINYINT": "BIGINT"}


def compare(spark, con, name: str, sf_dir: str, build, sql: str | None) -> str | None:
    """None when both sides agree, else what differs."""
    got = build(spark, sf_dir).toArrow()  # noqa: F841 (read by name below)
    con.register("got_rows", got)
    if sql is None:
        return None if got.num_rows else "no rows"
    start = time.time()
    con.execute(f"CREATE OR REPLACE TEMP TABLE want_rows AS {sql}")
    if time.time() - start > 2:
        print(f"     sql of {name}: {time.time() - start:.2f}s", flush=True)
    kinds = [
        {r[0]: SAME.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {t}").fetchall()} for t in ("got_rows", "want_rows")
    ]
    if kinds[0] != kinds[1]:
        return f"schema {kinds[0]} != {kinds[1]}"
    cols = ", ".join(f'"{c}"' for c in kinds[0])
    count = con.execute("SELECT count(*) FROM want_rows").fetchone()[0]
    if got.num_rows != count:
        return f"{got.num_rows} rows != {count}"
    for a, b in (("got_rows", "want_rows"), ("want_rows", "got_rows")):
        extra = con.execute(f"SELECT {cols} FROM {a} EXCEPT ALL SELECT {cols} FROM {b} LIMIT 3").fetchall()
        if extra:
            return f"only in {a}: {extra}"
    return None if count else "both sides empty"


def main() -> int:
    import __spark_entry__ as entry
    from forgeline.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                  "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, build in queries.items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir, build, sqls.get(name))
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s"
              f"{'' if name in sqls else ' (rows only)'}", problem or "", flush=True)
    print(f"{len(queries)} queries, {bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(main())
