"""Run registered queries on both engines and compare the rows.

    python -m catalog.compare SF_DIR [KEY ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return v if v is None else str(v)


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name, query, sql) -> tuple[bool, str]:
    frame = query(spark, sf_dir)
    mine = frame.collect()
    answer = con.execute(sql)
    columns = [c[0] for c in answer.description]
    theirs = answer.fetchall()
    if sorted(frame.columns) != sorted(columns):
        return False, f"columns {sorted(set(frame.columns) ^ set(columns))}"
    a, b = bag(frame.columns, mine), bag(columns, theirs)
    if a == b:
        return True, f"{len(mine)} rows"
    only_a, only_b = list((a - b).elements()), list((b - a).elements())
    cols = sorted(columns)
    return False, f"{len(mine)} and {len(theirs)} rows; columns {cols}\n  spark {only_a[:2]}\n  duck  {only_b[:2]}"


def main(argv: list[str]) -> int:
    from dirsync.session import build_session

    from .oracle import oracle_texts
    from .queries import QUERIES

    spark = build_session(
        "compare", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, names = argv[0], argv[1:]
    con, sqls = duck(sf_dir), oracle_texts()
    bad = 0
    for name, query in QUERIES.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sqls:
                ok, note = compare(spark, con, sf_dir, name, query, sqls[name])
            else:
                ok, note = True, f"{len(query(spark, sf_dir).collect())} rows, no SQL"
        except Exception as err:  # noqa: BLE001
            ok, note = False, str(err)[:600]
        bad += not ok
        print("ok  " if ok else "FAIL", name, f"{time.time() - start:.1f}s", note, flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
