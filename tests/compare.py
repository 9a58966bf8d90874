"""Run the registered queries and their SQL side by side and compare all values.

    python tests/compare.py [sf dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf: str):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return db


def _ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row))


def compare(spark, db, name: str, sf: str) -> list[str]:
    """Differences between the query and its SQL: types, row counts, values."""
    frame = contract.queries()[name](spark, sf)
    names = sorted(frame.columns)
    actual = _ordered([tuple(r) for r in frame.select(*names).collect()])
    relation = db.sql(contract.oracle_sql()[name])
    if sorted(relation.columns) != names:
        return [f"columns {names} != {sorted(relation.columns)}"]
    expected_types = dict(zip(relation.columns, [str(t) for t in relation.types]))
    same = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
    problems = [
        f"type of {c}: {t} != {expected_types[c]}" for c, t in frame.dtypes if same.get(expected_types[c]) != t
    ]
    expected = _ordered(db.sql(f"SELECT {', '.join(names)} FROM relation").fetchall())
    if len(actual) != len(expected):
        problems.append(f"{len(actual)} rows != {len(expected)}")
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first {wrong[:3]}")
    return problems


def main(sf: str = "/root/testdata/sf0.01", *only: str) -> int:
    from pulseframe.session import get_session

    conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    spark = get_session("compare", "local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    db, failed = connect(sf), 0
    for name in only or contract.queries():
        began = time.time()
        if name in contract.oracle_sql():
            problems = compare(spark, db, name, sf)
            verdict = "; ".join(problems) or "equal"
            failed += bool(problems)
        else:
            verdict = f"{contract.queries()[name](spark, sf).count()} rows, no SQL"
        print(f"{name:24s} {time.time() - began:6.2f}s  {verdict[:1500]}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
