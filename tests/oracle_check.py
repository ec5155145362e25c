"""Run registered queries beside their SQL on one data folder and report differences.

    python tests/oracle_check.py [folder] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
SPARK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return db


def _sortable(row):
    return tuple((v is None, 0 if v is None else v) for v in row)


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v


def compare(spark, db, sf_dir: str, name: str) -> list[str]:
    """Differences in columns, types and rows; empty when the two sides agree."""
    df = contract.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=_sortable)
    rel = db.execute(contract.oracle_sql()[name])
    theirs = {d[0]: str(d[1]) for d in rel.description}
    names = [d[0] for d in rel.description]
    if sorted(names) != columns:
        return [f"columns {columns} != {sorted(names)}"]
    order = [names.index(c) for c in columns]
    want = sorted((tuple(_plain(r[i]) for i in order) for r in rel.fetchall()), key=_sortable)
    out = []
    ours = dict(df.dtypes)
    for c in columns:
        if SPARK_TYPES.get(ours[c], ours[c]) != theirs[c]:
            out.append(f"type of {c}: {ours[c]} / {theirs[c]}")
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    for a, b in zip(got, want):
        if a != b:
            out.append(f"first difference:\n   spark {dict(zip(columns, a))}\n   sql   {dict(zip(columns, b))}")
            break
    return out


def main() -> None:
    from tests.conftest import make_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.001"
    spark, db = make_session(), connect(sf_dir)
    bad = 0
    for name in args or contract.oracle_sql():
        started = time.time()
        try:
            problems = compare(spark, db, sf_dir, name)
        except Exception as e:  # report and go on with the next query
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(problems)
        print(f"{'DIFF' if problems else 'ok'} {name} {time.time() - started:.2f}s", *problems,
              sep="\n  ", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
