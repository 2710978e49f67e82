"""Compare every query with its oracle SQL in DuckDB: python tools/check_oracle.py [sf] [names...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from gridwright.catalog import ORACLES, QUERIES  # noqa: E402
from gridwright.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
             "tinyint": "TINYINT", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def duck_with(sf_dir: str) -> duckdb.DuckDBPyConnection:
    duck = duckdb.connect()
    for t in TABLES:
        duck.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return duck


def _clean(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    return repr(value) if isinstance(value, float) else str(value)


def _rows(rows, order):
    return sorted(tuple(_clean(x[i]) for i in order) for x in rows)


def check(spark, duck, sf_dir: str, name: str) -> int:
    """Rows of the query; raises where columns, types or values differ from the oracle."""
    frame = QUERIES[name](spark, sf_dir)
    rows = frame.collect()
    if name not in ORACLES:
        return len(rows)
    rel = duck.sql(ORACLES[name])
    cols = sorted(frame.columns)
    assert cols == sorted(rel.columns), f"columns differ: {set(cols) ^ set(rel.columns)}"
    types = {c: (frame.schema[c].dataType.simpleString(), str(rel.types[rel.columns.index(c)])) for c in cols}
    odd = {c: t for c, t in types.items() if SAME_TYPE.get(t[0]) != t[1]}
    assert not odd, f"types differ: {odd}"
    mine = _rows(rows, [frame.columns.index(c) for c in cols])
    theirs = _rows(rel.fetchall(), [rel.columns.index(c) for c in cols])
    if mine != theirs:
        extra, lack = sorted(set(mine) - set(theirs)), sorted(set(theirs) - set(mine))
        raise AssertionError(f"{len(mine)} vs {len(theirs)} rows; {cols}; only here {extra[:2]}; only there {lack[:2]}")
    return len(rows)


def main() -> None:
    sf, only = (sys.argv[1] if len(sys.argv) > 1 else "sf0.01"), set(sys.argv[2:])
    sf_dir = f"/root/testdata/{sf}"
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    duck, failed = duck_with(sf_dir), []
    for name in QUERIES:
        if only and name not in only:
            continue
        start = time.time()
        try:
            n = check(spark, duck, sf_dir, name)
            kind = "match" if name in ORACLES else "rows "
            print(f"{kind}  {name:32} {n:8} rows {time.time() - start:6.1f}s{'' if n else '   EMPTY'}")
        except Exception as e:  # noqa: BLE001
            failed.append(name)
            print(f"FAIL   {name:32} {type(e).__name__}: {str(e)[:1500]}")
    print(len(QUERIES), "queries,", len(ORACLES), "with oracle; failed:", failed)


if __name__ == "__main__":
    main()
