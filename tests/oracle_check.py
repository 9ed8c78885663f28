"""Compare every registered query with its checking SQL: columns, types, row count, values."""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as registry  # noqa: E402

KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return float(value) if isinstance(value, decimal.Decimal) else value


def differences(spark, con, name: str, sf_dir: str) -> list[str]:
    """Empty if the query and its SQL agree."""
    frame = registry.queries()[name](spark, sf_dir)
    checked = con.sql(registry.oracle_sql()[name])
    found = []
    columns = sorted(frame.columns)
    if columns != sorted(checked.columns):
        return [f"columns {columns} / {sorted(checked.columns)}"]
    kinds = {c: KINDS.get(str(t), str(t)) for c, t in zip(checked.columns, checked.types)}
    found += [f"type of {c}: {t} / {kinds[c]}" for c, t in frame.dtypes if t != kinds[c]]
    ours = Counter(tuple(_plain(r[c]) for c in columns) for r in frame.collect())
    place = {c: i for i, c in enumerate(checked.columns)}
    theirs = Counter(tuple(_plain(r[place[c]]) for c in columns) for r in checked.fetchall())
    if not theirs:
        found.append("no rows")
    if ours != theirs:
        extra, missing = list((ours - theirs))[:2], list((theirs - ours))[:2]
        found.append(f"rows {ours.total()} / {theirs.total()}; only here {extra}; only there {missing}")
    return found


if __name__ == "__main__":
    from barlake.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = build_session("check", {
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = database(sf)
    for query in only or registry.oracle_sql():
        begun = time.time()
        try:
            result = differences(spark, con, query, sf)
        except Exception as error:  # noqa: BLE001
            result = [f"{type(error).__name__}: {str(error)[:600]}"]
        print(f"{query:28s} {time.time() - begun:6.2f}s {'ok' if not result else result}", flush=True)
