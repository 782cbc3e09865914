"""Run registered queries beside their SQL in DuckDB: ``python tests/compare.py [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def differences(spark_df, con, sql: str) -> list[str]:
    """Reasons the two results differ; empty when they agree on columns, types and values."""
    relation = con.sql(sql)
    types = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    found = []
    spark_types = {f.name: f.dataType.simpleString() for f in spark_df.schema}
    if sorted(types) != sorted(spark_types):
        return [f"columns {sorted(spark_types)} / {sorted(types)}"]
    exact = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
             "HUGEINT": "bigint"}
    for c, kind in types.items():
        if exact.get(kind) != spark_types[c]:
            found.append(f"type of {c}: {spark_types[c]} / {kind}")
    ours = [tuple(r[c] for c in sorted(types)) for r in spark_df.collect()]
    ours = sorted([tuple(None if isinstance(v, float) and v != v else v for v in r) for r in ours],
                  key=lambda r: tuple((v is None, str(type(v)), v) for v in r))
    order = ", ".join(f'"{c}"' for c in sorted(types))
    theirs = sorted(con.sql(f"SELECT {order} FROM ({sql})").fetchall(),
                    key=lambda r: tuple((v is None, str(type(v)), v) for v in r))
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} / {len(theirs)}")
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first: {wrong[0][0]} / {wrong[0][1]}")
    return found


def main() -> int:
    import __spark_entry__ as entry
    from maskwright.session import build_session

    args = sys.argv[1:]
    sf = args[0] if args else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    sqls = entry.oracle_sql()
    for name, query in entry.queries().items():
        if args[1:] and name not in args[1:]:
            continue
        begin = time.time()
        try:
            df = query(spark, folder)
            found = differences(df, con, sqls[name]) if name in sqls else []
            note = f"rows {df.count()}" if name not in sqls else ""
        except Exception as error:  # noqa: BLE001 - the table should show every query
            found, note = [f"{type(error).__name__}: {str(error)[:700]}"], ""
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - begin:.2f}s {note} {' | '.join(found)}", flush=True)
    print(f"{bad} failures")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
