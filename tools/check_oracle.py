"""Local stand-in for the driver's correctness gate.

Runs every registered query on Spark and its oracle SQL on DuckDB over the same
parquet folder, then compares row count, column names and order-insensitive
values (floats compared to 9 significant digits) and column types.

usage: python tools/check_oracle.py [sf_dir] [name ...]
"""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from kiln.plans.catalog import load_all  # noqa: E402
from kiln.session import build_session  # noqa: E402
from kiln.sources.tables import TABLE_NAMES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


# DuckDB result type -> Spark simpleString, for the schema part of the compare.
DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
                 "FLOAT": "float", "SMALLINT": "smallint", "TINYINT": "tinyint", "DATE": "date",
                 "TIMESTAMP": "timestamp_ntz"}


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=repr)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    reg = load_all()
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for name, q in reg.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = q.fn(spark, sf)
            scols = sdf.columns
            stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if q.sql is None:
            print(f"rows {name}: {len(srows)} rows ({ts:.1f}s)")
            continue
        try:
            rel = con.sql(q.sql)
            dtypes = {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
            dcols = list(rel.columns)
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:300]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {name}: columns spark={scols} duckdb={dcols}")
            bad += 1
            continue
        wrong = {c: (stypes[c], dtypes.get(c)) for c in scols if stypes[c] != dtypes.get(c)}
        if wrong:
            print(f"FAIL {name}: types differ {wrong}")
            bad += 1
            continue
        a, b = rows_of(scols, srows), rows_of(dcols, drows)
        if len(a) != len(b):
            print(f"FAIL {name}: rows spark={len(a)} duckdb={len(b)}")
            bad += 1
            continue
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            print(f"FAIL {name}: values differ, e.g. {diff}")
            bad += 1
            continue
        print(f"ok   {name}: {len(a)} rows ({ts:.1f}s)")
    print(f"{bad} failing")
    spark.stop()


if __name__ == "__main__":
    main()
