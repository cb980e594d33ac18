"""Run registered queries against their DuckDB SQL: python tools/check.py [sf] [names or row ids...]"""

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

from shelfmark.plans import registry  # noqa: E402
from shelfmark.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def compare(spark, con, name, sf_dir):
    got_df = registry.QUERIES[name](spark, sf_dir)
    cols = sorted(got_df.columns)
    got = Counter(tuple(norm(r[c]) for c in cols) for r in got_df.collect())
    sql = registry.ORACLES.get(name)
    if not sql:
        return f"rows-only n={sum(got.values())}", True
    rel = con.sql(sql)
    names = list(rel.columns)
    if sorted(names) != cols:
        return f"columns differ {cols} vs {sorted(names)}", False
    types = dict(zip(names, map(str, rel.types)))
    idx = [names.index(c) for c in cols]
    want = Counter(tuple(norm(r[i]) for i in idx) for r in rel.fetchall())
    note = ""
    for f in got_df.schema.fields:
        s, d = f.dataType.simpleString(), types[f.name].lower()
        same = {"bigint": "bigint", "int": "integer", "string": "varchar", "double": "double", "boolean": "boolean",
                "date": "date", "timestamp_ntz": "timestamp", "float": "float"}.get(s)
        if same != d:
            note += f" [{f.name}: {s}/{d}]"
    if got == want:
        return f"ok n={sum(got.values())}{note}" + (" EMPTY" if not got else ""), not note and bool(got)
    return (f"MISMATCH spark={sum(got.values())} sql={sum(want.values())}{note}\n   cols {cols}\n"
            f"   spark-only {list((got - want).items())[:4]}\n   sql-only   {list((want - got).items())[:4]}"), False


def main():
    import shelfmark.plans  # noqa: F401
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("sf") else "sf0.01"
    sf_dir = f"/root/testdata/{sf}"
    spark = build_session(memory="6g")
    con = duckdb.connect()
    con.sql("set timezone='UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    by_query = {n: r for r, ns in registry.ROWS.items() for n in ns}
    picked = [n for n in registry.QUERIES if not args or n in args or by_query[n] in args
              or any(a.isalpha() and len(a) == 1 and by_query[n][0] == a for a in args)]
    bad = 0
    for n in picked:
        t0 = time.time()
        try:
            msg, ok = compare(spark, con, n, sf_dir)
        except Exception as e:  # report and go on
            text = str(e)
            msg, ok = f"ERROR {type(e).__name__}: {text[:700]}", False
        bad += not ok
        if not ok or args or time.time() - t0 > 4:
            print(f"{by_query[n]:4} {n}: {msg} ({time.time() - t0:.1f}s)", flush=True)
    print(f"{len(picked)} queries, {bad} bad")
    spark.stop()


if __name__ == "__main__":
    main()
