"""Run registered queries against their SQL: python tests/check.py [sf] [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as entry_module


def normal(v):
    if isinstance(v, float):
        return round(v, 9)
    return v


def compare(spark, con, folder, name, fn, sql):
    start = time.time()
    df = fn(spark, folder)
    rows = df.collect()
    took = time.time() - start
    cols = df.columns
    mine = sorted(repr([normal(r[c]) for c in sorted(cols)]) for r in rows)
    if sql is None:
        return f"{name}: {len(rows)} rows, no sql, {took:.1f}s"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    theirs_rows = cur.fetchall()
    order = [names.index(c) for c in sorted(names)]
    theirs = sorted(repr([normal(r[i]) for i in order]) for r in theirs_rows)
    ok = sorted(cols) == sorted(names) and mine == theirs
    line = f"{name}: {'ok' if ok else 'MISMATCH'} rows={len(rows)}/{len(theirs_rows)} {took:.1f}s"
    if not ok:
        line += f"\n  cols {sorted(cols)} / {sorted(names)}"
        extra = set(mine) - set(theirs)
        lack = set(theirs) - set(mine)
        line += f"\n  only spark {len(extra)}: {[x[:300] for x in list(extra)[:2]]}"
        line += f"\n  only sql {len(lack)}: {[x[:300] for x in list(lack)[:2]]}"
    line += "  " + ",".join(f"{f.name}:{f.dataType.simpleString()}={types.get(f.name)}" for f in df.schema.fields)
    return line


def main():
    folder = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in sorted(os.listdir(folder)):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{folder}/{f}'")
    sqls = entry_module.oracle_sql()
    for name, fn in entry_module.queries().items():
        if wanted and name not in wanted:
            continue
        try:
            print(compare(spark, con, folder, name, fn, sqls.get(name)), flush=True)
        except Exception as e:
            print(f"{name}: FAILED {type(e).__name__}: {str(e)[:500]}", flush=True)


if __name__ == "__main__":
    main()
