"""Run queries next to their SQL and compare the rows."""

import math
import os
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x + 0.0, 6)
    if hasattr(x, "isoformat"):
        return x.isoformat()[:19]
    return x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def spark_rows(df):
    return rows_of(df.columns, df.collect())


def sql_rows(con, text):
    rel = con.sql(text)
    return rows_of(rel.columns, rel.fetchall())


def main(sf_dir, names):
    import __spark_entry__ as entry
    from tonetape.session import local_session

    spark = local_session("8")
    if zone := os.environ.get("COMPARE_ZONE"):
        spark.conf.set("spark.sql.session.timeZone", zone)
    if parts := os.environ.get("COMPARE_PARTITIONS"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = []
    for name, fn in queries.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        try:
            t = time.time()
            got = spark_rows(fn(spark, sf_dir))
            took = time.time() - t
            if name not in oracles:
                print(f"rows {name} {len(got[1])} {took:.1f}s", flush=True)
                continue
            t = time.time()
            want = sql_rows(con, oracles[name])
            same = got == want
            print(f"{'ok  ' if same else 'DIFF'} {name} {len(got[1])} {len(want[1])} {took:.1f}s sql {time.time() - t:.1f}s", flush=True)
            if not same:
                bad.append(name)
                print("  ", got[0], want[0])
                a, b = set(got[1]), set(want[1])
                for r in [*sorted(a - b, key=str)[:2], "--", *sorted(b - a, key=str)[:2]]:
                    print("  ", str(r)[:300])
        except Exception as e:
            bad.append(name)
            print(f"FAIL {name} {type(e).__name__} {str(e)[:600]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
