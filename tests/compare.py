"""Run queries on Spark and their SQL on DuckDB over the same tables, and compare whole results."""

import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr), [names[i] for i in order]


def difference(spark_df, con, sql):
    """None if equal, else a short text."""
    got, got_names = normal(map(tuple, spark_df.collect()), spark_df.columns)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want, want_names = normal(result.fetchall(), names)
    if got_names != want_names:
        return f"columns {got_names} vs {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}: {[r for r in got if r not in want][:3]} / {[r for r in want if r not in got][:3]}"
    types = [(type(a), type(b)) for g, w in zip(got[:50], want[:50]) for a, b in zip(g, w)]
    odd = {t for t in types if t[0] is not t[1] and type(None) not in t}
    if odd:
        return f"types {odd}"
    bad = [(g, w) for g, w in zip(got, want) if repr(g) != repr(w)]
    return f"{len(bad)} rows differ: {bad[:2]}" if bad else None


def main(sf_dir, *only):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf_dir), entry.oracle_sql(), []
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            df = query(spark, sf_dir)
            out = difference(df, con, sql[name]) if name in sql else f"no SQL, {df.count()} rows"
        except Exception as e:
            out = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        if out:
            failed.append(name)
        print(f"{'ok  ' if not out else 'FAIL'} {name} {time.time() - t:.1f}s {out or ''}", flush=True)
    print("failed:", failed)
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
