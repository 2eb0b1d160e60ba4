"""Compare queries with their SQL in DuckDB. As a script: oracle.py SF_DIR [name ...]"""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 9)
        return v

    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def compare(spark, con, run, sql, sf_dir):
    """None if equal, else a short description of the difference."""
    df = run(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = rows(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        extra = [r for r in got if r not in want][:2], [r for r in want if r not in got][:2]
        return f"{len(got)} rows != {len(want)}; {str(extra)[:600]}"
    diff = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(diff)} of {len(got)} rows differ, first {str(diff[0])[:600]}" if diff else None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    con, oracles = connect(sf_dir), entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = compare(spark, con, run, oracles[name], sf_dir)
                outcome = "ok" if problem is None else f"DIFF {problem}"
            else:
                outcome = f"{run(spark, sf_dir).count()} rows, no SQL"
        except Exception as err:
            outcome = f"FAIL {type(err).__name__}: {str(err)[:800]}"
        bad += outcome.startswith(("DIFF", "FAIL"))
        print(f"{time.time() - start:6.1f}s {name}: {outcome}", flush=True)
    print("problems:", bad)


if __name__ == "__main__":
    main()
