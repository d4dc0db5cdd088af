"""Run registered queries against their SQL: python tests/check_oracle.py [sf] [name-prefix ...]"""
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return str(v)


def compare(spark, con, name, fn, sql, sf_dir):
    """None when equal, else a message."""
    t0 = time.time()
    got = fn(spark, sf_dir).toArrow()
    t1 = time.time()
    if sql is None:
        return None, t1 - t0, 0.0, got.num_rows
    want = con.sql(sql).to_arrow_table()
    t2 = time.time()
    cols = sorted(got.column_names)
    if cols != sorted(want.column_names):
        return f"columns {cols} vs {sorted(want.column_names)}", t1 - t0, t2 - t1, got.num_rows
    if got.num_rows != want.num_rows:
        return f"rows {got.num_rows} vs {want.num_rows}", t1 - t0, t2 - t1, got.num_rows
    kinds = []
    for c in cols:
        a, b = str(got.schema.field(c).type), str(want.schema.field(c).type)
        a, b = (x.replace("large_", "").replace("string_view", "string") for x in (a, b))
        if a != b and not (a.startswith("timestamp") and b.startswith("timestamp")):
            kinds.append(f"{c}: {a} vs {b}")
    left = sorted(map(tuple, zip(*[[normal(v) for v in got.column(c).to_pylist()] for c in cols])))
    right = sorted(map(tuple, zip(*[[normal(v) for v in want.column(c).to_pylist()] for c in cols])))
    if left != right:
        bad = [(x, y) for x, y in zip(left, right) if x != y]
        return f"{len(bad)} rows differ, e.g. {cols}\n   {bad[0][0]}\n   {bad[0][1]}", t1 - t0, t2 - t1, got.num_rows
    if kinds:
        return "types " + "; ".join(kinds), t1 - t0, t2 - t1, got.num_rows
    return None, t1 - t0, t2 - t1, got.num_rows


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    prefixes = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, fn in queries.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        if os.environ.get("ONLY_SQL") and name not in oracles:
            continue
        try:
            message, a, b, n = compare(spark, con, name, fn, oracles.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            message, a, b, n = f"{type(e).__name__}: {str(e)[:1500]}", 0, 0, -1
        kind = "sql" if name in oracles else "rows"
        failed += message is not None
        print(f"{'ok  ' if message is None else 'FAIL'} {name:36s} {kind} rows={n} spark={a:.2f}s duck={b:.2f}s"
              + (f"\n   {message}" if message else ""), flush=True)
    print("failed:", failed, "of", len(queries))


if __name__ == "__main__":
    main()
