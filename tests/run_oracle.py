"""Run all queries (or those named) against their SQL and print a line for each."""

import sys
import time

import conftest
from oracle import compare, connect
from pyspark.sql import SparkSession

import __spark_entry__ as entry

spark = (
    SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
    .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
folder = conftest.tables_dir()
con = connect(folder)
sql = entry.oracle_sql()
names = sys.argv[1:] or list(entry.queries())
for name in names:
    t = time.time()
    try:
        df = entry.queries()[name](spark, folder)
        more, less, n, rows = compare(df, con, sql[name])
        ok = "ok  " if not more and not less else "DIFF"
        print(f"{ok} {name:30} rows={n:6} {time.time() - t:5.1f}s")
        if ok == "DIFF":
            print("   spark only", list(more)[:2], "\n   sql only  ", list(less)[:2], sum(more.values()), sum(less.values()))
    except Exception as e:
        print(f"FAIL {name}: {type(e).__name__} {str(e)[:600]}")
