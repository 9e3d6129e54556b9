"""python tests/check.py [--sf DIR] [name-prefix ...]: compares registered queries with their SQL."""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from compare import connect, differences, duckdb_rows, spark_rows  # noqa: E402


def main(arguments):
    sf_dir = "/root/testdata/sf0.01"
    if arguments[:1] == ["--sf"]:
        sf_dir, arguments = arguments[1], arguments[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    bad = []
    for name, function in entry.queries().items():
        if arguments and not any(name.startswith(p) for p in arguments):
            continue
        start = time.time()
        try:
            mine = spark_rows(function(spark, sf_dir))
            took = time.time() - start
            if name not in sql:
                print(f"{name:34s} {took:6.2f}s rows={len(mine[1])} (no SQL) {mine[1][:3] if arguments else ''}", flush=True)
                continue
            problems = differences(mine, duckdb_rows(con, sql[name]))
        except Exception as error:  # a broken query must not hide the others
            took, problems, mine = time.time() - start, [f"{type(error).__name__}: {str(error)[:1500]}"], ([], [])
        print(f"{name:34s} {took:6.2f}s rows={len(mine[1])} {'ok' if not problems else 'DIFFERS'}", flush=True)
        for line in problems:
            print("     ", line, flush=True)
        if problems:
            bad.append(name)
    print("differs:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
