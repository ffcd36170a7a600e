"""Print a line per query: python tests/run_compare.py [sf dir] [key ...]"""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tests.compare import connect, differences  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    keys = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    sql = entry.oracle_sql()
    failures = 0
    for name, query in entry.queries().items():
        if keys and name not in keys:
            continue
        start = time.time()
        try:
            result = query(spark, sf_dir)
            if name in sql:
                problem = differences(result, connection, sql[name])
            else:
                problem = None if result.collect() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failures += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        kind = "" if name in sql else " (rows)"
        print(f"{mark} {name}{kind} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failures:", failures, "missing:", sorted(set(sql) - set(entry.queries())))


if __name__ == "__main__":
    main()
