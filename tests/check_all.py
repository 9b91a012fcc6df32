"""Command line: compare every query with its SQL. Usage: check_all.py FOLDER [NAME ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_points  # noqa: E402
from tallyfield.session import build_session  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402


def main() -> int:
    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    sql = entry_points.oracle_sql()
    failed = 0
    for name, run in entry_points.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in sql:
                problem = compare(df, db, sql[name])
                state = "ok" if problem is None else f"DIFFERS {problem}"
            else:
                state = f"ok, no SQL, {len(df.collect())} rows"
        except Exception as error:
            state = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        failed += not state.startswith("ok")
        print(f"{name:32s} {time.time() - start:6.2f}s {state}", flush=True)
    print(f"{failed} problems")
    return failed


if __name__ == "__main__":
    raise SystemExit(main())
