"""Run registered queries against their equivalent SQL: check.py [--limit SECONDS] <sf_dir> [name ...]."""

import signal
import sys
import time

from claimwright.plans import registry
from claimwright.session import build_session
from tests.compare import differences, duck


def _too_slow(*_):
    raise TimeoutError("over the time limit")


def main() -> int:
    signal.signal(signal.SIGALRM, _too_slow)
    arguments, limit = sys.argv[1:], 0
    if arguments[0] == "--limit":
        limit, arguments = int(arguments[1]), arguments[2:]
    sf_dir, names = arguments[0], arguments[1:]
    spark = build_session(master="local[8]", shuffle_partitions=8, **{"spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql = duck(sf_dir), registry.oracle_sql()
    failed = 0
    for name, run in registry.queries().items():
        if names and not any(n in name for n in names):
            continue
        start = time.perf_counter()
        signal.alarm(limit)  # 0: none
        try:
            frame = run(spark, sf_dir)
            if name in sql:
                problem = differences(frame, connection, sql[name])
            else:
                print(f"     {name}: {frame.count()} rows")
                problem = None
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        signal.alarm(0)
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.perf_counter() - start:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
