"""Compare queries with their SQL: python tests/check.py [--dir D] [name or module ...]"""

import sys
import time
import os

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import connect, difference  # noqa: E402

from tidemill import registry  # noqa: E402
from tidemill.session import build_session  # noqa: E402


def main(args):
    root = "/root/testdata/sf0.01"
    if args[:1] == ["--dir"]:
        root, args = args[1], args[2:]
    spark = build_session("check", "local[8]", {"spark.sql.shuffle.partitions": "8",
                                               "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    modules = [a for a in args if a in registry.MODULES]
    if modules and len(modules) == len(args):
        registry.MODULES = tuple(modules)
    db = connect(root)
    bad = 0
    for name, q in registry.all_queries().items():
        if args and name not in args and q.build.__module__.split(".")[-1] not in args:
            continue
        start = time.time()
        try:
            if q.oracle:
                problem = difference(spark, db, q, root)
            else:
                n = len(q(spark, root).collect())
                problem = None if n else "no rows"
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        mark = "ok " if problem is None else "BAD"
        kind = "sql" if q.oracle else "rows"
        print(f"{mark} {kind:4} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main(sys.argv[1:])
