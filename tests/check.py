"""Compare registered queries with their SQL: ``python tests/check.py [--sf 0.01] [name ...]``."""

import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from aislewise.session import build_session  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402
from workload import load_all  # noqa: E402
from workload.registry import QUERIES, SQL  # noqa: E402

if __name__ == "__main__":
    args = sys.argv[1:]
    sf = "0.01"
    if args[:1] == ["--sf"]:
        sf, args = args[1], args[2:]
    load_all()
    spark = build_session(
        master=os.environ.get("CHECK_MASTER", "local[8]"),
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = connect(sf_dir)
    names = [n for n in QUERIES if not args or any(n.startswith(a) for a in args)]
    bad = []
    for n in names:
        start = time.time()
        try:
            if n in SQL:
                diff = compare(spark, con, sf_dir, QUERIES[n], SQL[n])
                rows = ""
            else:
                diff, rows = [], f" {QUERIES[n](spark, sf_dir).count()} rows, no SQL"
        except Exception as e:  # noqa: BLE001
            diff, rows = [f"{type(e).__name__}: {str(e)[:1500]}"], ""
        print(f"{'ok ' if not diff else 'BAD'} {n} {time.time() - start:.1f}s{rows}", flush=True)
        for line in diff:
            print("    ", line[:1500])
        if diff:
            bad.append(n)
    print(f"{len(names) - len(bad)} of {len(names)} agree; differing: {bad}")
