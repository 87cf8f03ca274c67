"""Run registered queries against their SQL twins: ``python tests/check_queries.py [sf] [name ...]``."""

from __future__ import annotations

import fnmatch
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as entry
from marlstone.session import build_session
from oracle import connect, difference


def main() -> int:
    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    folder = f"/root/testdata/sf{scale}"
    spark = build_session("check")
    con = connect(folder)
    sqls = entry.oracle_sql()
    failed = []
    for name, fn in entry.queries().items():
        if wanted and not any(fnmatch.fnmatch(name, w) for w in wanted):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in sqls:
                problem = difference(df, con, sqls[name])
                note = "ok" if problem is None else "DIFF " + problem
            else:
                note = f"rows {df.count()}"
        except Exception as error:  # report and go on
            note = "FAIL " + "".join(traceback.format_exception_only(error))[:1500]
            if os.environ.get("TRACE"):
                traceback.print_exc()
        if note.startswith(("DIFF", "FAIL")):
            failed.append(name)
        print(f"{name:36s} {time.time() - start:6.2f}s {note}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
