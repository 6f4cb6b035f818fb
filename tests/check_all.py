"""``python tests/check_all.py [sf_dir] [name ...]``: every registered query against its SQL."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as registered  # noqa: E402
from earshot.session import local_session  # noqa: E402
from tests.oracle import connect, differences  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(registered.queries())
    spark, db = local_session(8), connect(sf_dir)
    sql, bad = registered.oracle_sql(), 0
    for name in names:
        query = registered.queries()[name]
        start = time.monotonic()
        try:
            if name in sql:
                n, found = differences(spark, db, query, sql[name], sf_dir)
            else:
                n, found = query(spark, sf_dir).count(), []
        except Exception as error:  # report it and go on with the rest
            n, found = -1, [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        mark = "DIFF" if found else ("ok" if name in sql else "rows")
        print(f"{mark:5}{name:28}{n:8} rows {time.monotonic() - start:6.1f}s", *found, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
