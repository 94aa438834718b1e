"""Compares every registered query with its SQL twin: ``python tests/run_all.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from compare import connect, difference  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tidemark.session import get_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(entry.queries())
    spark = get_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    failures = 0
    for name in names:
        start = time.time()
        sql = entry.oracle_sql().get(name)
        try:
            if sql is None:
                problem = f"no SQL; {entry.queries()[name](spark, sf_dir).count()} rows"
            else:
                problem = difference(spark, con, entry.queries()[name], sql, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        failures += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
