"""Compare registered queries with their SQL: python tests/check_queries.py [folder] [name ...]"""

from __future__ import annotations

import importlib.util
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


def main() -> int:
    from compare import compare, connect

    from surveylake.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spec = importlib.util.spec_from_file_location("entry_module", ROOT / "__spark_entry__.py")
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    spark, con, bad = local_session(), connect(folder), 0
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or queries:
        started = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracles:
                problems = compare(df, con, oracles[name])
                mark = "ok"
            else:
                problems, mark = [], f"rows only: {df.count()}"
        except Exception as error:
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{time.time() - started:6.2f}s {name:28s} {problems or mark}", flush=True)
    print(f"{bad} with problems")
    return bad


if __name__ == "__main__":
    sys.exit(main())
