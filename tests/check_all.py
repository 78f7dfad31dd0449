"""Run every registered query against its SQL: python tests/check_all.py [folder] [name ...]"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from delayworks.session import build_session  # noqa: E402
from tests.harness import compare, connect  # noqa: E402


def main(folder: str, names: list[str]) -> int:
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(folder), oracle_sql(), []
    for name, function in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = function(spark, folder)
            problem = compare(df, con, oracles[name]) if name in oracles else (None if df.collect() else "no rows")
        except Exception as error:  # report every query, go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
            if names:
                traceback.print_exc()
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print(f"{len(failed)} failed: {' '.join(failed)}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
