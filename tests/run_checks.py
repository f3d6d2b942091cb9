"""Command line: python tests/run_checks.py FOLDER [name ...] compares queries."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry  # noqa: E402
from compare import connect, difference  # noqa: E402

from meterspan.session import local_session  # noqa: E402

folder, names = sys.argv[1], sys.argv[2:]
spark = local_session("checks", 8)
spark.sparkContext.setLogLevel("ERROR")
con = connect(folder)
queries, sql = entry.queries(), entry.oracle_sql()
bad = 0
for name in names or queries:
    start = time.time()
    try:
        frame = queries[name](spark, folder)
        if name in sql:
            problem = difference(frame, con, sql[name])
            note = f"{frame.count()} rows" if problem is None else ""
        else:
            problem, note = None, f"{len(frame.collect())} rows, no SQL"
    except Exception as error:  # noqa: BLE001
        problem, note = f"{type(error).__name__}: {str(error)[:600]}", ""
    bad += problem is not None
    print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {note} {problem or ''}", flush=True)
print(f"{bad} bad of {len(names or queries)}")
