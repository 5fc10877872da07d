"""python tests/run_oracle.py SF_DIR [name ...]: time and check registered queries."""

import sys
import time

sys.path.insert(0, ".")
from tests.oracle import connect, differences  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tablewarden.session import local_session  # noqa: E402

sf_dir, names = sys.argv[1], sys.argv[2:]
spark = local_session()
con = connect(sf_dir)
queries, oracles = entry.queries(), entry.oracle_sql()
bad = 0
for name in names or queries:
    t = time.time()
    try:
        got = queries[name](spark, sf_dir).toPandas()
        took = time.time() - t
        problem = differences(got, con.execute(oracles[name]).df()) if name in oracles else None
        note = "rows only" if name not in oracles else ""
    except Exception as exc:
        took, problem, note, got = time.time() - t, f"{type(exc).__name__}: {str(exc)[:1500]}", "", []
    bad += problem is not None
    print(f"{'FAIL' if problem else 'ok  '} {name:24s} {took:6.2f}s rows={len(got)} {note} {problem or ''}", flush=True)
print("failed:", bad)
