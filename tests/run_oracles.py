"""Run every registered query against its oracle: python tests/run_oracles.py [sf_dir] [names...]"""

import sys
import time

sys.path.insert(0, ".")

from goldvein.session import build_session  # noqa: E402
from tests.oracle_compare import compare, duck  # noqa: E402
import __spark_entry__ as E  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = build_session("local[8]", 8)
con = duck(sf)
qs, os_ = E.queries(), E.oracle_sql()
fails = 0
for name in names or list(qs):
    t = time.time()
    if name not in os_:
        n = qs[name](spark, sf).count()
        print(f"NO-ORACLE {name}: {n} rows ({time.time()-t:.1f}s)", flush=True)
        continue
    try:
        ok, msg = compare(spark, con, name, qs[name](spark, sf), os_[name])
    except Exception as e:  # report and continue
        ok, msg = False, f"{name}: ERROR {type(e).__name__}: {str(e)[:800]}"
    fails += not ok
    print(("OK   " if ok else "FAIL ") + msg + f" ({time.time()-t:.1f}s)", flush=True)
print("failures:", fails)
