"""Run every registered query against its DuckDB twin: python tests/run_oracles.py [sf_dir] [name-prefix...]"""

import json
import sys
import time

sys.path.insert(0, ".")
sys.path.insert(0, "tests")

from oracle import compare, duck  # noqa: E402

from riskframe.plans.registry import ORACLE, QUERIES, load_all  # noqa: E402
from riskframe.session import get_spark  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
prefixes = sys.argv[2:]
load_all()
spark = get_spark("local[8]", shuffle_partitions=8)
con = duck(sf)
bad = 0
for name, fn in QUERIES.items():
    if prefixes and not any(name.startswith(p) for p in prefixes):
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        if name in ORACLE:
            r = compare(df, con, ORACLE[name])
            ok = r["hash_match"] and r["cols_match"] and r["types_match"] and r["spark_rows"] == r["duck_rows"]
        else:
            r = {"spark_rows": df.count(), "rows_only": True}
            ok = True
    except Exception as e:  # report and continue
        r = {"error": str(e)[:600]}
        ok = False
    bad += not ok
    print(("OK  " if ok else "BAD ") + name, f"{time.time()-t:.1f}s", json.dumps(r, default=str)[:1500], flush=True)
print("failures:", bad)
