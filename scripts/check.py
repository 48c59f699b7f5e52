"""Run registered queries against the DuckDB oracle: python scripts/check.py [sf_dir] [name ...]"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from procura.checks.compare import compare  # noqa: E402
from procura.checks.registry import QUERIES  # noqa: E402
from procura.session import local_session  # noqa: E402

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8)
    bad = 0
    for n in names:
        t = time.time()
        try:
            r = compare(spark, n, sf_dir)
        except Exception as e:  # report and continue
            r = {"query": n, "match": False, "error": str(e)[:400]}
        r["sec"] = round(time.time() - t, 2)
        bad += not r["match"]
        print(json.dumps(r, default=str), flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
