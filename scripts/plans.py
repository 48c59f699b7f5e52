"""Print a summary of the physical plans of the shared stages and the flagship
extracts; with a folder, write the formatted plans there as well.

python scripts/plans.py [sf_dir [out_dir]]
"""

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from procura.checks.registry import fixture_lake  # noqa: E402
from procura.config import ExtractConfig  # noqa: E402
from procura.plans.pipeline import SHARED_STAGES, Pipeline  # noqa: E402
from procura.session import local_session  # noqa: E402
from procura.sources.tables import load_tables  # noqa: E402

STAGES = ["scope", "live_orders", "scoped_items", "material_lines", "outstanding_material", "service_lines", "outstanding_service",
          "open_material", "open_service", "legacy_order_amount", "credit_details", "order_item_credit",
          "split_orders", "split_order_items", "split_lines",
          "report_orders", "tax_items", "accounting_extract", "tax_extract"]
ATTR = {"open_material": "open_material_lines", "open_service": "open_service_lines"}
PATTERNS = {
    "scans": r"Scan parquet",
    "shuffles": r"(?<!Broadcast)Exchange \(",
    "broadcasts": r"BroadcastExchange \(",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "cartesian": r"CartesianProduct|BroadcastNestedLoopJoin",
    "python": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas",
}

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    tables = load_tables(spark, fixture_lake(spark, sf_dir))
    # Plans as they run: every shared stage is written once and read back.
    p = Pipeline(tables, ExtractConfig.fixture(), reuse="table", shared=SHARED_STAGES)
    print("| stage | " + " | ".join(PATTERNS) + " |")
    print("| --- | " + " | ".join("---" for _ in PATTERNS) + " |")
    for name in STAGES:
        df = getattr(p, ATTR.get(name, name))
        df = p.stage_plans.get(name, df)  # a shared stage's own plan, not its written copy
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        if len(sys.argv) > 2:
            with open(f"{sys.argv[2]}/{name}.txt", "w") as f:
                f.write(text)
        head = text.split("\n\n(1)")[0]
        counts = [str(len(re.findall(v, head))) for v in PATTERNS.values()]
        print(f"| {name} | " + " | ".join(counts) + " |")
