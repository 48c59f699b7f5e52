"""Benchmark the headline extracts.

Builds the procurement fixture from the driver tables in ``$BENCH_SF_DIR``
(default /root/testdata/sf0.1) once, writes it as parquet to a scratch folder
(the base tables of a real deployment are parquet too), then runs every
headline query ``1 + $BENCH_RUNS`` times on ``local[$BENCH_CPUS]`` with a
``noop`` sink and reports the median of the timed runs.  The extracts are also
run once through ``export`` (ordered files with display headers, stage tables
removed), reported apart as ``export``.

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from procura.config import ExtractConfig  # noqa: E402
from procura.plans.extracts import export  # noqa: E402
from procura.plans.pipeline import ACCOUNTING_SHARED, CREDIT_SHARED, TAX_SHARED, Pipeline  # noqa: E402
from procura.session import local_session  # noqa: E402
from procura.sources.fixtures import materialize  # noqa: E402
from procura.sources.tables import load_tables  # noqa: E402

HEADLINE = ("tax_extract", "accounting_extract", "order_item_credit")


def _run(tables, cfg, name: str) -> float:
    t0 = time.perf_counter()
    shared = {"tax_extract": TAX_SHARED, "accounting_extract": ACCOUNTING_SHARED}.get(name, CREDIT_SHARED)
    p = Pipeline(tables, cfg, reuse="table", shared=shared)
    getattr(p, name).write.format("noop").mode("overwrite").save()
    elapsed = time.perf_counter() - t0
    p.release()
    return elapsed


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="procura-bench")
    scratch = tempfile.mkdtemp(prefix="procura-bench-", dir=os.environ.get("PROCURA_SCRATCH", "/tmp"))
    t0 = time.perf_counter()
    materialize(spark, sf_dir, f"{scratch}/lake")
    setup = time.perf_counter() - t0

    tables = load_tables(spark, f"{scratch}/lake")
    cfg = ExtractConfig.fixture()
    queries, all_runs = {}, {}
    for name in HEADLINE:
        _run(tables, cfg, name)  # warm-up
        times = [_run(tables, cfg, name) for _ in range(runs)]
        queries[name] = round(statistics.median(times), 3)
        all_runs[name] = [round(t, 3) for t in times]
    exports = {}
    for kind in ("tax", "accounting"):
        t0 = time.perf_counter()
        export(tables, cfg, f"{scratch}/export-{kind}", kind)
        exports[kind] = round(time.perf_counter() - t0, 3)
    print(
        json.dumps(
            {
                "metric": "median_seconds_total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": sf,
                "runs": all_runs,
                "export": exports,
                "fixture_setup_sec": round(setup, 3),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
