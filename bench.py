"""Benchmark: headline models at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Stage 0 ("export") shapes the driver tables into a billing export and writes it as Parquet
partitioned by billing_period, as a real export lands in storage. Every model then runs from that
export through ``scan_cur`` (partition pruning + column pruning at the scan), and each timing is the
building of the model's plan and one full execution of it into Spark's no-op sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from costlake.plans import compute, core, database, network, other, storage, tag  # noqa: E402
from costlake.plans.registry import CostModels, to_double  # noqa: E402
from costlake.session import get_session  # noqa: E402
from costlake.sources.fixture import cur_source  # noqa: E402
from costlake.sources.sinks import write_incremental  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = {
    "silver_cost_daily": lambda m: m.cost_daily,
    "gold_service_daily": lambda m: m.service_daily,
    "gold_service_monthly": lambda m: m.service_monthly,
    "gold_resource_monthly": lambda m: m.resource_monthly,
    "gold_invoice_monthly": lambda m: m.invoice_monthly,
    "gold_tag_cost_daily": lambda m: m.tag_cost_daily,
    "serve_cost_service_account_daily": lambda m: m.cost_service_account_daily,
    "gold_data_transfer": lambda m: network.data_transfer(m.silver),
    "gold_s3_summary_monthly": lambda m: storage.s3_summary_monthly(storage.s3_daily(m.silver), m.silver, m.as_of),
    "gold_database_summary_daily": lambda m: database.database_summary_daily(m.silver),
    "gold_instance_resource_monthly": lambda m: compute.instance_resource_monthly(
        compute.compute_instance_hourly(m.silver), m.seed("modernization"), m.as_of),
    "gold_support_chargeback_monthly": lambda m: other.support_chargeback_monthly(m.cost_daily),
}
_ = (core, tag)


def run_once(build) -> float:
    """Seconds to build a model's plan, with the jobs that building starts, and to run it."""
    t0 = time.time()
    to_double(build()).write.format("noop").mode("overwrite").save()
    return time.time() - t0


def main() -> None:
    spark = get_session(master=f"local[{CPUS}]", shuffle_partitions=int(CPUS) * 2)
    scratch = tempfile.mkdtemp(prefix="costlake-bench-")
    export = os.path.join(scratch, "cur")
    times = {}
    t0 = time.time()
    write_incremental(cur_source(spark, SF_DIR), export, mode="overwrite")
    times["export_to_parquet"] = round(time.time() - t0, 3)

    models = CostModels.from_path(spark, export)
    as_of = models.as_of
    run_once(lambda: models.service_daily)  # warm-up (JIT, file listing); not timed
    for name, fn in HEADLINE.items():
        best = min(run_once(lambda: fn(CostModels.from_path(spark, export, as_of=as_of)))  # noqa: B023
                   for _ in range(int(os.environ.get("BENCH_REPEAT", "1"))))
        times[name] = round(best, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_model_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")}))
    spark.stop()


if __name__ == "__main__":
    main()
