"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from forgeline import catalog  # noqa: E402
from forgeline.catalog.registry import Inputs  # noqa: E402
from forgeline.plans import run  # noqa: E402
from forgeline.session import apply_settings, build_session  # noqa: E402

HEADLINE = [
    "csv_to_parquet",
    "compact_parquet",
    "scan_workbook",
    "build_dim_material_price",
    "build_part_bridge",
    "build_dim_machine",
    "build_dim_time",
    "build_fact_sales_ods",
    "build_fact_supply_chain_ods",
    "mart_fact_supply_chain",
    "mart_fact_sales",
    "apply_machine",
    "apply_contract",
    "apply_supply_chain",
    "stream_to_tables",
    "full_refresh",
]
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    names = [n for n in HEADLINE if len(sys.argv) < 2 or any(a in n for a in sys.argv[1:])]
    times: dict[str, float] = {}

    def measure(name: str, job: Callable[[], object]) -> None:
        took = []
        for _ in range(RUNS):
            start = time.time()
            job()
            took.append(time.time() - start)
        times[name] = round(min(took), 3)
        print(f"{name}: {times[name]}", file=sys.stderr)

    # The inputs stand for files that are there before the engine runs.
    inputs = Inputs(apply_settings(spark), sf_dir)
    parts, log, materials = inputs.part_raw, inputs.log, inputs.material_raw
    inputs.message_files  # noqa: B018 (written on first use)
    measure(
        "load_ods_tables",
        lambda: run.load_ods(log, parts, materials, spark, inputs.run_ts, inputs.work_dir("ods")),
    )
    inputs.ods_root  # noqa: B018 (the stored tables the reports read)
    for name in names:
        measure(name, lambda name=name: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf.group(1)) if sf else None,
            }
        )
    )


if __name__ == "__main__":
    main()
