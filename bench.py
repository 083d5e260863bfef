"""Times the build at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every step writes its output the way the jobs do, so each figure covers the whole work of
that step, intermediate tables included. The build runs $BENCH_PASSES times (3) in one
session; a figure is the median pass, ``first_pass`` is the total of the first one, JVM
warm-up included. The total covers record ingest and the build. ``rows`` gives the size of
what was written.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from inspectstar import schema as names
from inspectstar.plans import jobs
from inspectstar.plans.dimensions import DIMENSIONS
from inspectstar.plans.driver_stage import derive_stage
from inspectstar.session import configure
from inspectstar.sinks import write_stage
from inspectstar.sources import read_stage


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("inspectstar-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    root = tempfile.mkdtemp(prefix="inspectstar-bench-")
    checkpoints = os.environ.get("BENCH_CHECKPOINT_DIR", f"{root}/checkpoints")
    builder = builder.config("spark.checkpoint.dir", checkpoints)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    places = ("stage", "records", "landed", "dimensions", "facts")
    stage_path, records, landed, dims, facts = (f"{root}/{p}" for p in places)
    options = jobs.BuildOptions()
    passes: dict[str, list[float]] = {}

    def timed(name: str, step) -> None:
        start = time.perf_counter()
        step()
        passes.setdefault(name, []).append(time.perf_counter() - start)

    spark.range(1000).selectExpr("sum(id)").collect()  # session start is not measured
    for _ in range(int(os.environ.get("BENCH_PASSES", "3"))):
        timed("stage", lambda: write_stage(derive_stage(spark, sf_dir), stage_path))
        stage = read_stage(spark, stage_path)
        stage.write.mode("overwrite").json(records)  # not measured: stands for the export
        timed("record_ingest", lambda: jobs.land_stage(spark, records, landed))
        for spec in DIMENSIONS:
            timed(
                spec.table,
                lambda t=spec.table: jobs.write_dimensions(spark, stage, dims, options, [t]),
            )
        timed("all_dimensions", lambda: jobs.write_dimensions(spark, stage, dims, options))
        timed(names.INSPECTIONS, lambda: jobs.write_inspections(spark, stage, dims, facts, options))
        timed(names.VIOLATIONS, lambda: jobs.write_violations(spark, stage, dims, facts, options))
    seconds = {name: round(statistics.median(times), 3) for name, times in passes.items()}

    summaries = jobs.table_summaries(spark, jobs.stored_schemas(dims, facts))
    rows = {r.table_name: r.row_count for r in summaries.collect()}
    spark.stop()

    build = ("stage", "record_ingest", "all_dimensions", names.INSPECTIONS, names.VIOLATIONS)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "full star-schema build: staging, record ingest, nine dimensions, two facts",
                "value": round(sum(seconds[name] for name in build), 3),
                "unit": "sec",
                "queries": seconds,
                "first_pass": round(sum(passes[name][0] for name in build), 3),
                "sf": float(scale.group(1)) if scale else None,
                "rows": rows,
            }
        )
    )


if __name__ == "__main__":
    main()
