"""Command line of the jobs: ``python -m inspectstar <job> ...`` or through spark-submit.

``stage``, ``dimensions``, ``inspections`` and ``violations`` are the steps of a build, in
this order; ``all`` runs the four of them.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from inspectstar.plans import jobs
from inspectstar.session import configure
from inspectstar.sources import read_stage

# Locations each job needs.
JOBS = {
    "stage": ("records", "stage"),
    "dimensions": ("stage", "dimensions"),
    "inspections": ("stage", "dimensions", "facts"),
    "violations": ("stage", "dimensions", "facts"),
    "all": ("records", "stage", "dimensions", "facts"),
}


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(
        prog="inspectstar", description="Build the inspection star schema from exported records."
    )
    commands = parser.add_subparsers(dest="job", required=True)
    for job, places in JOBS.items():
        command = commands.add_parser(job)
        for place in places:
            command.add_argument(f"--{place}", required=True, help=f"folder of the {place}")
        if "records" in places:
            command.add_argument("--stage-files", type=int, help="spread staging over n files")
            command.add_argument(
                "--json-arrays", action="store_true", help="each file is one JSON array"
            )
        if "dimensions" in places:
            command.add_argument("--key-type", choices=("int", "bigint"), default="int")
    return parser.parse_args(arguments)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job in ("stage", "all"):
        jobs.land_stage(spark, args.records, args.stage, args.stage_files, args.json_arrays)
    if args.job == "stage":
        return
    options = jobs.BuildOptions(key_type=args.key_type)
    stage = read_stage(spark, args.stage)
    if args.job in ("dimensions", "all"):
        jobs.write_dimensions(spark, stage, args.dimensions, options)
    if args.job in ("inspections", "all"):
        jobs.write_inspections(spark, stage, args.dimensions, args.facts, options)
    if args.job in ("violations", "all"):
        jobs.write_violations(spark, stage, args.dimensions, args.facts, options)


def main() -> None:
    args = parse()
    spark = configure(SparkSession.builder.appName(f"inspectstar {args.job}").getOrCreate())
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
