"""Command line: ``spark-submit -m skytrace.plans.cli ingest|pipeline|dataset CONFIG``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from skytrace import config
from skytrace.plans import stages


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="skytrace")
    parser.add_argument("stage", choices=["ingest", "pipeline", "dataset", "all"])
    parser.add_argument("config")
    parser.add_argument("--tensors", help="folder on the driver for .npy files")
    parser.add_argument("--strict", action="store_true", help="differing headers and failed checks are errors")
    args = parser.parse_args(argv)
    cfg = config.load(args.config)
    spark = SparkSession.builder.appName("skytrace").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.stage in ("ingest", "all"):
        stages.run_ingest(spark, cfg, args.strict)
    if args.stage in ("pipeline", "all"):
        stages.run_pipeline(spark, cfg)
    if args.stage in ("dataset", "all"):
        stages.run_dataset(spark, cfg, args.tensors, args.strict).show(truncate=False)


if __name__ == "__main__":
    main()
