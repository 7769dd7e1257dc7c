"""Verbs for ``spark-submit`` and ``python -m siltstone``; results are printed as rows."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from siltstone.plans import jobs
from siltstone.shipping import ship_packages
from siltstone.sources.logs import scan_logs, select_logs
from siltstone.spec import DatasetSpec


def show(df: DataFrame) -> None:
    """Every row, a partition at a time, as tab-separated text."""
    print(*df.columns, sep="\t")
    for row in df.toLocalIterator():
        print(*row, sep="\t")


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="siltstone")
    verbs = parser.add_subparsers(dest="verb", required=True)
    for name in ("run", "summarize", "generate-schema", "manifest"):
        verb = verbs.add_parser(name)
        verb.add_argument("config", help="JSON or YAML declaration of a data set")
        if name == "run":
            verb.add_argument("--dry-run", action="store_true")
            verb.add_argument("--skip-summary", action="store_true")
        if name == "generate-schema":
            verb.add_argument("--output")
            verb.add_argument("--sampling-ratio", type=float, default=1.0)
        if name == "manifest":
            for option in ("table", "status", "batch-id", "file-key"):
                verb.add_argument(f"--{option}")
    logs = verbs.add_parser("logs")
    logs.add_argument("path")
    logs.add_argument("--level")
    logs.add_argument("--batch")
    logs.add_argument("--last", type=int)
    return parser.parse_args()


def main() -> None:
    args = arguments()
    spark = SparkSession.builder.appName(f"siltstone {args.verb}").getOrCreate()
    if args.verb == "logs":
        show(select_logs(scan_logs(spark, [args.path]), args.level, args.batch, args.last))
        return
    ship_packages(spark, str(Path(__file__).resolve().parent.parent), ("siltstone",))
    data = DatasetSpec.from_file(args.config)
    if args.verb == "run" and args.dry_run:
        show(jobs.dry_run(spark, data))
    elif args.verb == "run":
        for outcome in jobs.run(spark, data, skip_summary=args.skip_summary):
            print(f"{outcome.table}: {outcome.status}, {outcome.files} files", *outcome.warnings, sep="\n  ")
    elif args.verb == "summarize":
        report = jobs.summarize(spark, data)
        if report is not None:
            show(report)
    elif args.verb == "generate-schema":
        show(jobs.generate_schema(spark, data, args.output, args.sampling_ratio))
    else:
        filters = {"status": args.status, "batch_id": args.batch_id, "file_key": args.file_key}
        show(jobs.manifest(spark, data, args.table, **(filters if args.table else {})))


if __name__ == "__main__":
    main()
