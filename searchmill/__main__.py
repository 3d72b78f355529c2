"""Command line: `python -m searchmill <job> ...`, or the same through spark-submit."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from searchmill.operators.quality import loaded_dates
from searchmill.plans.load import describe, export_facts, load_exports, run, seed_history
from searchmill.schemas import Mart, create_layers
from searchmill.sinks.tables import refresh_clean
from searchmill.sources.discover import PATTERNS
from searchmill.sources.tables import read_raw
from searchmill.streaming.ingest import ingest

PREVIEW_ROWS = 5


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="searchmill", description=__doc__)
    top.add_argument("--raw", default=Mart.raw, help="raw table")
    top.add_argument("--clean", default=Mart.clean, help="cleaned table")
    top.add_argument("--location", help="folder for the databases, if not the warehouse")
    jobs = top.add_subparsers(dest="job", required=True)
    jobs.add_parser("create", help="create databases and tables")
    for name, text in (
        ("run", "load the exports of a folder, then refresh the cleaned table"),
        ("load", "load the exports of a folder"),
        ("preview", "show some facts of the exports of a folder, load nothing"),
    ):
        job = jobs.add_parser(name, help=text)
        job.add_argument("input")
        job.add_argument("--format", default="xlsx", choices=sorted(PATTERNS))
        job.add_argument("--multi-line", action="store_true", help="CSV fields hold line breaks")
        if name != "preview":
            job.add_argument("--archive", help="folder the loaded exports are moved to")
    jobs.add_parser("refresh", help="rebuild the cleaned table")
    jobs.add_parser("dates", help="list the dates of the raw table")
    job = jobs.add_parser("seed", help="fill the raw table from the history CSV")
    job.add_argument("input")
    job.add_argument("--multi-line", action="store_true", help="CSV fields hold line breaks")
    job = jobs.add_parser("ingest", help="load the exports that are new in a folder")
    job.add_argument("input")
    job.add_argument("--format", default="xlsx", choices=sorted(PATTERNS))
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--archive")
    job.add_argument("--files-per-batch", type=int, default=1)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    spark = SparkSession.builder.appName(f"searchmill-{args.job}").getOrCreate()
    mart = Mart(args.raw, args.clean)
    if args.job == "preview":
        facts = export_facts(spark, args.input, args.format, multi_line=args.multi_line)
        facts.limit(PREVIEW_ROWS).show(truncate=False)
        return
    create_layers(spark, mart, args.location)
    if args.job == "run":
        print(describe(*run(spark, args.input, mart, args.format, args.archive, args.multi_line)))
    elif args.job == "load":
        print(load_exports(spark, args.input, mart, args.format, args.archive, args.multi_line))
    elif args.job == "refresh":
        print(refresh_clean(spark, mart))
    elif args.job == "dates":
        dates = loaded_dates(read_raw(spark, mart))
        # One row per loaded calendar date.
        print("\n".join(r.date_str for r in dates.collect()))
    elif args.job == "seed":
        print(seed_history(spark, args.input, mart, args.multi_line))
    elif args.job == "ingest":
        query = ingest(
            spark, args.input, args.checkpoint, mart, args.format, args.archive, args.files_per_batch
        )
        query.awaitTermination()


if __name__ == "__main__":
    main()
