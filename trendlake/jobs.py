"""The pipeline's steps as jobs to submit.

    spark-submit trendlake/jobs.py silver --bronze PATH_OR_TABLE --silver PATH
    spark-submit trendlake/jobs.py reference --bronze PATH_OR_TABLE --silver PATH
    spark-submit trendlake/jobs.py check --silver PATH
    spark-submit trendlake/jobs.py gold --silver PATH --gold PATH
    spark-submit trendlake/jobs.py update --bronze PATH --silver PATH --checkpoint PATH
    spark-submit trendlake/jobs.py update-gold --silver PATH --gold PATH --checkpoint PATH
    spark-submit trendlake/jobs.py update-reference --bronze PATH --silver PATH --checkpoint PATH
    spark-submit trendlake/jobs.py route --files FOLDER --bronze PATH
    spark-submit trendlake/jobs.py coverage --bronze PATH [--runs ID,ID]

``silver`` replaces every day it has rows for, so its input must hold all of
those days; new deliveries are merged by ``update``, and ``update-gold`` then
refreshes gold for the days that were touched.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

if __package__ in (None, ""):  # run as a script by spark-submit
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from trendlake import build_session  # noqa: E402
from trendlake.constants import LANDED_REGIONS  # noqa: E402
from trendlake.functions import region_list  # noqa: E402
from trendlake.operators.landing import coverage_summary, ingestion_coverage  # noqa: E402
from trendlake.plans.pipeline import (  # noqa: E402
    PipelineConfig, build_gold, check_silver, write_reference, write_statistics,
)
from trendlake.plans.refresh import update_gold  # noqa: E402
from trendlake.sources import bronze as scans  # noqa: E402
from trendlake.sources.files import route_files  # noqa: E402
from trendlake.streaming import (  # noqa: E402
    stream_reference_documents, stream_statistics_csv, stream_trending_documents, update_reference, update_statistics,
)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    steps = top.add_subparsers(dest="step", required=True)
    route = steps.add_parser("route", help="bring the files of a flat folder into bronze by kind and region, as they are")
    route.add_argument("--files", required=True, help="folder of the files")
    route.add_argument("--bronze", required=True, help="folder of the bronze tables")
    coverage = steps.add_parser("coverage", help="expected regions against landed documents (one per line)")
    coverage.add_argument("--bronze", required=True, help="folder of the landed documents")
    coverage.add_argument("--runs", type=lambda text: text.split(","), help="ids of runs to report even if nothing landed")
    coverage.add_argument("--regions", type=region_list, help="comma list of the expected regions")
    for name in ("silver", "reference", "check", "gold", "update", "update-gold", "update-reference"):
        step = steps.add_parser(name, help={
            "silver": "full run: the input must hold all rows of its days; use update for further deliveries",
        }.get(name))
        step.add_argument("--silver", required=True, help="folder of the silver tables")
        step.add_argument("--silver-database", help="database to register silver tables in")
        if name in ("silver", "reference", "update", "update-reference"):
            step.add_argument("--bronze", required=True, help="folder, or table name without a slash")
            step.add_argument("--one-per-line", action="store_true", help="JSON files hold one document per line")
        if name in ("silver", "update"):
            step.add_argument("--form", choices=("csv", "documents"), default="csv")
            step.add_argument("--no-quoted-breaks", action="store_true", help="no CSV field holds a line break: split large files")
        if name not in ("check", "update-gold"):
            step.add_argument("--regions", type=region_list, help="comma list; all regions by default")
        if name in ("gold", "update-gold"):
            step.add_argument("--gold", required=True, help="folder of the gold tables")
            step.add_argument("--gold-database", help="database to register gold tables in")
        if name in ("update", "update-gold", "update-reference"):
            step.add_argument("--checkpoint", required=True, help="folder for the state of the stream")
        if name in ("update", "update-reference"):
            step.add_argument("--max-files", type=int, help="files per batch; all new files are one batch by default")
    return top


def run(spark, options: argparse.Namespace):
    """One step; returns the row counts it wrote, where it writes any."""
    if options.step == "route":
        routed = route_files(spark, options.files.rstrip("/"), options.bronze)
        return {row["kind"]: row["count"] for row in routed.groupBy("kind").count().collect()}
    if options.step == "coverage":
        landed = scans.read_trending_documents(spark, options.bronze, one_per_line=True)
        coverage = ingestion_coverage(landed, options.regions or LANDED_REGIONS, options.runs)
        return [row.asDict() for row in coverage_summary(coverage).collect()]  # one row per run
    config = PipelineConfig(
        options.silver, getattr(options, "gold", options.silver),
        silver_database=options.silver_database, gold_database=getattr(options, "gold_database", None),
    )
    if options.step == "silver":
        rows = _statistics(spark, options)
        return {} if rows.isEmpty() else write_statistics(rows, config)
    if options.step == "reference":
        rows = _reference(spark, options)
        return {} if rows.isEmpty() else write_reference(rows, config)
    if options.step == "check":
        return check_silver(spark, config)
    if options.step == "gold":
        return build_gold(spark, config, regions=options.regions)
    if options.step == "update-gold":
        return update_gold(spark, config, options.checkpoint).awaitTermination()
    if options.step == "update-reference":
        documents = stream_reference_documents(
            spark, options.bronze, options.one_per_line, ("region", "date"), options.max_files)
        return update_reference(
            documents, config.silver(config.reference_table), options.checkpoint, job_name=config.reference_job
        ).awaitTermination()
    stream = (
        stream_statistics_csv(spark, options.bronze, options.max_files, not options.no_quoted_breaks) if options.form == "csv"
        else stream_trending_documents(spark, options.bronze, options.one_per_line, options.max_files)
    )
    return update_statistics(
        stream, config.silver(config.statistics_table), options.checkpoint,
        job_name=config.statistics_job, regions=options.regions, partition_by=config.statistics_partitions, changes=config.changes,
    ).awaitTermination()


def _statistics(spark, options):
    if "/" not in options.bronze:
        return scans.read_bronze_table(spark, options.bronze, options.regions)
    if options.form == "csv":
        return scans.read_statistics_csv(spark, options.bronze, options.regions, quoted_breaks=not options.no_quoted_breaks)
    return scans.read_trending_documents(spark, options.bronze, options.regions, options.one_per_line)


def _reference(spark, options):
    if "/" not in options.bronze:
        return scans.read_bronze_table(spark, options.bronze, options.regions)
    return scans.read_reference_documents(
        spark, options.bronze, options.regions, options.one_per_line, partitions=("region", "date")
    )


if __name__ == "__main__":
    print(run(build_session("trendlake"), parser().parse_args()))
