"""Write the ten reports over a movie repo as CSV with stable names.

    spark-submit marquee/jobs/analyze.py <movie repo> <output folder> [--format csv|parquet|...] [--one-file]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from marquee import schemas
from marquee.plans.reports import REPORTS, all_reports, with_published_headers
from marquee.session import job_session
from marquee.sinks import export_csv
from marquee.sources import read_table


def run(
    spark: SparkSession, source: str, target: str, fmt: str = "csv", one_file: bool = False
) -> dict[str, list[str]]:
    """Export every report below ``<target>/<folder>``; returns the paths by report.

    Reports by title or user are folders of part files, unless ``one_file`` asks for a
    single file each. Plots may hold line breaks, so CSV is read with them: every part
    file of the wide table is then one task.
    """
    found = all_reports(read_table(spark, source, schemas.REPORT_INPUT, fmt, multi_line=True))
    return {
        name: export_csv(
            with_published_headers(frame),
            f"{target}/{REPORTS[name].folder}",
            REPORTS[name].file,
            single_file=one_file or REPORTS[name].single_file,
        )
        for name, frame in found.items()
    }


def main() -> None:
    options = argparse.ArgumentParser(description="Write the ten reports.")
    options.add_argument("source")
    options.add_argument("target")
    options.add_argument("--format", default="csv")
    options.add_argument("--one-file", action="store_true", help="a single file also for titles and users")
    chosen = options.parse_args()
    spark = job_session("analyze")
    run(spark, chosen.source, chosen.target, chosen.format, chosen.one_file)
    spark.stop()


if __name__ == "__main__":
    main()
