"""Grid-search the recommender's parameters and save the best model.

    spark-submit marquee/jobs/tune.py <ratings> <model folder> [--parallelism n] [--blocks n]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from marquee import schemas
from marquee.plans.recommend import AlsSettings
from marquee.plans.tuning import TUNING_ITERATIONS, TUNING_RANKS, TUNING_REG_PARAMS, TuneReport, tune_report
from marquee.session import job_session
from marquee.sources import read_table


def run(spark: SparkSession, ratings: str, model: str, fmt: str = "csv", **options) -> TuneReport:
    """Tune on the ratings at a path and save the best model; options are those of ``tune_report``."""
    return tune_report(read_table(spark, ratings, schemas.RATINGS, fmt), model_path=model, **options)


def main() -> None:
    options = argparse.ArgumentParser(description="Tune the recommender.")
    options.add_argument("ratings")
    options.add_argument("model")
    options.add_argument("--format", default="csv")
    options.add_argument("--ranks", type=int, nargs="+", default=TUNING_RANKS)
    options.add_argument("--reg-params", type=float, nargs="+", default=TUNING_REG_PARAMS)
    options.add_argument("--max-iter", type=int, default=TUNING_ITERATIONS)
    options.add_argument("--seed", type=int, default=42)
    options.add_argument("--parallelism", type=int, default=1)
    options.add_argument("--blocks", type=int, default=AlsSettings.blocks, help="parts of either side's factors")
    chosen = options.parse_args()
    spark = job_session("tune")
    report = run(
        spark,
        chosen.ratings,
        chosen.model,
        chosen.format,
        ranks=chosen.ranks,
        reg_params=chosen.reg_params,
        max_iter=chosen.max_iter,
        seed=chosen.seed,
        parallelism=chosen.parallelism,
        base=AlsSettings(seed=chosen.seed, blocks=chosen.blocks),
    )
    report.tuned.metrics.show(truncate=False)
    report.summary.show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
