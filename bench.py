"""Time the headline queries and print one JSON line.

Every query is run to its end into a sink that discards the rows, so all columns
and all rows are computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marquee.registry import all_queries  # noqa: E402

HEADLINE = """
profile_production profile_movies profile_users
count_by_genre count_by_language count_by_vote count_titles_by_production
count_language_by_production count_titles_by_year count_production_by_year
reports_from_wide_table
join_ratings_movies join_movie_data movie_repo
join_genome_tags distinct_movie_tags sort_movie_tags tag_bundle
title_search genre_filter unseen_anti_join topk_scores topk_per_genre rank_results
rmse_item_mean append_ratings candidate_pairs key_split random_split
scan_csv_inferred scan_csv_schema scan_text_split sink_csv_single sink_table
als_fit_predict als_recommend_contract recommend_titles genre_shelves als_grid_search
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    only = os.environ.get("BENCH_QUERIES")
    names = only.split(",") if only else HEADLINE

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("join_ratings_movies")  # start-up of the JVM and of the code generator
    seconds = {name: round(run(name), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
