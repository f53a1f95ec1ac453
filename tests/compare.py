"""Compare every registered query with its SQL: ``python tests/compare.py <sf_dir> [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from oracle import connect, difference  # noqa: E402

from marquee.registry import all_queries, all_sql  # noqa: E402


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, texts, bad = connect(sf_dir), all_sql(), 0
    for name, query in all_queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            frame = query(spark, sf_dir)
            if name in texts:
                problem = difference(frame, con, texts[name])
                note = "ok" if problem is None else f"DIFFERS {problem}"
            else:
                problem, note = None, f"rows only: {len(frame.collect())}"
        except Exception as error:  # noqa: BLE001
            problem = note = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{time.time() - start:6.2f}s  {name}: {note}", flush=True)
    print("different:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
