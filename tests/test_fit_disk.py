"""What fits keep in memory, and shuffle files that they leave on disk."""

from __future__ import annotations

import re
import time
from pathlib import Path

import pytest

from marquee.plans import recommend, tuning
from marquee.plans.recommend import AlsSettings
from marquee.session import release_unused


def shuffles(spark) -> set[int]:
    """Ids of the shuffles whose files are on this session's disk."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = (path.name for folder in folders for path in Path(folder).rglob("shuffle_*.data"))
    return {int(re.match(r"shuffle_(\d+)_", name)[1]) for name in files}


def left(spark, before: set[int], most: int) -> int:
    """How many are there besides those before, once at most ``most`` are or 6 seconds are over."""
    end = time.time() + 6
    while (found := len(shuffles(spark) - before)) > most and time.time() < end:
        time.sleep(0.2)
    return found


@pytest.fixture(scope="module")
def ratings(spark):
    pairs = [(u, m, float((u * m) % 5 + 1)) for u in range(1, 31) for m in range(1, 21) if (u + m) % 3]
    return spark.createDataFrame(pairs, "userid bigint, movieid bigint, rating double").repartition(4).localCheckpoint()


def test_a_fit_holds_one_iteration_on_disk_however_many_it_runs(spark, ratings):
    def held(iterations: int, most: int) -> int:
        before = shuffles(spark)
        model = recommend.fit(ratings, AlsSettings(rank=2, max_iter=iterations, blocks=2), unique_pairs=True)
        return left(spark, before, most) if model.userFactors.count() else -1

    one = held(1, 0)
    assert 0 < held(5, one) <= one


def test_a_grid_leaves_no_shuffle_files_of_lost_fits(spark, ratings):
    def held(cells: int, most: int) -> int:
        before = shuffles(spark)
        regs = [0.1 * k for k in range(1, cells + 1)]
        base = AlsSettings(blocks=2)
        tuned = tuning.tune(ratings, ratings, ranks=(2,), reg_params=regs, max_iter=1, base=base)
        return left(spark, before, most) if tuned.metrics.count() == cells else -1

    two = held(2, 0)
    assert 0 < held(8, two) <= two


def test_the_next_fit_first_deletes_what_a_lost_one_left(spark, ratings):
    before = shuffles(spark)
    settings = AlsSettings(rank=2, max_iter=1, blocks=2)
    model = recommend.fit(ratings, settings, unique_pairs=True)
    lost = shuffles(spark) - before
    assert lost
    del model
    model = recommend.fit(ratings, settings, unique_pairs=True)
    end = time.time() + 6
    while lost & shuffles(spark) and time.time() < end:
        time.sleep(0.2)
    assert not lost & shuffles(spark)


def test_recommendations_leave_no_shuffle_files_of_their_fit(spark, ratings):
    movies = spark.createDataFrame([(m, f"Title {m % 4}") for m in range(1, 21)], "movieid bigint, title string")
    before = shuffles(spark)
    best = recommend.infer(ratings, movies, "title 1", 2, AlsSettings(rank=2, max_iter=2, blocks=2))
    assert left(spark, before, 0) == 0
    assert best.count() == 4


def test_nothing_a_fit_keeps_between_its_steps_is_in_memory(spark, ratings):
    def kept() -> dict[int, tuple[int, int]]:
        return {r.id(): (r.memSize(), r.diskSize()) for r in spark.sparkContext._jsc.sc().getRDDStorageInfo()}

    before = kept()
    with recommend.held_pairs(ratings) as pairs:
        model = recommend.fit(pairs, AlsSettings(rank=2, max_iter=1, blocks=2), unique_pairs=True)
        mine = [sizes for rdd, sizes in kept().items() if rdd not in before]
    assert model.rank == 2 and len(mine) >= 3  # ratings and both sides' factors
    assert all(memory == 0 and disk > 0 for memory, disk in mine)


def test_what_python_lets_go_is_gone_after_the_release(spark, ratings):
    for _ in range(5):
        before = shuffles(spark)
        frame = ratings.repartition(3).localCheckpoint()
        assert frame.count() and shuffles(spark) - before
        del frame
        release_unused(spark)
        end = time.time() + 1
        while (more := shuffles(spark) - before) and time.time() < end:
            time.sleep(0.1)
        assert not more
