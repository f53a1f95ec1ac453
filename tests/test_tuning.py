from __future__ import annotations

import time
from threading import Lock

import pytest
from frames import rows

from marquee.operators import key_split, one_rating_per_pair
from marquee.plans import tuning
from marquee.plans.recommend import AlsSettings, estimator, fit, predict
from marquee.registry import domain, recommendation


@pytest.fixture(scope="module")
def parts(spark, sf_dir):
    return key_split(one_rating_per_pair(domain.ratings(spark, sf_dir)))


def test_grid_and_winner(parts):
    train, validation, test = parts
    tuned = tuning.tune(train, validation, ranks=(2, 4), reg_params=(0.1, 0.1, 0.9), max_iter=2, parallelism=2)
    metrics = tuned.metrics.collect()
    assert [(r.rank, r.reg_param) for r in metrics] == [(2, 0.1), (2, 0.9), (4, 0.1), (4, 0.9)]
    best = [r for r in metrics if r.is_best]
    assert len(best) == 1 and best[0].rmse == min(r.rmse for r in metrics)
    assert (tuned.settings.rank, tuned.settings.reg_param) == (best[0].rank, best[0].reg_param)
    assert tuning.model_rmse(tuned.model, validation) == pytest.approx(best[0].rmse, rel=1e-6)


def test_first_of_equal_errors_wins(parts):
    # With no iterations left to tell them apart the two settings give one model.
    train, validation, _ = parts
    tuned = tuning.tune(train, validation, ranks=(2,), reg_params=(0.3, 0.5), max_iter=0)
    errors = [r.rmse for r in tuned.metrics.collect()]
    assert errors[0] == errors[1] and tuned.settings.reg_param == 0.3


def test_nothing_to_validate_on(parts):
    train, validation, _ = parts
    with pytest.raises(ValueError):
        tuning.tune(train, validation.limit(0), ranks=(2,), reg_params=(0.1,), max_iter=1)


def test_blocks_reach_the_winner(spark, sf_dir, monkeypatch):
    fitted = []
    monkeypatch.setattr(tuning, "fit", lambda part, settings, **more: fitted.append(settings) or fit(part, settings, **more))
    base = AlsSettings(seed=7, blocks=3)
    report = tuning.tune_report(domain.ratings(spark, sf_dir), (2,), (0.1, 0.2), 1, base=base)
    assert {(s.blocks, s.seed) for s in fitted} == {(3, 7)} and report.tuned.settings.blocks == 3
    # Factors are hashed to blocks; the model's tables show how many there are.
    estimated = estimator(report.tuned.settings)
    assert estimated.getNumUserBlocks() == estimated.getNumItemBlocks() == 3


def test_the_largest_fits_never_run_side_by_side(parts, monkeypatch):
    running, together, lock = [], [], Lock()

    def timed(part, settings, **more):
        with lock:
            running.append(settings.rank)
            together.append(tuple(running))
        time.sleep(0.3)
        with lock:
            running.remove(settings.rank)
        return settings

    monkeypatch.setattr(tuning, "fit", timed)
    monkeypatch.setattr(tuning, "model_rmse", lambda model, part: 1.0)
    monkeypatch.setattr(tuning, "release_unused", lambda spark: None)
    tuned = tuning.tune(*parts[:2], ranks=(2, 3, 4, 5), reg_params=(0.1, 0.2), parallelism=2)
    assert max(map(len, together)) == 2 and (5, 5) not in together
    assert (tuned.settings.rank, tuned.settings.reg_param) == (2, 0.1)  # of equal errors, in whatever order they came
    assert [r["rank"] for r in tuned.metrics.collect()] == [2, 2, 3, 3, 4, 4, 5, 5]


def test_a_failed_fit_ends_the_grid(parts, monkeypatch):
    begun = []

    def fails(part, settings, **more):
        begun.append(settings)
        raise ArithmeticError

    monkeypatch.setattr(tuning, "fit", fails)
    with pytest.raises(ArithmeticError):
        tuning.tune(*parts[:2], ranks=(2, 3, 4), reg_params=(0.1, 0.2))
    assert len(begun) == 1


@pytest.mark.parametrize("name", ["als_grid_search", "als_tune_contract"])
def test_tuning_queries_average_ratings_once_for_each_set(spark, sf_dir, monkeypatch, name):
    read, given = spark.sparkContext.accumulator(0), domain.ratings

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(domain, "ratings", lambda *where: given(*where).mapInArrow(counted, "userid bigint, movieid bigint, rating double"))
    monkeypatch.setattr(tuning.tune, "__defaults__", ((2,), (0.1, 0.2), 1, 1, AlsSettings(blocks=2), False))
    monkeypatch.setattr(tuning.tune_report, "__defaults__", ((2,), (0.1, 0.2), 1, *tuning.tune_report.__defaults__[3:]))
    assert len(recommendation.QUERIES[name](spark, sf_dir).collect()) == 1
    # The tuned set with gaps comes from a union of the ratings with a few of them.
    most = given(spark, sf_dir).count() * (1 if name == "als_grid_search" else 2)
    assert 0 < read.value <= most * 1.01


def test_report_and_saved_model(spark, sf_dir, tmp_path):
    path = str(tmp_path / "model")
    ratings = domain.ratings(spark, sf_dir)
    for _ in range(2):  # the second run replaces the first model
        report = tuning.tune_report(ratings, (2, 3), (0.2,), 2, model_path=path)
    summary = report.summary.first()
    pairs = one_rating_per_pair(ratings)
    assert summary.train_rows + summary.validation_rows + summary.test_rows == pairs.count()
    assert 0 < summary.validation_rmse < 5 and 0 < summary.test_rmse < 5
    again = tuning.load_model(spark, path)
    wanted = pairs.select("userid", "movieid")
    assert rows(predict(again, wanted)) == rows(predict(report.tuned.model, wanted))
