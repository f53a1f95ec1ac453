"""Connected components against a plain search, in one partition and in many."""

from __future__ import annotations

import random

import plain
import pytest

from marquee.llm import components as module


@pytest.mark.parametrize("rows", [1 << 18, 100, 7])
def test_components_at_any_number_of_partitions(spark, monkeypatch, rows):
    """Chains, a star of half the links, repeated links and loops; partitions hold ``rows`` links each."""
    monkeypatch.setattr(module, "PARTITION_ROWS", rows)
    g = random.Random(rows)
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 1001 + i) for i in range(200)]
    links += [(g.randrange(2000, 2200), g.randrange(2000, 2200)) for _ in range(120)] + [(5, 5), (7, 8), (8, 7)]
    g.shuffle(links)
    frame = spark.createDataFrame([*links, (None, 3), (4, None)], "a long, b long")
    found = module.components(frame).collect()
    proper = [(a, b) for a, b in links if a != b]
    nodes = {x for pair in proper for x in pair}
    assert {r.node: r.component for r in found} == plain.smallest_reachable(nodes, proper)
    assert len(found) == len(nodes)


def test_few_links_make_one_file_a_round(spark, conf):
    conf(spark__sql__shuffle__partitions="50", spark__sql__adaptive__coalescePartitions__enabled="false")
    found = module.components(spark.createDataFrame([(i, i + 1) for i in range(100)], "a long, b long"))
    assert found.rdd.getNumPartitions() <= 3 and {r.component for r in found.collect()} == {0}
    assert module.components(spark.createDataFrame([], "a long, b long")).count() == 0
