from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from marquee.llm.exact_dedup import ContentTable, drop_exact_copies, mark_exact_copies


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def plain(rows):
    """(id, keep_id, group_size, sha) of every row, and the number of rows kept in each group."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[normal(text)].append(i)
    found = []
    for i, text in rows:
        own = groups[normal(text)]
        ids = [x for x in own if x is not None]
        found.append((i, min(ids, default=None), len(own), hashlib.sha256(normal(text).encode()).hexdigest()))
    return Counter(found), len(groups)


def check(frame, rows):
    found = frame.collect()
    wanted, groups = plain(rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == wanted
    kept = [r for r in found if r.kept]
    assert len(kept) == groups == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    pool = ["a b", "a  b", "a\tb", "a\n\n b", " a b", "", " ", " ", "x", "X", "b a", None, "é", "é", "w " * 3000, "w " * 3000 + "v"]
    rows = [(rng.choice([*range(60), None]), rng.choice(pool)) for _ in range(400)]
    return rows + [(1000 + i, f"single {i}") for i in range(50)] + [(2000 + i, "hot   text") for i in range(300)]


WEAK = lambda c: F.xxhash64(c) % 3
ONE = lambda c: F.lit(7).cast("long")


@pytest.mark.parametrize("digest, table_bytes, crowd", [(F.xxhash64, 1 << 20, 32), (F.xxhash64, 12, 8), (WEAK, 150, 32), (ONE, 1 << 20, 16)])
def test_equals_brute_force(spark, rows, digest, table_bytes, crowd):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    check(mark_exact_copies(frame, digest=digest, table_bytes=table_bytes, crowd=crowd), rows)


def test_clashing_names_and_other_ids(spark):
    data = [("b", "t  u", 1, "x"), ("a", "t u", 2, "x"), (None, "t u", 3, "x"), ("c", None, 4, "x"), ("d", "", 5, "x"), (None, "only", 6, "x"), (None, "only", 7, "x")]
    frame = spark.createDataFrame(data, "doc_id string, text string, row int, content string")
    check(mark_exact_copies(frame), [r[:2] for r in data])
    for own in ("h", "sha", "entry", "bucket", "keep_id", "kept"):
        odd = frame.withColumnsRenamed({"row": own, "doc_id": "id", "text": "gone"})
        kept = drop_exact_copies(odd, id_col="id", text_col="gone")
        assert kept.columns == odd.columns
        assert sorted(r[2] for r in kept.collect()) == [2, 3, 4, 6, 7]


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert mark_exact_copies(frame).collect() == [] and drop_exact_copies(frame).collect() == []


def test_table_compares_contents():
    table = ContentTable()
    for i in range(3000):  # one hash, so that only contents tell them apart; the table grows twice
        at, slot = table.place(5 if i < 1500 else i, f"text {i}")
        assert at == -1 and table.add(slot, 5 if i < 1500 else i, f"text {i}") == i
    assert all(table.place(5, f"text {i}")[0] == i for i in range(0, 1500, 7))
    assert table.place(5, "text 1600")[0] == -1 and table.place(1600, "text 1600")[0] == 1600
