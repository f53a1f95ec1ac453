"""Exact deduplication by Grace hashing.

A text whose 64-bit hash stands alone equals no other, so only texts that share their hash
are moved. These candidates are collapsed where they are read: an open-addressing table
compares complete contents, and of the copies in a task one *entry* goes on, with their
number and the first of them.

Entries are then dealt to buckets by hash. A bucket goes through a table of bounded bytes:
an entry equal to one in the table joins it, others are added while they fit. What no
longer fits is spilled to a file in the shared folder and dealt again on another hash of
its hash, level by level, until nothing is left. Every entry meets all of its bucket's
table, so no pair of equal texts is missed at any level.

A text that very many tasks hold is first merged in salted groups of entries, so that no
task meets more than CROWD entries of one text at a time.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.names import unused
from marquee.llm.words import give_back
from marquee.operators.sizing import broadcast_if_small
from marquee.session import enable_checkpoints, scratch_path

TABLE_BYTES = 32 << 20  # contents in one table
TABLE_ROWS = 50_000  # records that a task collapses before it hands its entries on
PARTITION_BYTES = 256 << 20  # contents dealt to one task, table after table
CROWD = 32  # entries of one hash that meet in one bucket
BROADCAST_BYTES = 64 << 20

_ENTRY_BITS = 33  # rows and entries of a task; its number stands above them


class ContentTable:
    """Open-addressing table of contents with linear probing; equal means equal in every character."""

    def __init__(self):
        self.slots, self.hashes, self.contents, self.bytes = [-1] * 1024, [], [], 0

    def place(self, key: int, content: str) -> tuple[int, int]:
        """(index of the equal content or -1, its slot or the free one)."""
        mask = len(self.slots) - 1
        at = key & mask
        while (i := self.slots[at]) >= 0:
            if self.hashes[i] == key and self.contents[i] == content:
                return i, at
            at = (at + 1) & mask
        return -1, at

    def add(self, slot: int, key: int, content: str) -> int:
        self.slots[slot] = len(self.contents)
        self.hashes.append(key)
        self.contents.append(content)
        self.bytes += len(content)
        if 2 * len(self.contents) > len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            for i, own in enumerate(self.hashes):
                at = own & (len(self.slots) - 1)
                while self.slots[at] >= 0:
                    at = (at + 1) & (len(self.slots) - 1)
                self.slots[at] = i
        return len(self.contents) - 1


def _earlier(a: tuple, b: tuple) -> tuple:
    """The first of two (id, row): smaller id, missing ids last, then smaller row."""
    return min(a, b, key=lambda x: (x[0] is None, x[0] if x[0] is not None else 0, x[1]))


def _batch(kind: pa.DataType, names: list[str], rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"content": pa.string(), "first": kind}
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kinds.get(n, pa.int64())) for n, c in zip(names, columns)], names=names
    )


def _collapsed(candidates: DataFrame, kind: str) -> DataFrame:
    """Rows of two sorts: (doc_id, row, sha, entry) for each record, and entries with their content, n and first."""
    empty = ["h", "content", "n", "first", "first_row"]

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << _ENTRY_BITS
        row = entry = base
        table, found, seen = ContentTable(), [], 0
        for batch in batches:
            id_kind = batch.schema.field(0).type
            entries = []
            finished = []

            def finish():
                nonlocal table, found, seen, entry
                finished.append(
                    [(entry + i, table.hashes[i], table.contents[i], n, *first) for i, (n, first) in enumerate(found)]
                )
                entry += len(found)
                table, found, seen = ContentTable(), [], 0

            for i, (doc_id, key) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if table.bytes > TABLE_BYTES or seen >= TABLE_ROWS:
                    finish()
                content = batch.column(3)[i].as_py()
                at, slot = table.place(key, content)
                if at < 0:
                    at = table.add(slot, key, content)
                    found.append((1, (doc_id, row + i)))
                else:
                    n, first = found[at]
                    found[at] = (n + 1, _earlier(first, (doc_id, row + i)))
                seen += 1
                entries.append(entry + at)
            n = batch.num_rows
            whole = {
                "doc_id": batch.column(0),
                "row": pa.array(range(row, row + n), pa.int64()),
                "sha": batch.column(2),
                "entry": pa.array(entries, pa.int64()),
            }
            row += n
            kinds = {"content": pa.string(), "first": id_kind}
            yield pa.RecordBatch.from_pydict(whole | {c: pa.nulls(n, kinds.get(c, pa.int64())) for c in empty})
            for rows in finished:
                yield _entries(id_kind, rows)
        if found:
            yield _entries(id_kind, [(entry + i, table.hashes[i], table.contents[i], n, *first) for i, (n, first) in enumerate(found)])
        give_back()

    def _entries(id_kind: pa.DataType, rows: list[tuple]) -> pa.RecordBatch:
        made = _batch(id_kind, ["entry", *empty], rows)
        n = made.num_rows
        lead = [pa.nulls(n, id_kind), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())]
        return pa.RecordBatch.from_arrays([*lead, *made.columns], names=["doc_id", "row", "sha", "entry", *empty])

    schema = f"doc_id {kind}, row long, sha string, entry long, h long, content string, n long, first {kind}, first_row long"
    return candidates.select("doc_id", "h", "sha", "content").mapInArrow(collapse, schema)


def _met(dealt: DataFrame, kind: str, limit: int, final: bool) -> DataFrame:
    """What becomes of the entries of each bucket; rows of a partition come bucket by bucket.

    (entry, parent): joined another entry. (entry, n, first, first_row) without content: a
    whole class, if ``final``. With content: goes on, because the bucket did not fit or, if
    not ``final``, as the entry that others have joined.
    """
    names = ["entry", "parent", "h", "content", "n", "first", "first_row"]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held, bucket, id_kind = ContentTable(), [], None, None

        def leave():
            for i, (entry, n, first) in enumerate(held):
                yield (entry, None, table.hashes[i], None if final else table.contents[i], n, *first)

        for batch in batches:
            id_kind, out = batch.schema.field(5).type, []
            narrow = [batch.column(i).to_pylist() for i in (0, 1, 2, 4, 5, 6)]
            for i, (own, entry, key, n, first, first_row) in enumerate(zip(*narrow)):
                if own != bucket:
                    out += leave()
                    table, held, bucket = ContentTable(), [], own
                content = batch.column(3)[i].as_py()
                at, slot = table.place(key, content)
                if at >= 0:
                    parent, before, earliest = held[at]
                    held[at] = (parent, before + n, _earlier(earliest, (first, first_row)))
                    out.append((entry, parent, None, None, None, None, None))
                elif not held or table.bytes + len(content) <= limit:
                    table.add(slot, key, content)
                    held.append((entry, n, (first, first_row)))
                else:
                    out.append((entry, None, key, content, n, first, first_row))
            yield _batch(id_kind, names, out)
        if held:
            yield _batch(id_kind, names, list(leave()))
        give_back()

    columns = ["bucket", "entry", "h", "content", "n", "first", "first_row"]
    schema = f"entry long, parent long, h long, content string, n long, first {kind}, first_row long"
    return dealt.select(*columns).sortWithinPartitions("bucket").mapInArrow(meet, schema)


def _stored(frame: DataFrame, label: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, label)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.parquet(path)


def _classes(entries: DataFrame, kind: str, limit: int, crowd: int) -> DataFrame:
    """(entry, n, first, first_row): for every entry the size and the first record of its class."""
    spark = entries.sparkSession
    columns = ["entry", "h", "content", "n", "first", "first_row"]
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def turn(pending: DataFrame, *deal: Column, size: int, final: bool, label: str) -> DataFrame:
        buckets = max(own, math.ceil(2 * size / limit))
        parts = max(own, math.ceil(size / PARTITION_BYTES))
        dealt = pending.withColumn("bucket", F.pmod(F.xxhash64(*deal), F.lit(buckets)))
        return _stored(_met(dealt.repartition(parts, "bucket"), kind, limit, final), label)

    def measure(pending: DataFrame):
        by_hash = pending.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("content")).alias("size"))
        return by_hash.agg(F.max("n").alias("most"), F.sum("size").alias("size")).first()

    state, joined = measure(entries), []
    pending = entries.select(*columns)
    rounds = max(0, math.ceil(math.log(state.most, crowd) - 1e-9) - 1) if state.most else 0
    for _ in range(rounds):  # texts that very many tasks hold: at most ``crowd`` of their entries meet
        sizes = pending.groupBy("h").agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") > crowd)
        salted = pending.join(broadcast_if_small(sizes, BROADCAST_BYTES), "h")
        salt = F.pmod(F.xxhash64("entry"), F.ceil(F.col("held") / crowd))
        met = turn(salted, F.col("h"), salt, size=state.size, final=False, label="grace-crowd")
        others = pending.join(broadcast_if_small(sizes, BROADCAST_BYTES), "h", "left_anti")
        joined.append(met.filter("parent IS NOT NULL").select("entry", "parent"))
        pending = others.select(*columns).unionByName(met.filter("parent IS NULL").select(*columns))

    links, roots, level = [], [], 0
    while True:
        met = turn(pending, F.col("h"), F.lit(level), size=state.size or 0, final=True, label="grace-level")
        links.append(met.filter("parent IS NOT NULL").select("entry", "parent"))
        roots.append(met.filter("parent IS NULL AND content IS NULL").select("entry", "n", "first", "first_row"))
        pending = met.filter("parent IS NULL AND content IS NOT NULL").select(*columns)
        state, level = measure(pending), level + 1
        if not state.most:
            break
    found = reduce(DataFrame.union, roots)
    for pairs in [reduce(DataFrame.union, links), *reversed(joined)]:
        parents = found.withColumnRenamed("entry", "parent")
        found = found.union(pairs.join(parents, "parent").select("entry", "n", "first", "first_row"))
    return found


def mark_exact_copies(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = F.xxhash64,
    table_bytes: int = TABLE_BYTES,
    crowd: int = CROWD,
) -> DataFrame:
    """Rows (id, keep_id, group_size, kept, text_sha256), one for each input row.

    Texts are equal if they are identical once every run of blanks (\\x20, \\x09 to \\x0D) is
    one space; a null text counts as empty. ``keep_id`` is the smallest id among equal
    texts, ``kept`` marks the one row that stays, ``text_sha256`` is the digest of the
    text so normalised. ``digest`` (a long) only decides which texts are compared.

    Of rows with equal id and equal text one is kept, of equal texts without any id too;
    rows without id never stay beside rows with one, and keep_id is null only if no row of
    the group has an id. Texts of any length are compared whole, other columns are not
    looked at, an empty table gives an empty result.
    """
    enable_checkpoints(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    # Only runs that are not one space already are matched.
    content = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")
    plain = docs.select(F.col(id_col).alias("doc_id"), content.alias("content")).withColumn("h", digest(F.col("content")))
    plain = plain.withColumn("sha", F.sha2("content", 256))
    shared = plain.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h").checkpoint()
    shared = broadcast_if_small(shared, BROADCAST_BYTES)
    single = plain.join(shared, "h", "left_anti").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha"
    )
    collapsed = _stored(_collapsed(plain.join(shared, "h", "left_semi"), kind), "grace-records")
    classes = _classes(collapsed.filter("n IS NOT NULL"), kind, table_bytes, crowd)
    copies = (
        collapsed.filter("n IS NULL")
        .select("doc_id", "row", "sha", "entry")
        .join(classes, "entry")
        .select("doc_id", F.col("first").alias("keep_id"), F.col("n").alias("group_size"), (F.col("row") == F.col("first_row")).alias("kept"), "sha")
    )
    return single.union(copies).withColumnsRenamed({"doc_id": id_col, "sha": "text_sha256"})


def drop_exact_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of the smallest id of each group of equal texts, all columns kept.

    Decided by id and normalised text, so of a repeated id only the texts that are kept
    elsewhere go; rows equal in both stay together, as do rows without id.
    """
    marked = mark_exact_copies(docs, id_col=id_col, text_col=text_col)
    own_id, own_sha = unused(docs, "gone_id", "gone_sha")
    gone = marked.filter(F.col(id_col) != F.col("keep_id")).select(F.col(id_col).alias(own_id), F.col("text_sha256").alias(own_sha))
    blanks = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    same = (F.col(id_col) == F.col(own_id)) & (F.sha2(blanks, 256) == F.col(own_sha))
    return docs.join(broadcast_if_small(gone.distinct().checkpoint(), BROADCAST_BYTES), same, "left_anti")
