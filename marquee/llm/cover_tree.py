"""Near-duplicate vectors by dual traversal of cover trees.

Unit vectors x, y have a cosine of at least c exactly when their distance is at most
t = sqrt(2 - 2c). The tree has nested levels with halving radii:

* its top nodes are a farthest-first net of a bounded sample; every vector goes to the
  nearest one, and a node with more vectors than a block holds is cut into blocks;
* below, each block has levels of radius 1, 1/2 and 1/4, whose centres are vectors of it.

Every node knows its covering radius, the distance from its centre to its farthest vector.
Two nodes whose centres are farther apart than both radii and t hold no linked pair, so
the traversal leaves them out, with all below. This is done for pairs of top nodes on
Spark, then level by level inside one task for each pair of blocks. What is left is
compared exactly, in double precision. The result does not depend on the sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.components import components
from marquee.operators.sizing import broadcast_if_small
from marquee.session import enable_checkpoints

THRESHOLD = 0.95
SAMPLE = 2048  # vectors that the top nodes are chosen from, at most
BLOCK = 4096  # vectors of a block, about
RADII = (1.0, 0.5, 0.25)
SLACK = 1e-6  # on bounds, for rounding; the last comparison has none
_LEVELS = [f"l{i}" for i in range(len(RADII))]


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec): double-precision unit vectors as bytes, null where a vector has no direction."""

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = []
            for row in batch.column(1):
                value = None
                if row.is_valid and row.values.null_count == 0 and len(row.values):
                    x = row.values.to_numpy(zero_copy_only=False).astype(np.float64)
                    largest = np.abs(x).max()
                    if np.isfinite(largest) and largest > 0:
                        x = x / largest  # so that squares neither overflow nor vanish
                        value = (x / np.sqrt(x @ x)).tobytes()
                units.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(units, pa.binary())], names=["vec_id", "vec"])

    kind = dict(vectors.dtypes)["vec_id"]
    return vectors.mapInArrow(scale, f"vec_id {kind}, vec binary")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def farthest_first(x: np.ndarray, count: int) -> np.ndarray:
    """Rows of a net: the first, then always the one farthest from those chosen."""
    chosen, far = [0], np.full(len(x), np.inf)
    while len(chosen) < min(count, len(x)):
        far = np.minimum(far, 2 - 2 * (x @ x[chosen[-1]]))
        best = int(far.argmax())
        if far[best] <= 1e-12:
            break
        chosen.append(best)
    return np.array(chosen)


def nested_levels(x: np.ndarray) -> np.ndarray:
    """(rows, levels): for each vector the row of its node's centre on each level.

    On every level a node's vectors are covered greedily: the first uncovered one becomes
    a centre and takes all uncovered ones within the radius. Centres stay centres below.
    """
    found = np.zeros((len(x), len(RADII)), np.int64)
    single = x.astype(np.float32)
    parents = [np.arange(len(x))]
    for level, radius in enumerate(RADII):
        least, nodes = 1 - radius * radius / 2, []
        for left in parents:
            while len(left):
                near = single[left] @ single[left[0]] >= least
                near[0] = True
                found[left[near], level] = left[0]
                nodes.append(left[near])
                left = left[~near]
        parents = nodes
    return found


def _node_radii(x: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centres, place of each vector's node among them, covering radii)."""
    centres, place = np.unique(node, return_inverse=True)
    distance = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", x, x[node]), 0))
    radii = np.zeros(len(centres))
    np.maximum.at(radii, place, distance)
    return centres, place, radii


def linked_rows(x, x_levels, y, y_levels, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows of x, rows of y, which of them are linked) for all surviving pairs of lowest nodes."""
    reach = np.sqrt(2 - 2 * threshold)
    sides = [(x, x_levels), (y, y_levels)]
    nodes = [[_node_radii(v, levels[:, k]) for k in range(len(RADII))] for v, levels in sides]
    kept = []  # levels that have clearly fewer nodes than the vectors below, and the lowest
    for k in range(len(RADII)):
        if k == len(RADII) - 1 or all(len(n[k][0]) < 0.5 * len(v) for n, (v, _) in zip(nodes, sides)):
            kept.append(k)
    open_pairs = None
    for k in kept:
        (a, _, ra), (b, _, rb) = nodes[0][k], nodes[1][k]
        limit = (ra[:, None] + rb[None, :] + reach + SLACK).astype(np.float32)
        near = 2 - 2 * (x[a].astype(np.float32) @ y[b].astype(np.float32).T) <= limit * limit + 1e-5
        if open_pairs is not None:  # a pair is open only if its parents are
            j, above = open_pairs
            near &= above[np.ix_(nodes[0][j][1][a], nodes[1][j][1][b])]
        open_pairs = (k, near)
    k, near = open_pairs
    members = [_by_node(nodes[s][k][1], len(nodes[s][k][0])) for s in (0, 1)]
    for p in np.flatnonzero(near.any(1)):
        own = members[0][p]
        other = np.concatenate([members[1][q] for q in np.flatnonzero(near[p])])
        yield own, other, x[own] @ y[other].T >= threshold


def _by_node(place: np.ndarray, count: int) -> list[np.ndarray]:
    order = np.argsort(place, kind="stable")
    return np.split(order, np.searchsorted(place[order], np.arange(1, count)))


def _forest(n: int, hits: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Label of each of n rows after joining the ends of all links, by smallest labels."""
    label = np.arange(n)
    if not hits:
        return label
    a, b = (np.concatenate(c) for c in zip(*hits))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _compare(table: pa.Table, threshold: float) -> pa.Table:
    """Numbers of links and joining pairs of one pair of blocks (or of a block with itself)."""
    second = table["second"].to_numpy(zero_copy_only=False)
    rep, weight = table["rep"].to_numpy(), table["copies"].to_numpy()
    levels = np.column_stack([table[c].to_numpy() for c in _LEVELS])
    x = _matrix(table["vec"])
    same = bool(table["same"][0].as_py())
    sides = [np.flatnonzero(~second), np.flatnonzero(second)]
    if same:
        sides[1] = sides[0]
    if min(map(len, sides)) == 0:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
    place = [dict(zip(table["row"].to_numpy()[s].tolist(), range(len(s)))) for s in sides]
    local = [np.vectorize(p.get, otypes=[np.int64])(levels[s]) for p, s in zip(place, sides)]
    count = np.zeros(len(rep), np.int64)
    hits = []
    for own, other, linked in linked_rows(x[sides[0]], local[0], x[sides[1]], local[1], threshold):
        i, j = sides[0][own], sides[1][other]
        if same:
            linked &= i[:, None] != j[None, :]
        count[i] += linked @ weight[j]
        if not same:
            count[j] += weight[i] @ linked
        r, c = np.nonzero(linked)
        if len(r):
            # A star for every row joins the same rows as all of its links; rows seen before need no more.
            hits.append(_few(i[r], j[c]))
    label = _forest(len(rep), hits)
    some, joined = np.flatnonzero(count), np.flatnonzero(label != np.arange(len(rep)))
    a = np.concatenate((rep[some], rep[joined]))
    b = pa.array(np.concatenate((np.zeros(len(some), np.int64), rep[label[joined]])), mask=np.arange(len(a)) < len(some))
    links = pa.array(np.concatenate((count[some], np.zeros(len(joined), np.int64))))
    return pa.table({"a": pa.array(a), "b": b, "links": links})


def _few(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning part of links that all run between few rows: what labels need."""
    if len(i) < 100_000:
        return i, j
    label = _forest(int(max(i.max(), j.max())) + 1, [(i, j)])
    rows = np.flatnonzero(label != np.arange(len(label)))
    return rows, label[rows]


def near_duplicates(
    vectors: DataFrame, *, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Rows (id, n_links, component_id, kept), one for each input row.

    n_links counts the other rows with a cosine of ``threshold`` or more, component_id is
    the smallest id reachable by such links, the own id included, kept tells whether it is
    the own id.

    Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing, nor do vectors of different lengths with each other. Repeated rows are linked
    copies. A row without id takes no part and gets no component. Other columns are not
    looked at; an empty table gives an empty result.

    Copies are compared once, with their number. Each block meets the blocks that its
    bounds leave open, so on data without any structure the work grows with the square of
    the number of distinct vectors.
    """
    spark = vectors.sparkSession
    enable_checkpoints(spark)
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding"))
    units = unit_vectors(rows).checkpoint()
    usable = units.filter(F.col("vec").isNotNull() & F.col("vec_id").isNotNull())
    distinct = usable.groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")).checkpoint()

    linked = None
    for length in [r.n for r in distinct.select(F.octet_length("vec").alias("n")).distinct().collect()]:
        found = _links(distinct.filter(F.octet_length("vec") == length), threshold).checkpoint()
        linked = found if linked is None else linked.union(found)
    copies = distinct.select(F.col("rep").alias("a"), F.lit(None).cast("long").alias("b"), (F.col("copies") - 1).alias("links"))
    linked = copies if linked is None else linked.union(copies)
    totals = linked.groupBy("a").agg(F.sum("links").alias("n_links"))
    pairs = linked.filter("b IS NOT NULL").select("a", "b")
    labels = components(pairs).select(F.col("node").alias("a"), "component")
    per_vector = (
        distinct.select("vec", F.col("rep").alias("a"))
        .join(totals, "a", "left")
        .join(labels, "a", "left")
        .select("vec", "n_links", F.coalesce("component", "a").alias("component"))
    )
    vec_id = F.col("vec_id")
    return (
        units.join(per_vector, "vec", "left")
        .select(
            vec_id,
            F.when(vec_id.isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
            F.when(vec_id.isNotNull(), F.coalesce("component", "vec_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("component_id") == vec_id, F.lit(False)))
        .withColumnRenamed("vec_id", id_col)
    )


def _links(distinct: DataFrame, threshold: float) -> DataFrame:
    """(a, b, links): numbers of links of each vector (b null) and pairs that join components."""
    spark = distinct.sparkSession
    total = distinct.count()
    sample = distinct.orderBy(F.xxhash64("vec"), "rep").limit(SAMPLE).select("vec").toArrow()  # SAMPLE rows at most
    x = _matrix(sample["vec"])
    centres = x[farthest_first(x, -(-total // BLOCK))]
    shared = spark.sparkContext.broadcast(centres)

    def assign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0))
            cosine = x @ shared.value.T
            node = cosine.argmax(1)
            distance = np.sqrt(np.maximum(2 - 2 * cosine.max(1), 0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(node, pa.int32()), pa.array(distance)], names=["vec", "rep", "copies", "node", "distance"]
            )

    placed = distinct.select("vec", "rep", "copies").mapInArrow(
        assign, "vec binary, rep long, copies long, node int, distance double"
    )
    placed = placed.checkpoint()
    nodes = placed.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("radius")).toPandas()
    blocks = dict(zip(nodes["node"], -(-nodes["n"] // BLOCK)))
    radius = dict(zip(nodes["node"], nodes["radius"]))
    reach = np.sqrt(2 - 2 * threshold) + SLACK
    sizes = spark.createDataFrame([(int(k), int(v)) for k, v in blocks.items()], "node int, blocks int")
    blocked = placed.join(F.broadcast(sizes), "node").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))

    def build(table: pa.Table) -> pa.Table:
        levels = nested_levels(_matrix(table["vec"]))
        table = table.append_column("row", pa.array(np.arange(len(table))))
        for k, name in enumerate(_LEVELS):
            table = table.append_column(name, pa.array(np.ascontiguousarray(levels[:, k])))
        return table

    columns = ", ".join(f"{c} long" for c in ["row", *_LEVELS])
    built = blocked.select("node", "block", "vec", "rep", "copies").groupBy("node", "block")
    built = built.applyInArrow(build, f"node int, block int, vec binary, rep long, copies long, {columns}").checkpoint()

    # Pairs of top nodes that the bound leaves open: at most SAMPLE squared, by their centres alone.
    distance = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))
    left = [
        (int(p), int(q), int(blocks[p]), int(blocks[q]))
        for p in blocks for q in blocks
        if p <= q and distance[p, q] <= radius[p] + radius[q] + reach
    ]
    tiles = spark.createDataFrame(left, "p int, q int, np int, nq int")
    tiles = tiles.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("np") - 1)))
    tiles = tiles.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nq") - 1)))
    tiles = tiles.filter("p < q OR i <= j").select("p", "i", "q", "j", ((F.col("p") == F.col("q")) & (F.col("i") == F.col("j"))).alias("same"))
    first = tiles.select("*", F.col("p").alias("node"), F.col("i").alias("block"), F.lit(False).alias("second"))
    second = tiles.filter("NOT same").select("*", F.col("q").alias("node"), F.col("j").alias("block"), F.lit(True).alias("second"))
    dealt = built.join(broadcast_if_small(first.union(second)), ["node", "block"])
    return dealt.groupBy("p", "i", "q", "j").applyInArrow(
        lambda table: _compare(table, threshold), "a long, b long, links long"
    )
