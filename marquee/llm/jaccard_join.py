"""N-gram Jaccard join with token-combination prefixes.

Documents are sets of word shingles (tokens). All tokens have one order: rare ones first,
then frequent ones, each by hash. Two linked sets of sizes m <= n differ in few tokens, so a
prefix of one of them that could absorb all its missing tokens holds something common:

* rare tokens are indexed alone;
* frequent tokens fall into groups by hash, and only pairs within a group are indexed. A
  prefix with c tokens of one group thus absorbs c - 1 missing ones without a common pair,
  so prefixes are extended until all rare tokens and these remainders exceed the number of
  tokens that may be missing;
* sets too short for that index their ordinary prefix token by token, under a separate name.

The prefix argument holds for any division into rare and frequent; the division only
decides how many false candidates there are. Candidates are verified exactly.

Inside a group of documents with a common key, no list of all pairs is made. First every
member is verified against the member with the fewest rare tokens (the least edited copy);
linked members form components. In keys with many components another leader is elected
among those that had none, again and again while that joins members: a round sends one
row for each member. Only pairs of different components are looked at after that, once for
all keys with the same members, in blocks, behind a parity bitmap that bounds the overlap
from above and grows with the set: first the likeliest pair of each two components, then
all that are still in different ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.components import components
from marquee.llm.names import unused
from marquee.llm.words import give_back, mix, shingle_sets, word_slices
from marquee.operators.sizing import broadcast_if_small
from marquee.session import enable_checkpoints

WORDS, THRESHOLD = 5, 80  # words of a shingle; least similarity in percent
LEAST_FREQUENT = 4  # a token in fewer documents is rare; doubled until the frequent ones fit the broadcast
FREQUENT_TOKENS = 1 << 21  # at most so many frequent tokens; each takes 8 bytes of a broadcast
GROUPS = np.uint64(256)  # hash groups of frequent tokens, within which pairs are made
LIKELIEST_ROUNDS = 1
BLOCK = 2048  # members of one key compared in one task
CROWD = 64  # components of one key above which another leader is elected
PRODUCTIVE = 0.05  # share of a round's pairs that must be links for another round
LEAST_SKETCH = 512  # bits of the smallest parity bitmap; larger sets have a power of two above their size
NODES_MB = 64

_U = np.uint64


def _planes(values: np.ndarray, size: int) -> np.ndarray:
    """Byte planes of integers, most significant first; sorted values then compress well in a shuffle."""
    return np.ascontiguousarray(values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - size :].T)


def _unplaned(data: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(size, -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, 8 - size :] = planes.T
    return wide.view(">u8").ravel().astype(np.uint64)


def _range_of(values: np.ndarray, ranges: int) -> np.ndarray:
    """Range of each 64-bit hash when all are dealt to equal ranges in order."""
    return ((values >> _U(32)) * _U(ranges)) >> _U(32)


def _fingerprint(tokens: np.ndarray) -> np.uint64:
    return mix(np.array([mix(tokens).sum() + _U(len(tokens))], np.uint64))[0]


def _sets(batches: Iterator[pa.RecordBatch], column: int, size: int):
    for batch in batches:
        for low, high, words in word_slices(batch.column(column)):
            yield batch, low, high, shingle_sets(words, size)


def sketch_of(tokens: np.ndarray) -> bytes:
    """Bit i tells whether an odd number of tokens hash to i."""
    bits = max(LEAST_SKETCH, 1 << (max(len(tokens), 1) - 1).bit_length())
    return np.packbits(np.bincount((tokens & _U(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1).tobytes()


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) as they would be with fewer bits."""
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def differing_bits(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """In how many bits a bitmap differs from each of others, all of them not smaller."""
    return np.bitwise_count(_folded(others, len(one)) ^ one).sum(1, dtype=np.int64)


def _text_key(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text).alias("key"), F.length(text).alias("size")


def document_sets(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, key, size, n_shingles, fp, sketch): size, fingerprint and parity bitmap of each row's set.

    ``key`` and ``size``, hash and length of the row's text, pass through.

    Equal sets have equal fingerprints; a set without tokens has none. Bit i of the bitmap
    tells whether an odd number of tokens hash to i, so two sets differ in at least as many
    tokens as their bitmaps differ in bits.
    """

    def describe(batches):
        for batch, low, high, sets in _sets(batches, 1, size):
            prints = [int(_fingerprint(s).view(np.int64)) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).slice(low, high - low) for c in (0, 2, 3)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(prints, pa.int64()),
                    pa.array([sketch_of(s) for s in sets], pa.binary()),
                ],
                names=["doc_id", "key", "size", "n_shingles", "fp", "sketch"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    given = docs.select("doc_id", "text", *_text_key(F.col("text")))
    return given.mapInArrow(describe, f"doc_id {kind}, key long, size int, n_shingles long, fp long, sketch binary")


def frequent_tokens(texts: DataFrame, size: int, ranges: int) -> np.ndarray:
    """Sorted 40-bit heads of the tokens that stand in many documents, FREQUENT_TOKENS at most.

    The least number of documents is the smallest of LEAST_FREQUENT times a power of two
    for which the tokens do not exceed the bound.

    Tasks send sorted token heads by range as compact blobs; each range is counted by
    itself. Copies within a slice of texts count once.
    """

    def send(batches):
        held, n = [], 0

        def flush():
            values = np.sort(np.concatenate(held)) if held else np.zeros(0, np.uint64)
            cuts = np.searchsorted(_range_of(values, ranges), np.arange(ranges + 1))
            heads = values >> _U(24)
            full = np.flatnonzero(np.diff(cuts))
            blobs = [_planes(heads[cuts[r] : cuts[r + 1]], 5).tobytes() for r in full]
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(blobs, pa.binary())], names=["range", "heads"])

        for _, _, _, sets in _sets(batches, 0, size):
            distinct = {s.tobytes(): s for s in sets}
            held += distinct.values()
            n += sum(map(len, distinct.values()))
            if n > 1_000_000:
                yield flush()
                held, n = [], 0
        yield flush()
        give_back()

    def count(table: pa.Table) -> pa.Table:
        heads = np.sort(np.concatenate([_unplaned(b, 5) for b in table["heads"].to_pylist()]))
        begin = np.flatnonzero(np.concatenate(([True], heads[1:] != heads[:-1])))
        times = np.diff(np.append(begin, len(heads)))
        give_back()
        often = times >= LEAST_FREQUENT
        return pa.table({"head": heads[begin[often]].view(np.int64), "times": times[often]})

    sent = texts.mapInArrow(send, "range int, heads binary")
    counted = sent.groupBy("range").applyInArrow(count, "head long, times long").checkpoint()
    steps = counted.groupBy(F.floor(F.log2(F.col("times") / LEAST_FREQUENT)).alias("step")).count().collect()
    held, least = sum(row["count"] for row in steps), LEAST_FREQUENT
    for row in sorted(steps, key=lambda row: row["step"]):
        if held <= FREQUENT_TOKENS:
            break
        held -= row["count"]
        least = LEAST_FREQUENT << (row["step"] + 1)
    found = counted.filter(F.col("times") >= least).select("head").toArrow()
    return np.sort(found["head"].to_numpy()).view(np.uint64)


def _spread(tokens: np.ndarray) -> np.ndarray:
    return tokens % GROUPS


def signatures(tokens: np.ndarray, frequent: np.ndarray, threshold: int) -> tuple[np.ndarray, int]:
    """Index keys of a sorted set of which ``frequent`` flags tokens, and its number of rare tokens."""
    n = len(tokens)
    need = n - -(-threshold * n // 100) + 1  # one more than may be missing in a linked set
    rare = tokens[~frequent]
    if len(rare) >= need:
        return mix(rare[:need]), len(rare)
    common, need_pairs = tokens[frequent], need - len(rare)
    group = _spread(common)
    extra = np.ones(len(common), np.int64)
    extra[np.unique(group, return_index=True)[1]] = 0
    absorbed = np.cumsum(extra)
    keys = [mix(rare)]
    if len(absorbed) and absorbed[-1] >= need_pairs:
        end = int(np.searchsorted(absorbed, need_pairs)) + 1
        common, group = common[:end], group[:end]
    else:
        first = np.concatenate((rare, common))[:need]
        keys.append(mix(first ^ _U(0x5555555555555555)))
    order = np.lexsort((common, group))
    common, group = common[order], group[order]
    step = 1
    while step < len(common):
        same = group[step:] == group[:-step]
        if not same.any():
            break
        keys.append(mix(common[:-step][same] * _U(0x9E3779B97F4A7C15) + common[step:][same]))
        step += 1
    return np.concatenate(keys), len(rare)


def shared_keys(texts: DataFrame, frequent: np.ndarray, size: int, threshold: int, ranges: int) -> DataFrame:
    """(key, fp, rare, leader, rank): members of every index key that two different sets or more have.

    ``rare`` is the number of a member's rare tokens, ``leader`` the key's member with the
    fewest, ``rank`` their number.
    """
    shared = texts.sparkSession.sparkContext.broadcast(frequent)

    def send(batches):
        frequent, held, n = shared.value, [], 0

        def flush():
            key, fp, count, rare = (np.concatenate(c) for c in zip(*held)) if held else [np.zeros(0, np.uint64)] * 4
            order = np.argsort(key)
            key, fp, count, rare = key[order], fp[order], count[order], rare[order]
            cuts = np.searchsorted(_range_of(key, ranges), np.arange(ranges + 1))
            full = np.flatnonzero(np.diff(cuts))
            blobs = []
            for r in full:
                a, b = cuts[r], cuts[r + 1]
                planes = (_planes(key[a:b] >> _U(16), 6), _planes(fp[a:b], 8), _planes(count[a:b], 4), _planes(rare[a:b], 4))
                blobs.append(np.concatenate(planes).tobytes())
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(blobs, pa.binary())], names=["range", "rows"])

        for _, _, _, sets in _sets(batches, 0, size):
            distinct = {s.tobytes(): s for s in sets if len(s)}
            sets = list(distinct.values())
            if not sets:
                continue
            flat = np.concatenate(sets) >> _U(24)
            at = np.minimum(np.searchsorted(frequent, flat), max(len(frequent) - 1, 0))
            often = frequent[at] == flat if len(frequent) else np.zeros(len(flat), bool)
            low = 0
            for s in sets:
                key, rare = signatures(s, often[low : low + len(s)], threshold)
                low += len(s)
                held.append((key, *(np.full(len(key), x, np.uint64) for x in (_fingerprint(s), len(s), rare))))
                n += len(key)
            if n > 500_000:
                yield flush()
                held, n = [], 0
        yield flush()
        give_back()

    def meet(table: pa.Table) -> pa.Table:
        parts = []
        for blob in table["rows"].to_pylist():
            m = len(blob) // 22
            bounds = np.cumsum([0, 6 * m, 8 * m, 4 * m, 4 * m])
            parts.append([_unplaned(blob[a:b], w) for a, b, w in zip(bounds, bounds[1:], (6, 8, 4, 4))])
        key, fp, count, rare = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((fp, rare, key))
        key, fp, count, rare = key[order], fp[order], count[order], rare[order]
        new = np.ones(len(key), bool)  # a set may reach a key from many slices
        new[1:] = (key[1:] != key[:-1]) | (fp[1:] != fp[:-1])
        key, fp, count, rare = key[new], fp[new], count[new], rare[new]
        begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.append(begin, len(key)))
        many, first = np.repeat(size > 1, size), np.repeat(begin, size)[np.repeat(size > 1, size)]
        give_back()
        signed = {"key": key[many], "fp": fp[many], "rare": rare[many], "leader": fp[first], "rank": rare[first]}
        return pa.table({c: v.view(np.int64) for c, v in signed.items()})

    sent = texts.mapInArrow(send, "range int, rows binary")
    return sent.groupBy("range").applyInArrow(meet, "key long, fp long, rare long, leader long, rank long")


def _possible(pairs: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b, ...) whose bitmaps and sizes allow a link; n_a, n_b, sketch_a, sketch_b go."""

    def sieve(batches):
        for batch in batches:
            n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            keep = 100 * np.minimum(n_a, n_b) >= threshold * np.maximum(n_a, n_b)
            for i in np.flatnonzero(keep):
                x, y = (np.frombuffer(batch.column(c)[int(i)].as_py(), np.uint64) for c in ("sketch_a", "sketch_b"))
                x, y = (x, y) if len(x) <= len(y) else (y, x)
                keep[i] = (100 + threshold) * differing_bits(x, y[None])[0] <= (100 - threshold) * (n_a[i] + n_b[i])
            yield batch.select(rest).filter(pa.array(keep, pa.bool_()))

    rest = [c for c in pairs.columns if c not in ("n_a", "n_b", "sketch_a", "sketch_b")]
    return pairs.mapInArrow(sieve, pairs.select(rest).schema)


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, threshold: int, sieved: bool = False) -> DataFrame:
    """The pairs (a, b) of fingerprints whose sets are similar enough, by the overlap of their token hashes.

    Only texts of sets that passed the bitmap are read again, through one document each.
    ``sieved`` states that the pairs have passed it already. Overlap is counted on 48 bits
    of a token's hash: two different tokens of a pair are taken for one with a chance of
    about 2 ** -48 for each two of its tokens.
    """
    own = ["rep"] if sieved else ["rep", "n_shingles", "sketch"]
    short = {"rep": "rep", "n_shingles": "n", "sketch": "sketch"}
    sides = [nodes.select(F.col("fp").alias(x), *(F.col(c).alias(f"{short[c]}_{x}") for c in own)) for x in ("a", "b")]
    likely = pairs.select("a", "b").join(sides[0], "a").join(sides[1], "b")
    likely = (likely if sieved else _possible(likely, threshold)).checkpoint()
    wanted = likely.select(F.explode(F.array("rep_a", "rep_b")).alias("wanted")).distinct()
    texts = docs.join(broadcast_if_small(wanted, NODES_MB << 20), F.col("doc_id") == F.col("wanted"), "left_semi")

    def pack(batches):
        for _, _, _, sets in _sets(batches, 0, size):
            sets = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(_fingerprint(s).view(np.int64)) for s in sets], pa.int64()),
                    pa.array([_planes(s >> _U(16), 6).tobytes() for s in sets], pa.binary()),
                ],
                names=["fp", "tokens"],
            )

    packed = texts.select("text").mapInArrow(pack, "fp long, tokens binary")

    def overlap(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):  # one pair at a time as bytes
                both = np.concatenate((_unplaned(x.as_py(), 6), _unplaned(y.as_py(), 6)))
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= threshold * (len(both) - common))
            give_back()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x, y = packed.select(F.col("fp").alias("a"), F.col("tokens").alias("x")), packed.select(F.col("fp").alias("b"), F.col("tokens").alias("y"))
    joined = likely.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return joined.mapInArrow(overlap, "a long, b long").distinct()


def _open_pairs(
    members: DataFrame, joined: DataFrame, nodes: DataFrame, threshold: int, ranges: int, likeliest: bool
) -> DataFrame:
    """Pairs (a, b) with a common key whose sets are in different components and may be linked.

    All such pairs, or of each two components the pair whose bitmaps differ least.
    """
    placed = members.select("key", "fp").join(joined.withColumnRenamed("node", "fp"), "fp", "left").select(
        "key", "fp", F.coalesce("component", "fp").alias("component")
    )
    same = [F.sum(F.xxhash64("fp", F.lit(i)).cast("decimal(38,0)")).alias(f"same{i}") for i in (1, 2)]
    still_open = (
        placed.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size"), *same)
        .filter("low != high")
        .groupBy("size", "same1", "same2")  # of keys with the same members one is enough
        .agg(F.min("key").alias("key"))
        .select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
        .checkpoint()
    )
    rows = placed.join(still_open, "key").join(nodes, "fp")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    rows = rows.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        F.when(F.col("blocks") == 1, F.pmod(F.col("key"), F.lit(4 * ranges))).otherwise(F.col("key")).alias("bundle"),
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "block", "key", "fp", "component", "n_shingles", "sketch",
    )

    def compare(table: pa.Table) -> pa.Table:
        col = {c: table[c].to_numpy() for c in ("key", "fp", "component", "n_shingles", "block")}
        low, high = int(table["low"][0].as_py()), int(table["high"][0].as_py())
        order = np.lexsort((col["n_shingles"], col["key"]))
        col, sketches = {c: v[order] for c, v in col.items()}, table["sketch"].combine_chunks()
        begin = np.flatnonzero(np.concatenate(([True], col["key"][1:] != col["key"][:-1])))
        found = [np.zeros((0, 5), np.int64)]
        for s, e in zip(begin, np.append(begin[1:], len(order))):
            n, own, block, fp = (col[c][s:e] for c in ("n_shingles", "component", "block", "fp"))
            # Bitmaps of one length stand together, since they grow with the set.
            raw = [sketches[int(k)].as_py() for k in order[s:e]]
            words = np.array([len(x) // 8 for x in raw])
            cuts = np.concatenate(([0], np.flatnonzero(words[1:] != words[:-1]) + 1, [e - s]))
            maps = [np.frombuffer(b"".join(raw[u:v]), np.uint64).reshape(v - u, -1) for u, v in zip(cuts, cuts[1:])]
            for i in range(e - s - 1):
                # Sizes ascend, so partners that are not too large stand next to each other.
                end = int(np.searchsorted(n, 100 * n[i] // threshold, "right"))
                if end <= i + 1:
                    continue
                mine = int(np.searchsorted(cuts, i, "right")) - 1
                one = maps[mine][i - cuts[mine]]
                differing = np.concatenate([
                    differing_bits(one, maps[k][max(i + 1, cuts[k]) - cuts[k] : end - cuts[k]])
                    for k in range(mine, len(maps)) if cuts[k] < end and cuts[k + 1] > i + 1
                ])
                fits = (own[i + 1 : end] != own[i]) & ((100 + threshold) * differing <= (100 - threshold) * (n[i] + n[i + 1 : end]))
                if low != high:
                    fits &= block[i + 1 : end] != block[i]
                hit = np.flatnonzero(fits)
                if likeliest and len(hit):
                    hit = hit[np.argsort(differing[hit], kind="stable")]
                    hit = hit[np.unique(own[i + 1 + hit], return_index=True)[1]]
                if len(hit):
                    at = hit + i + 1
                    pair = np.sort(np.column_stack((np.full(len(at), fp[i]), fp[at])), axis=1)
                    both = np.sort(np.column_stack((np.full(len(at), own[i]), own[at])), axis=1)
                    # Parts per million, so that large and small sets compare.
                    found.append(np.column_stack((pair, both, 1_000_000 * differing[hit] // (n[i] + n[at]))))
        pairs = np.concatenate(found)
        if likeliest:
            pairs = pairs[np.lexsort((pairs[:, 4], pairs[:, 3], pairs[:, 2]))]
            pairs = pairs[np.unique(pairs[:, 2:4], axis=0, return_index=True)[1]] if len(pairs) else pairs
        else:
            pairs = np.unique(pairs, axis=0)
        return pa.table({c: np.ascontiguousarray(pairs[:, k]) for k, c in enumerate(("a", "b", "own_a", "own_b", "parts"))})

    found = rows.groupBy("bundle", "low", "high").applyInArrow(compare, "a long, b long, own_a long, own_b long, parts long")
    if not likeliest:
        return found.select("a", "b").distinct()
    best = found.groupBy("own_a", "own_b").agg(F.min(F.struct("parts", "a", "b")).alias("best"))
    return best.select("best.a", "best.b")


def _another_leader(members: DataFrame, joined: DataFrame, led: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs (a, b), led): members of crowded keys with a new leader of theirs, and all leaders so far.

    ``led`` holds (key, leader). The new leader of a key is the member with the fewest rare
    tokens among the components that had none; a member is paired with the best new leader
    of all its keys.
    """
    of_node = joined.select(F.col("node").alias("fp"), "component")
    placed = members.select("key", "fp", "rare").join(of_node, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    parts = placed.groupBy("key", "component").agg(F.min(F.struct("rare", "fp")).alias("best")).checkpoint()
    crowded = parts.groupBy("key").agg(F.count(F.lit(1)).alias("parts")).filter(F.col("parts") > CROWD).select("key").checkpoint()
    had = led.join(crowded, "key", "left_semi").withColumnRenamed("leader", "fp").join(of_node, "fp", "left")
    had = had.select("key", F.coalesce("component", "fp").alias("component"))
    free = parts.join(crowded, "key", "left_semi").join(had, ["key", "component"], "left_anti")
    new = (
        free.groupBy("key")
        .agg(F.min(F.struct("best.rare", "best.fp", "component")).alias("to"))
        .select("key", F.col("to.fp").alias("leader"), F.col("to.rare").alias("rank"), F.col("to.component").alias("own"))
        .checkpoint()
    )
    pairs = (
        placed.join(new, "key")
        .filter("component != own")
        .groupBy(F.col("fp").alias("a"))
        .agg(F.min(F.struct("rank", "leader")).alias("to"))
        .select("a", F.col("to.leader").alias("b"))
    )
    return pairs.checkpoint(), led.union(new.select("key", "leader"))


def jaccard_components(
    docs: DataFrame, *, words: int = WORDS, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (id, n_shingles, component_id), one for each input row.

    Words are runs of characters that are not blank, with A-Z in lower case. A document's
    set holds its distinct shingles of ``words`` words, or its whole sequence if it has
    fewer. Documents link when 100 * |intersection| >= threshold * |union|; component_id is
    the smallest id reachable by links, the own id included.

    A null or empty text, or one without words, has an empty set and no link. Repeated rows
    are linked to each other. A row without id gets its n_shingles, has no component and
    takes no part in links. Other columns are not looked at; an empty table gives an empty
    result. Texts are used whole.
    """
    placed = _placed_rows(docs, words, threshold, id_col, text_col)
    return placed.select(F.col("doc_id").alias(id_col), "n_shingles", "component_id")


def _placed_rows(docs: DataFrame, words: int, threshold: int, id_col: str, text_col: str) -> DataFrame:
    """Rows (doc_id, key, size, n_shingles, component, component_id), one for each input row.

    ``component`` names the component itself: where ids are repeated, two components may
    have the same smallest id. It is null for sets without tokens and rows without id.
    """
    spark = docs.sparkSession
    enable_checkpoints(spark)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    own = docs.filter(F.col("doc_id").isNotNull())
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sets = document_sets(docs, words).checkpoint()
    nodes = (
        sets.filter(F.col("fp").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("fp")
        .agg(F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n_shingles"), F.min("sketch").alias("sketch"))
    )
    texts = own.select("text")
    members = shared_keys(texts, frequent_tokens(texts, words, ranges), words, threshold, ranges).checkpoint()

    first = (
        members.filter("fp != leader")
        .groupBy(F.col("fp").alias("a"))
        .agg(F.min(F.struct("rank", "leader")).alias("to"))
        .select("a", F.col("to.leader").alias("b"))
    )
    links = verified(first, nodes, own, words, threshold).checkpoint()
    joined = components(links)

    def with_more(more: DataFrame) -> DataFrame:
        return components(joined.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    led = members.select("key", "leader").distinct()
    while True:
        pairs, led = _another_leader(members, joined, led)
        tried = pairs.count()
        if not tried:
            break
        more = verified(pairs, nodes, own, words, threshold).checkpoint()
        found = more.count()
        if found:
            joined = with_more(more)
        if found <= PRODUCTIVE * tried:
            break  # what is left is compared pair by pair
    for turn in range(LIKELIEST_ROUNDS + 1):
        pairs = _open_pairs(members, joined, nodes, threshold, ranges, turn < LIKELIEST_ROUNDS)
        more = verified(pairs, nodes, own, words, threshold, sieved=True).checkpoint()
        if not more.isEmpty():
            joined = with_more(more)
    members_of = nodes.select("fp", "rep").join(joined.withColumnRenamed("node", "fp"), "fp", "left")
    members_of = members_of.select("fp", "rep", F.coalesce("component", "fp").alias("component"))
    smallest = members_of.groupBy("component").agg(F.min("rep").alias("component_id"))
    labels = members_of.join(smallest, "component").select("fp", "component", "component_id")
    with_id = F.col("doc_id").isNotNull()
    return sets.join(labels, "fp", "left").select(
        "doc_id",
        "key",
        "size",
        "n_shingles",
        F.when(with_id, F.col("component")).alias("component"),
        F.when(with_id, F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def drop_near_copies(
    docs: DataFrame, *, words: int = WORDS, threshold: int = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of the smallest id of each component, all columns kept.

    Rows are judged by id and text: of a repeated id only the texts that are near copies of
    a kept row go. Of near copies with one id the text of smallest hash stays, of rows with
    equal id and text one. Rows without id, text or words stay. Texts are not shuffled but
    for those of repeated ids: the keys that go are joined by broadcast where their
    measured size allows. An empty table gives an empty one; columns may have any names.
    """
    row = ["doc_id", "key", "size"]
    found = _placed_rows(docs, words, threshold, id_col, text_col).filter(F.col("doc_id").isNotNull()).checkpoint()
    gone = found.filter(F.col("doc_id") != F.col("component_id")).select(row)
    gone_id, gone_key, gone_size, repeated_id = unused(docs, "gone_id", "gone_key", "gone_size", "repeated_id")
    again = found.groupBy(F.col("doc_id").alias(repeated_id)).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select(repeated_id).checkpoint()
    repeats = not again.isEmpty()
    if repeats:
        again = broadcast_if_small(again)
        rivals = (
            found.filter((F.col("doc_id") == F.col("component_id")) & F.col("component").isNotNull())
            .join(again, F.col("doc_id") == F.col(repeated_id), "left_semi")
            .select("component", *row)
            .distinct()
        )
        first = rivals.groupBy("component").agg(F.min(F.struct("key", "size")).alias("first"))
        gone = gone.union(rivals.join(first, "component").filter(F.struct("key", "size") != F.col("first")).select(row))
    gone = gone.distinct().withColumnsRenamed(dict(zip(row, (gone_id, gone_key, gone_size)))).checkpoint()
    key, size = _text_key(F.col(text_col))
    same = (F.col(id_col) == F.col(gone_id)) & (key == F.col(gone_key)) & (size == F.col(gone_size))
    kept = docs.join(broadcast_if_small(gone), same, "left_anti")
    if not repeats:
        return kept
    repeated = kept.join(again, F.col(id_col) == F.col(repeated_id), "left_semi").dropDuplicates([id_col, text_col])
    return kept.join(again, F.col(id_col) == F.col(repeated_id), "left_anti").unionByName(repeated)
