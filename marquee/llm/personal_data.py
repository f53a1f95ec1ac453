"""Personal data: exact base patterns, and identifiers found by bootstrapped contexts.

Everything is DataFrame functions. A pattern's matches get their positions by marking
them in the text, cutting the text at the marks and adding up the lengths of the parts.

Bootstrapping looks at identifier-like words and the two words before each. Base matches
are the seeds. A context is as reliable as the share of its distinct identifiers that are
known, an unknown identifier as the noisy-or of its contexts; both are computed in turn
over the graph of (context, identifier) pairs. What follows a context that ends up
reliable is reported as kind ``id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.names import unused
from marquee.operators.sizing import broadcast_if_small
from marquee.session import enable_checkpoints

KINDS = ("email", "ip", "card", "phone")
DISCOVERED = "id"
RELIABLE, SETTLED = 0.75, 1e-6
JOIN_BYTES = 64 << 20
BLOCK = 64  # items of a text that are gathered at a time
NEAR = (4096, 64)  # blocks of identifiers for which the spans near them are picked
CUTS = 256  # spans that are cut out of a piece of text at a time

# The base patterns. Where a run of characters has failed from its beginning it fails from
# its middle too, so the look-behinds only save time; \G allows a start right after a match.
# Repetitions give nothing back, since nothing that follows them could use it.
_BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
# An identifier-like word has four signs or more with a digit or an @ among them.
_WORD = "A-Za-z0-9@._%+:/-"
_MARK = "@._%+:/-"
_IDENTIFIER = (
    rf"(?:\G|(?<![{_WORD}]))(?=[A-Za-z._%+:/-]*+[0-9@])(?=[A-Za-z0-9+][{_WORD}]{{2}}[{_MARK}]*+[A-Za-z0-9])"
    rf"[A-Za-z0-9+](?:[{_MARK}]*+[A-Za-z0-9]++)*+"
)
_OPEN, _CLOSE, _OTHER = "\u0001", "\u0002", "\u0003"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it, inside lambdas too."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _blocks(items: Column, size: int) -> Column:
    """The items in arrays of ``size``; no items give one empty array. ``items`` must be bound."""
    last = F.greatest(F.ceil(F.size(items) / size).cast("int") - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(items, b * size + 1, F.lit(size)))


def _running(items: Column, advance, emit, kind: str) -> Column:
    """Array of ``emit(at, item)``; ``at`` starts as 0 and becomes ``advance(at, item)``.

    Spark copies a growing array at each step. So the number at the beginning of each block
    comes first, and then every block is gathered by itself: a text with very many matches
    takes time nearly in proportion.
    """
    none = F.array().cast(f"array<{kind}>")

    def one(state, item):
        return F.struct(
            advance(state["at"], item).alias("at"),
            F.concat(state["found"], F.array(emit(state["at"], item))).alias("found"),
        )

    def gathered(own, at):
        return F.aggregate(own, F.struct(at.alias("at"), none.alias("found")), one, lambda state: state["found"])

    def of_blocks(blocks):
        zero = F.array(F.lit(0).cast("int"))
        starts = F.aggregate(blocks, zero, lambda s, own: F.concat(s, F.array(F.aggregate(own, F.element_at(s, -1), advance))))
        return F.flatten(F.zip_with(blocks, F.slice(starts, F.lit(1), F.size(blocks)), gathered))

    return _let(items, lambda own: _let(_blocks(own, BLOCK), of_blocks))


def _with_near(items: Column, spans: Column, sizes: tuple[int, ...], body) -> Column:
    """Array of ``body(item, near)`` with the spans that may overlap the item; items in order of position.

    Spans are narrowed to those of a block of items, then of a smaller block.
    """
    if not sizes:
        return F.transform(items, lambda m: body(m, spans))

    def of_block(own):
        first, last = F.get(own, F.lit(0)), F.element_at(own, -1)
        near = F.filter(spans, lambda b: (b["start"] < last["end"]) & (b["end"] > first["start"]))
        return F.when(F.size(own) > 0, _let(near, lambda n: _with_near(own, n, sizes[1:], body)))

    return F.flatten(F.filter(F.transform(_blocks(items, sizes[0]), of_block), lambda x: x.isNotNull()))


def _matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, text, before) of a pattern's matches, leftmost first and without overlap.

    ``before`` is the text between the previous match and this one. The marks themselves
    are replaced in the text beforehand; no pattern knows them.
    """
    plain = F.translate(text, _OPEN + _CLOSE, _OTHER * 2)
    parts = F.split(F.regexp_replace(plain, pattern, f"{_OPEN}$0{_CLOSE}"), _OPEN)
    # Part 0 has no match; every other part is a match, the closing mark and what follows.
    rows = F.transform(
        parts,
        lambda part, i: F.struct(
            F.when(i == 0, F.lit("")).otherwise(F.substring_index(part, _CLOSE, 1)).alias("match"),
            F.when(i == 0, part).otherwise(F.substring_index(part, _CLOSE, -1)).alias("rest"),
        ),
    )
    kind = "struct<start:int,end:int,match:string,before:string>"

    def advance(at, row):
        return at + F.length(row["match"]) + F.length(row["rest"])

    def item(at, row):
        end = at + F.length(row["match"])
        return F.struct(at.alias("start"), end.alias("end"), row["match"].alias("match"), row["before"].alias("before"))

    def with_before(own):
        before = lambda i: F.when(i > 0, F.get(own, i - 1)["rest"]).otherwise(F.lit(""))
        return F.transform(own, lambda row, i: F.struct(row["match"].alias("match"), row["rest"].alias("rest"), before(i).alias("before")))

    return F.filter(_running(_let(rows, with_before), advance, item, kind), lambda m: m["match"] != "")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total, i):
        digit = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


_VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"),
    "card": lambda m: F.when(F.length(_digits(m)).between(14, 19), _luhn(_digits(m))).otherwise(F.lit(False)),
    "phone": lambda m: F.length(_digits(m)).between(10, 15),
}
_SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"


def base_spans(text: Column) -> Column:
    """Sorted array of (start, rank, kind, end) of the base kinds; text must not be null."""
    empty = F.array().cast(_SPAN)
    digit = text.rlike("[0-9]")
    may = {"email": text.contains("@"), "ip": digit, "card": digit, "phone": digit & text.contains("+")}

    def of_kind(rank: int, kind: str) -> Column:
        valid = F.filter(_matches(text, _BASE[kind]), lambda m: _VALID[kind](m["match"]))
        return F.transform(
            valid,
            lambda m: F.struct(
                m["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), m["end"].alias("end")
            ),
        )

    found = [F.when(may[kind], of_kind(rank, kind)).otherwise(empty) for rank, kind in enumerate(KINDS)]
    return F.array_sort(F.concat(*found))


def candidates(text: Column, base: Column) -> Column:
    """Array of (start, end, identifier, context, known) of identifier-like words.

    The context is the one or two words before it, whole and in lower case.
    """
    found = F.when(text.rlike("[0-9@]"), _matches(text, _IDENTIFIER))

    def describe(m, near):
        # Backwards, so that the search is anchored and takes a single pass.
        left = F.lower(F.reverse(F.regexp_extract(F.reverse(m["before"]), r"^\s*+(\S++(?:\s++\S++)?+)", 1)))
        known = F.exists(near, lambda b: (b["start"] < m["end"]) & (b["end"] > m["start"]))
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), m["match"].alias("identifier"), left.alias("context"), known.alias("known"))

    kind = "array<struct<start:int,end:int,identifier:string,context:string,known:boolean>>"
    described = _let(F.struct(found.alias("found"), base.alias("base")), lambda s: _with_near(s["found"], s["base"], NEAR, describe))
    described = F.filter(described, lambda c: c["context"] != "")
    return F.coalesce(described.cast(kind), F.array().cast(kind))


def reliable_contexts(pairs: DataFrame, reliable: float = RELIABLE) -> DataFrame:
    """(context, confidence) of the contexts at ``reliable`` or above, from rows (context, identifier, known).

    confidence = (sum of its distinct identifiers' scores) / (their number + 1);
    an unknown identifier scores 1 - product of (1 - confidence) over its other sightings.
    Scores only grow; they are computed in turn until none grows by more than SETTLED.
    """
    graph = pairs.groupBy("context", "identifier").agg(F.max("known").alias("known")).checkpoint()
    scores = graph.groupBy("identifier").agg(F.max("known").cast("double").alias("score")).checkpoint()
    while True:
        contexts = (
            graph.join(scores, "identifier")
            .groupBy("context")
            .agg((F.sum("score") / (F.count(F.lit(1)) + 1)).alias("confidence"))
            .checkpoint()
        )
        unseen = F.exp(F.sum(F.log1p(-F.when(F.col("confidence") >= 0.5, F.col("confidence")).otherwise(0.0))))
        later = (
            graph.join(contexts, "context")
            .groupBy("identifier")
            .agg(F.when(F.max("known"), 1.0).otherwise(1 - unseen).alias("score"))
            .checkpoint()
        )
        grown = later.join(scores.withColumnRenamed("score", "before"), "identifier").filter(F.col("score") > F.col("before") + SETTLED)
        if grown.isEmpty():
            return contexts.filter(F.col("confidence") >= reliable)
        scores = later


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))


def _text_key() -> tuple[Column, Column]:
    return F.xxhash64("text").alias("key"), F.length("text").alias("size")


def find_discovered(found: DataFrame) -> DataFrame:
    """(key, size, more): spans of kind ``id`` by the text that they stand in."""
    seen = found.select("key", "size", F.explode("candidates").alias("c")).select("key", "size", "c.*")
    contexts = reliable_contexts(seen.select("context", "identifier", "known"))
    return (
        seen.filter(~F.col("known"))
        .join(contexts.select("context"), "context")
        .groupBy("key", "size")
        .agg(
            F.array_sort(
                F.collect_set(F.struct("start", F.lit(len(KINDS)).alias("rank"), F.lit(DISCOVERED).alias("kind"), "end"))
            ).cast(_SPAN).alias("more")
        )
    )


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_id), one for each input row.

    ``spans`` joins kind:start:end of all spans by start, then kind; positions are code
    points, ends exclusive. ``base_sha256`` is the digest of the same text for the four
    base kinds alone.

    A null or empty text has no spans. Null ids and repeated rows are kept (copies of a
    text get the same spans), other columns are not looked at, an empty table gives an
    empty result. Texts are searched whole.
    """
    enable_checkpoints(docs.sparkSession)
    text = F.col("text")
    found = (
        _keyed(docs, id_col, text_col)
        .select("doc_id", "text", *_text_key(), base_spans(text).alias("base"))
        .select("doc_id", "key", "size", "base", candidates(text, F.col("base")).alias("candidates"))
        .checkpoint()
    )
    more = broadcast_if_small(find_discovered(found).checkpoint(), JOIN_BYTES)
    whole = found.drop("candidates").join(more, ["key", "size"], "left")
    spans = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(_SPAN))))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return whole.select(
        F.col("doc_id").alias(id_col),
        *map(count, KINDS),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
        F.coalesce(F.size("more"), F.lit(0)).cast("long").alias("n_id"),
    )


def _redacted(value: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind; overlapping spans become one, named after the first."""
    kind = "struct<ahead:boolean,start:int,end:int,kind:string>"

    def emit(at, span):
        # A cut's own text is what stands between the last cut and it.
        return F.struct((span["start"] >= at).alias("ahead"), at.alias("start"), span["start"].alias("end"), span["kind"].alias("kind"))

    cuts = _running(spans, lambda at, span: F.greatest(at, span["end"]), emit, kind)

    def of_block(own):
        first, last = F.get(own, F.lit(0)), F.element_at(own, -1)
        piece = F.substring(value, first["start"] + 1, last["end"] - first["start"])
        return _let(
            F.struct(piece.alias("text"), first["start"].alias("at")),
            lambda p: F.transform(
                own,
                lambda c: F.concat(F.substring(p["text"], c["start"] - p["at"] + 1, c["end"] - c["start"]), F.lit("<"), c["kind"], F.lit(">")),
            ),
        )

    parts = _let(F.filter(cuts, lambda c: c["ahead"]), lambda own: F.flatten(F.transform(_blocks(own, CUTS), of_block)))
    end = F.array_max(F.transform(spans, lambda span: span["end"]))
    return F.concat(F.array_join(parts, ""), F.substring(value, end + 1, F.length(value)))


def redact(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The rows with each span of personal data replaced by its kind in angle brackets.

    Overlapping spans become one, named after the first. Columns stay as they are but for
    the text; null texts stay null, and so do texts without spans, empty ones included.
    Repeated rows are redacted alike, an empty table gives an empty one, and columns may
    have any names.
    """
    enable_checkpoints(docs.sparkSession)
    text = F.col("text")
    own = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = (
        own.select("text", *_text_key(), base_spans(text).alias("base"))
        .select("key", "size", candidates(text, F.col("base")).alias("candidates"))
        .filter(F.size("candidates") > 0)
        .checkpoint()
    )
    more = find_discovered(found).checkpoint()
    own_key, own_size, own_more, own_spans = unused(docs, "own_key", "own_size", "own_more", "own_spans")
    more = broadcast_if_small(more.withColumnsRenamed({"key": own_key, "size": own_size, "more": own_more}), JOIN_BYTES)
    value = F.coalesce(F.col(text_col), F.lit(""))
    joined = docs.join(more, (F.xxhash64(value) == F.col(own_key)) & (F.length(value) == F.col(own_size)), "left")
    spans = F.array_sort(F.concat(base_spans(value), F.coalesce(F.col(own_more), F.array().cast(_SPAN))))
    spanned = joined.withColumn(own_spans, spans)
    changed = F.when(F.size(own_spans) > 0, _redacted(F.col(text_col), F.col(own_spans))).otherwise(F.col(text_col))
    return spanned.withColumn(text_col, changed).select(*docs.columns)
