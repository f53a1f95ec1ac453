"""URL filter: exact host and path rules, and boosted trees for URLs that no rule fits.

Everything is DataFrame functions and pyspark.ml; no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.sizing import stored_bytes
from marquee.session import enable_checkpoints

TRAINING_ROWS = 20_000  # labelled URLs of each class that the trees are fitted on, at most
HOT_SHARE = 1e-4  # suffixes with at least this share of labelled URLs are broadcast in any case
JOIN_BYTES = 64 << 20
TREES, DEPTH = 20, 4
FEATURES = (
    "length host_length path_length host_depth path_depth digit_ratio host_digit_ratio "
    "letter_ratio entropy host_entropy parameters fragment dashes dotted_end suffix_rate suffix_share"
).split()

# (verdict, host, path) as text: the rules that hold, one a line.
Rules = Sequence[tuple[str, str]]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z in lower case; empty where there is none."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null where none does.

    A rule is host and path as one text, like ``net/es/``. It fits its host and all
    subdomains, for paths that begin with its own. The rules are a parameter of bounded
    length and become one expression; of equally long ones the first given wins.
    """
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule in sorted(reversed(list(rules)), key=lambda r: len(r[1])):
        cut = rule.index("/") if "/" in rule else len(rule)
        own, start = rule[:cut], rule[cut:]
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        found, verdict = F.when(fits, rule).otherwise(found), F.when(fits, kind).otherwise(verdict)
    return found, verdict


def _share(text: Column, kept: str) -> Column:
    """Share of a text's characters that are of the given class."""
    return F.length(F.regexp_replace(text, f"[^{kept}]", "")) / F.greatest(F.length(text), F.lit(1))


# Signs that the entropy counts; any other character is counted as one class.
_SIGNS = [*"abcdefghijklmnopqrstuvwxyz0123456789-._~%/?=&#:"]


def _entropy(text: Column) -> Column:
    low = F.lower(text)
    total = F.greatest(F.length(low), F.lit(1)).cast("double")
    counts = [F.length(low) - F.length(F.replace(low, F.lit(c), F.lit(""))) for c in _SIGNS]
    counts.append(F.length(low) - reduce(lambda a, b: a + b, counts))
    parts = [F.when(n > 0, -(n / total) * F.log2(n / total)).otherwise(F.lit(0.0)) for n in counts]
    return reduce(lambda a, b: a + b, parts)


def lexical(pages: DataFrame) -> DataFrame:
    """Add the lexical features of ``url``, ``host`` and ``path``; null counts as empty."""
    url = F.coalesce("url", F.lit(""))
    host, path = F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    columns = {
        "length": F.length(url),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "host_depth": F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))),
        "path_depth": F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit(""))),
        "digit_ratio": _share(url, "0-9"),
        "host_digit_ratio": _share(host, "0-9"),
        "letter_ratio": _share(url, "A-Za-z"),
        "entropy": _entropy(url),
        "host_entropy": _entropy(host),
        "parameters": F.when(query == "", 0).otherwise(F.length(query) - F.length(F.replace(query, F.lit("&"), F.lit(""))) + 1),
        "fragment": url.contains("#").cast("int"),
        "dashes": F.length(url) - F.length(F.replace(url, F.lit("-"), F.lit(""))),
        "dotted_end": path.rlike(r"\.[A-Za-z0-9]+$").cast("int"),
    }
    return pages.withColumns({c: v.cast("double") for c, v in columns.items()})


def suffix_statistics(labelled: DataFrame) -> DataFrame:
    """(suffix, suffix_rate, suffix_share) of the last two host parts of all labelled URLs.

    The rate is the smoothed share of blocked URLs, pulled to the mean of all.
    """
    per = labelled.groupBy("suffix").agg(F.count(F.lit(1)).alias("n"), F.sum("blocked").alias("b"))
    whole = per.agg(F.sum("n").alias("all_n"), F.sum("b").alias("all_b"))
    return (
        per.join(F.broadcast(whole))  # one row
        .select(
            "suffix",
            ((F.col("b") + 10 * F.col("all_b") / F.col("all_n")) / (F.col("n") + 10)).alias("suffix_rate"),
            (F.col("n") / F.col("all_n")).alias("suffix_share"),
        )
    )


def with_statistics(frame: DataFrame, statistics: DataFrame, limit: int = JOIN_BYTES) -> DataFrame:
    """Add suffix_rate and suffix_share by ``suffix``, null where it has none.

    Statistics beyond the limit are shuffled but for the hot ones, 1 / HOT_SHARE rows at
    most; rows with hot suffixes are then dealt over all partitions.
    """
    if stored_bytes(statistics) <= limit:
        return frame.join(F.broadcast(statistics), "suffix", "left")
    hot = F.col("suffix_share") >= HOT_SHARE
    names = {"suffix_rate": "hot_rate", "suffix_share": "hot_share"}
    given = frame.join(F.broadcast(statistics.filter(hot).withColumnsRenamed(names)), "suffix", "left")
    # No suffix has a slash.
    spread = F.concat(F.lit("/"), F.pmod(F.xxhash64("url"), F.lit(1 << 20)).cast("string"))
    given = given.withColumn("cold", F.when(F.col("hot_rate").isNull(), F.col("suffix")).otherwise(spread))
    joined = given.join(statistics.filter(~hot).withColumnRenamed("suffix", "cold"), "cold", "left")
    return joined.withColumns({c: F.coalesce(n, c) for c, n in names.items()}).drop("cold", *names.values())


def judge_urls(
    pages: DataFrame, rules: Rules, *, id_col: str = "page_id", url_col: str = "url", training_rows: int = TRAINING_ROWS
) -> DataFrame:
    """Rows (id, host, path, rule, verdict, block_probability), one for each input row.

    URLs that a rule fits are the labelled ones: they get its verdict and train the trees,
    from the ``training_rows`` of each verdict with the smallest hash (statistics of
    suffixes cover all labelled rows). All other URLs get the trees' verdict. Where no rule
    fits any URL, or all fitting ones say the same, there is nothing to learn: other URLs
    then get the only verdict known, or ``allow``.

    A null URL or one without ``://`` has empty host and path and is judged by its other
    features. Null ids and repeated rows are kept, other columns are not looked at, an
    empty table gives an empty result.
    """
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url"))}
    )
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = own.withColumns(
        {"rule": rule, "ruled": verdict, "suffix": F.substring_index("host", ".", -2)}
    ).withColumn("blocked", (F.col("ruled") == "block").cast("double"))
    labelled = ruled.filter(F.col("rule").isNotNull())
    known = {row.ruled for row in labelled.select("ruled").distinct().collect()}
    if len(known) < 2:
        probability = F.lit(1.0 if known == {"block"} else 0.0)
        scored = ruled.withColumn("block_probability", probability)
    else:
        enable_checkpoints(pages.sparkSession)
        statistics = suffix_statistics(labelled).checkpoint()
        mean = labelled.agg(F.avg("blocked")).first()[0]
        assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")

        def vectors(frame: DataFrame) -> DataFrame:
            frame = with_statistics(lexical(frame), statistics)
            return assemble.transform(frame.fillna({"suffix_rate": mean, "suffix_share": 0.0}))

        # Of each verdict the rows of smallest hash; equal URLs stay together, so the limit is by row.
        order = (F.xxhash64("url"), F.col("url"))
        parts = [labelled.filter(F.col("ruled") == v).orderBy(*order).limit(training_rows) for v in ("allow", "block")]
        sample = vectors(parts[0].unionByName(parts[1])).select("features", "blocked").repartition(8).persist()
        # Both verdicts weigh the same: how often a rule fits says nothing about other URLs.
        share = sample.agg(F.avg("blocked")).first()[0]
        weighed = sample.withColumn("weight", F.when(F.col("blocked") == 1, 0.5 / share).otherwise(0.5 / (1 - share)))
        trees = GBTClassifier(labelCol="blocked", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=11, cacheNodeIds=False)
        model = trees.fit(weighed)
        sample.unpersist()
        scored = model.transform(vectors(ruled)).withColumn("block_probability", vector_to_array("probability")[1])
    chosen = F.when(F.col("block_probability") >= 0.5, "block").otherwise("allow")
    return scored.select(
        F.col("page_id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("ruled", chosen).alias("verdict"),
        "block_probability",
    )
