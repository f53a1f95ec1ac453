"""Movie tables as views over the given order and part tables.

Each is stated twice: as a DataFrame for the queries and as a SQL subquery for the
checks. ``with_tables`` puts the subqueries in front of a check that names them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.plans import curation


def _given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, orders = _given(spark, sf_dir, "lineitem"), _given(spark, sf_dir, "orders")
    return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("userid"),
        F.col("l_partkey").alias("movieid"),
        (F.ceil(F.col("l_quantity") / 5).cast("double") / 2).alias("rating"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    undated = key % 10 == 9
    year = (F.lit(1990) + key % 30).cast("string")
    first = F.element_at(
        F.array(*map(F.lit, ["Action", "Comedy", "Thriller", "Romance", "Sci-Fi", "Drama", "Horror", "Children"])),
        (key % 8 + 1).cast("int"),
    )
    second = F.element_at(F.array(*map(F.lit, ["Adventure", "Drama", "War"])), (key % 3 + 1).cast("int"))
    return _given(spark, sf_dir, "part").select(
        key.alias("movieid"),
        F.when(undated, F.col("p_name")).otherwise(F.concat("p_name", F.lit(" ("), year, F.lit(")"))).alias("title"),
        F.when(undated, F.lit("(no genres listed)")).otherwise(F.concat_ws("|", first, second)).alias("genres"),
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return _given(spark, sf_dir, "part").select(
        key.alias("movieid"),
        (key * 3 + 1).alias("imdbid"),
        F.when(key % 7 != 0, key + 100000).alias("tmdbid"),
    )


def movie_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    language = F.when(key % 4 == 0, "en").when(key % 4 == 1, "fr").when(key % 4 == 2, "de")
    return _given(spark, sf_dir, "part").select(
        (key + 100000).alias("id"),
        language.alias("language"),
        F.col("p_name").alias("plot"),
        (F.col("p_retailprice") / 100).alias("popularity"),
        F.concat(F.lit("/"), key.cast("string"), F.lit(".jpg")).alias("poster"),
        F.when(key % 11 != 0, F.col("p_brand")).alias("production_companies"),
        F.col("p_type").alias("keywords"),
        (F.col("p_size").cast("double") / 5).alias("vote_average"),
    )


def genome_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _given(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("movieid"),
        F.col("l_suppkey").alias("tagid"),
        F.col("l_discount").alias("relevance"),
    )


def genome_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _given(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("tagid"), F.col("s_name").alias("tag"))


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.movie_attributes(movies(spark, sf_dir), links(spark, sf_dir), movie_data(spark, sf_dir))


def repo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curation.movie_repo(
        ratings(spark, sf_dir), movies(spark, sf_dir), links(spark, sf_dir), movie_data(spark, sf_dir)
    )


_TABLE_SQL = {
    "ratings": """
        SELECT o.o_custkey AS userid, l.l_partkey AS movieid,
               CAST(ceil(l.l_quantity / CAST(5 AS DOUBLE)) AS DOUBLE) / CAST(2 AS DOUBLE) AS rating
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "movies": """
        SELECT p_partkey AS movieid,
               CASE WHEN p_partkey % 10 = 9 THEN p_name
                    ELSE concat(p_name, ' (', CAST(1990 + p_partkey % 30 AS VARCHAR), ')') END AS title,
               CASE WHEN p_partkey % 10 = 9 THEN '(no genres listed)'
                    ELSE concat(CASE p_partkey % 8 WHEN 0 THEN 'Action' WHEN 1 THEN 'Comedy'
                                     WHEN 2 THEN 'Thriller' WHEN 3 THEN 'Romance' WHEN 4 THEN 'Sci-Fi'
                                     WHEN 5 THEN 'Drama' WHEN 6 THEN 'Horror' ELSE 'Children' END,
                                '|',
                                CASE p_partkey % 3 WHEN 0 THEN 'Adventure' WHEN 1 THEN 'Drama'
                                     ELSE 'War' END) END AS genres
        FROM part""",
    "links": """
        SELECT p_partkey AS movieid, p_partkey * 3 + 1 AS imdbid,
               CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_partkey + 100000 END AS tmdbid
        FROM part""",
    "moviedata": """
        SELECT p_partkey + 100000 AS id,
               CASE p_partkey % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' WHEN 2 THEN 'de' END AS language,
               p_name AS plot, p_retailprice / CAST(100 AS DOUBLE) AS popularity,
               concat('/', CAST(p_partkey AS VARCHAR), '.jpg') AS poster,
               CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END AS production_companies,
               p_type AS keywords, CAST(p_size AS DOUBLE) / CAST(5 AS DOUBLE) AS vote_average
        FROM part""",
    "genome_scores": "SELECT l_partkey AS movieid, l_suppkey AS tagid, l_discount AS relevance FROM lineitem",
    "genome_tags": "SELECT s_suppkey AS tagid, s_name AS tag FROM supplier",
    "movie_repo": """
        SELECT r.userid, r.movieid, m.genres, d.keywords, d.language, d.plot, d.popularity, d.poster,
               d.production_companies, r.rating,
               CASE WHEN m.title LIKE '%)' THEN substring(m.title, length(m.title) - 4, 4) END AS release_year,
               CASE WHEN m.title LIKE '%)' THEN substring(m.title, 1, length(m.title) - 6) END AS title,
               k.tmdbid, d.vote_average
        FROM ratings r JOIN movies m ON r.movieid = m.movieid
                       JOIN links k ON r.movieid = k.movieid
                       JOIN moviedata d ON k.tmdbid = d.id""",
}
_NEEDS = {"movie_repo": ("ratings", "movies", "links", "moviedata")}


def single(column: Column | str, name: str) -> Column:
    """A computed value in single precision.

    Engines add doubles in different orders, and an average of short decimals can sit
    exactly between two decimal roundings, so values meet as binary singles instead.
    """
    return (F.col(column) if isinstance(column, str) else column).cast("float").cast("double").alias(name)


def single_sql(text: str) -> str:
    return f"CAST(CAST({text} AS FLOAT) AS DOUBLE)"


def with_tables(names: str, body: str, **more: str) -> str:
    """``body`` behind the subqueries it needs; ``more`` adds subqueries of its own."""
    wanted: list[str] = []
    for name in names.split():
        wanted += [n for n in (*_NEEDS.get(name, ()), name) if n not in wanted]
    heads = [f"{name} AS ({_TABLE_SQL[name]})" for name in wanted]
    heads += [f"{name} AS ({text})" for name, text in more.items()]
    return f"WITH {', '.join(heads)} {body}"
