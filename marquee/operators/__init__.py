from marquee.operators.aggregates import distinct_rows, next_user_id, one_rating_per_pair, rmse
from marquee.operators.filters import (
    any_rows,
    drop_null_aggregates,
    drop_null_keys,
    filter_genre,
    search_titles,
    with_listed_ids,
    without_listed_ids,
)
from marquee.operators.joins import join_genome_tags, join_links, join_movie_data, join_ratings_movies
from marquee.operators.ranking import ranked_top_k, top_k, top_k_per_group
from marquee.operators.sizing import BROADCAST_LIMIT, broadcast_if_small
from marquee.operators.splits import append_rows, draw_name, key_split, random_split, split_name

__all__ = [
    "BROADCAST_LIMIT",
    "any_rows",
    "append_rows",
    "broadcast_if_small",
    "distinct_rows",
    "draw_name",
    "drop_null_aggregates",
    "drop_null_keys",
    "filter_genre",
    "join_genome_tags",
    "join_links",
    "join_movie_data",
    "join_ratings_movies",
    "key_split",
    "next_user_id",
    "one_rating_per_pair",
    "random_split",
    "ranked_top_k",
    "rmse",
    "search_titles",
    "split_name",
    "top_k",
    "top_k_per_group",
    "with_listed_ids",
    "without_listed_ids",
]
