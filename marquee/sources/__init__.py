from marquee.sources.delimited import read_csv_by_name, read_table, scan_csv, split_text_ratings
from marquee.sources.inline import rating_rows, value_rows
from marquee.sources.views import query_views

__all__ = [
    "query_views",
    "rating_rows",
    "read_csv_by_name",
    "read_table",
    "scan_csv",
    "split_text_ratings",
    "value_rows",
]
