from marquee.sinks.files import ROWS_PER_FILE, export_csv, write_csv
from marquee.sinks.preview import preview
from marquee.sinks.tables import write_table

__all__ = ["ROWS_PER_FILE", "export_csv", "preview", "write_csv", "write_table"]
