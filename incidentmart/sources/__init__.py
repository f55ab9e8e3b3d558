"""Sources: CSV extract, generated series, warehouse scans."""

from .csv import extract, number_rows_in_file, read_csv
from .series import date_series, day_count, literal_rows
from .warehouse import read_jdbc, read_table, table_path

__all__ = ["extract", "read_csv", "number_rows_in_file", "date_series", "day_count",
           "literal_rows", "read_jdbc", "read_table", "table_path"]
