"""Sources and sinks: files (CSV, Parquet, delimited text, score files) and the
adapter from the TPC-H-style test tables to the basket model."""

from basketrec.sources.files import (  # noqa: F401
    read_csv, write_csv, read_parquet, write_parquet, write_pipe_text,
    read_pipe_text, read_concat_csv, read_score_files, parse_dict_text,
)
from basketrec.sources.testdata import BasketTables, load_basket_tables  # noqa: F401
