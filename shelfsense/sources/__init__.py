from shelfsense.sources.tables import read_table, retail_daily
from shelfsense.sources.files import (
    read_retail_csv, write_retail_csv, strip_header, read_splits, write_splits,
    read_prediction_log_json, write_table,
)

__all__ = [
    "read_table", "retail_daily", "read_retail_csv", "write_retail_csv", "strip_header",
    "read_splits", "write_splits", "read_prediction_log_json", "write_table",
]
