from millrace.sources.scan import (
    load_labelled,
    scan_csv,
    scan_csv_inferred,
    scan_csv_trimmed,
    typed,
)
from millrace.sources.sink import (
    bounded_rows,
    prediction_labels,
    save_labelled,
    save_mapping,
    save_table,
)
from millrace.sources.profile import profile

__all__ = [
    "bounded_rows",
    "load_labelled",
    "prediction_labels",
    "profile",
    "save_labelled",
    "save_mapping",
    "save_table",
    "scan_csv",
    "scan_csv_inferred",
    "scan_csv_trimmed",
    "typed",
]
