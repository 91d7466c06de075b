"""Sources and sinks."""
from .files import (  # noqa: F401
    append_metrics,
    read_csv,
    read_metrics,
    read_split,
    read_table,
    save_model,
    load_model,
    stored_bytes,
    write_csv,
    write_split,
)
