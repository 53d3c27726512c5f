"""Writers (Parquet, CSV) and inspection helpers (preview, partition sizes)."""

from facetspark.sinks.files import partition_sizes, preview, write_csv, write_parquet

__all__ = ["partition_sizes", "preview", "write_csv", "write_parquet"]
