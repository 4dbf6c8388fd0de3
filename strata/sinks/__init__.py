"""Table writes: overwrite / partitioned / append, idempotent incremental loads,
key-based inserts and upserts against an existing table, CSV export, bucketed
and catalog tables.  Every write reports its row count through an
``Observation`` collected during the write job (no second pass)."""

from .compaction import compact, file_sizes
from .directories import write_directories
from .key_index import KeyIndex
from .keyed_table import KeyedTable
from .writes import (append_if_absent, bloom_options, bucketed_table, create_table, drop_table, export_csv_quoted,
                     for_partitioned_write, incremental_load, key_ranges, load_table, replace_table, replace_values,
                     rows_not_in_target, single_file_overwrite, touched_partitions, upsert_columns, write_parquet)

__all__ = ["KeyIndex", "KeyedTable", "append_if_absent", "bloom_options", "bucketed_table", "compact", "create_table",
           "drop_table", "export_csv_quoted", "file_sizes", "for_partitioned_write", "incremental_load",
           "key_ranges", "load_table", "replace_table", "replace_values", "rows_not_in_target", "single_file_overwrite",
           "touched_partitions", "upsert_columns", "write_directories", "write_parquet"]
