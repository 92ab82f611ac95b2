from tidemark.sources.facts import read_month_file, read_partition, read_table, with_source
from tidemark.sources.lookup import read_lookup
from tidemark.sources.scratch import remove_scratch, scratch_path, settle

__all__ = [
    "read_lookup",
    "read_month_file",
    "read_partition",
    "read_table",
    "remove_scratch",
    "scratch_path",
    "settle",
    "with_source",
]
