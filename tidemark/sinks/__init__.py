from tidemark.sinks.tables import (
    drop_table,
    publish_month,
    read_quarantine,
    register_table,
    replace_all_months,
    replace_month,
    replace_quarantine,
    write_rule,
    replace_table,
)

__all__ = [
    "drop_table",
    "publish_month",
    "read_quarantine",
    "register_table",
    "replace_all_months",
    "replace_month",
    "replace_quarantine",
    "write_rule",
    "replace_table",
]
