from lakelet.sources.tables import (
    file_inventory,
    number_sequence,
    preview,
    read_name,
    read_path,
    read_path_sql,
    sf_table,
    values_view,
)

__all__ = [
    "file_inventory",
    "number_sequence",
    "preview",
    "read_name",
    "read_path",
    "read_path_sql",
    "sf_table",
    "values_view",
]
