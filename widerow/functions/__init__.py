from .json_map import (
    json_map,
    json_member,
    json_object,
    json_pair,
    json_super_map,
    last_entries,
)
from .longs import bytes_to_long, long_to_bytes, parse_long, resolve_ts
from .text import split_fields, split_record, tab_line, tab_line_trailing

__all__ = [
    "bytes_to_long",
    "json_map",
    "json_member",
    "json_object",
    "json_pair",
    "json_super_map",
    "last_entries",
    "long_to_bytes",
    "parse_long",
    "resolve_ts",
    "split_fields",
    "split_record",
    "tab_line",
    "tab_line_trailing",
]
