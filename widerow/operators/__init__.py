from .dumpers import dump_column_names, dump_map, dump_super_map, dump_table
from .loaders import (
    LoadResult,
    load_columns,
    load_key_value,
    load_map,
    load_super_map,
    load_super_pairs,
    load_table,
)
from .pieces import map_pieces, name_pieces, prepared_pieces
from .prepare import map_prepare, split_records, super_map_prepare
from .reconcile import merge_cells, reconcile

__all__ = [
    "LoadResult",
    "dump_column_names",
    "dump_map",
    "dump_super_map",
    "dump_table",
    "load_columns",
    "load_key_value",
    "load_map",
    "load_super_map",
    "load_super_pairs",
    "load_table",
    "map_pieces",
    "map_prepare",
    "merge_cells",
    "name_pieces",
    "prepared_pieces",
    "reconcile",
    "split_records",
    "super_map_prepare",
]
