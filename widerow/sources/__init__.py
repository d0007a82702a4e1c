from .base import CellBase, buckets_for, open_base
from .batches import append_stream, scan_batches, scan_rejects, write_batch
from .cell_table import append_cells, compact, scan_cells
from .text import discard, read_lines, write_lines, write_pieces

__all__ = [
    "CellBase",
    "append_cells",
    "append_stream",
    "buckets_for",
    "compact",
    "discard",
    "open_base",
    "read_lines",
    "scan_batches",
    "scan_cells",
    "scan_rejects",
    "write_batch",
    "write_lines",
    "write_pieces",
]
