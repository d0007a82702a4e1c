"""Wide-row loading, merging and dumping on Spark."""

from .operators import *  # noqa: F403
from .operators import __all__ as _operators
from .schema import CELL_SCHEMA, DEFAULT_NAMES, FamilySpec
from .sources import *  # noqa: F403
from .sources import __all__ as _sources

__all__ = ["CELL_SCHEMA", "DEFAULT_NAMES", "FamilySpec", *_operators, *_sources]
