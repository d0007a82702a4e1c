"""Operators for training data: scoring, extraction, duplicates, packing, sharding."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers whole, so that these need not have it
# installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
