"""Operators for preparing training text: quality, duplicates, private data, extraction, mixing, packing, search."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code, so that the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
