"""Operators of a training-data pipeline: deduplication, extraction, search, tokens, mixing."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel to the tasks by value, so that workers need not find the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
