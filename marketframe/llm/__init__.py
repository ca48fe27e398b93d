"""Operators for preparing training data, and the queries that apply them to the given tables."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value: it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
