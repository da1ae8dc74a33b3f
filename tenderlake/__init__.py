"""Spark-first analytics over public-procurement tables, and text preparation."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
