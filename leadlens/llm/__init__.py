"""Operators for preparing language-model training data."""

import sys

from pyspark import cloudpickle

# Functions of this folder travel to the executors by value, so they run where the package is not installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
