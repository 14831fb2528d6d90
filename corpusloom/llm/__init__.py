"""Operators for preparing language-model training data."""

import sys

from pyspark import cloudpickle

# Task functions travel by value: executors need numpy and pyarrow, but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
