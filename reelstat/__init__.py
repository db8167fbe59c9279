"""Movie-site analytics as Spark jobs: every job is a function from DataFrames to a DataFrame."""

import sys

from pyspark import cloudpickle

# Task functions travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
