"""Rank, pair, upsert and search document collections with Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The stemmer runs in Python workers; ship it by value, so that executors need
# no copy of this package on their import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
