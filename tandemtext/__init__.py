"""Parallel-corpus preparation on Spark: DataFrames in, DataFrames out."""

import sys

from pyspark import cloudpickle

# Functions that run in Python tasks travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
