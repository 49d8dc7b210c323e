"""Operators of a training-data pipeline over tables of texts and conversations."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Task code travels with the job, so executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])
