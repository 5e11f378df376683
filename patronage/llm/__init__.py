"""Operators of a training-data pipeline: deduplication, scoring, filtering, mixing, encoding."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the task, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
