"""Spark jobs over timed text, and over large text tables."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors with the job, so a cluster needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
