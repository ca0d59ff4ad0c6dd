"""Ingest, validate, merge and extract analytical tables with Spark."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
