"""Operators for training-data pipelines. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Functions travel to executors with their code, so that this package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
