"""Operators of a training-data pipeline. Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the Python workers by value, so executors
# need no installed copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
