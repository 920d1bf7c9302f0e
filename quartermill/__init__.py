"""Quartermill: retail time-series and purchase analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions sent to tasks travel by value, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
