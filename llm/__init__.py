"""Operators of a training-data pipeline, one module each.

Functions of this package travel to executors by value, so that a cluster needs
no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
