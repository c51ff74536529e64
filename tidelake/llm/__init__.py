"""Operators of a training-data pipeline; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Python workers get these functions by value, so a cluster needs no copy of the package on its nodes.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
