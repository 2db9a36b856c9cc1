"""Operators for training-data pipelines; nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
