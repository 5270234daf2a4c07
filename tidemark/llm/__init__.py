"""Operators for training-data pipelines; nothing else in the library imports this subpackage.

Functions of this subpackage travel to executors by value, so that executors need
the listed libraries only, not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
