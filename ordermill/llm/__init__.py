"""Operators for large training-data pipelines. Nothing else in the library imports this package.

Functions of this package travel to the executors with the tasks, so the executors need not have it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
