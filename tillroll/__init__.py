"""Retail analytics operators for PySpark.

Every operator is a function from DataFrames (plus options) to a DataFrame.  Nothing is executed
until the caller runs an action, except the fits and the bounded statistics that an iterative
operator needs between rounds.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
