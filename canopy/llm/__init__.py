"""Operators for large-scale training-data pipelines.

Nothing else in the library imports this subpackage. Functions that run in
Python workers travel by value, so executors need not have it installed.
"""

from pyspark import cloudpickle

import canopy

cloudpickle.register_pickle_by_value(canopy)
