"""Operators for preparing training text: one module each, registered in ``catalog``."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the Python workers by value, so these need not find the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
