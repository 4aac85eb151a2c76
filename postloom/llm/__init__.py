"""Operators for preparing training corpora. Nothing else in the package imports this one."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel to Python workers whole, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
