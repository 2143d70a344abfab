"""Operators that prepare training data; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers are sent whole: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
