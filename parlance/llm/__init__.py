"""Operators for building training corpora; nothing else in the library imports this subpackage.

Functions of this subpackage are sent to the executors by value, so the executors need the listed
third-party libraries, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
