"""Operators for preparing language-model training data.

The functions that run in tasks are shipped by value, so executors need this library's dependencies, not the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
