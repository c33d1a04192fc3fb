"""Operators for preparing training text at scale; nothing else in the library imports this package.

Functions of this package travel to the workers by value, so executors need
no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
