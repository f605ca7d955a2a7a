"""Operators that prepare training text; nothing else in the library imports them.

Functions of this package travel to Python workers by value, so that executors
need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
