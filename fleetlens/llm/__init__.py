"""Operators for preparing training text. Nothing outside this package imports it.

Python functions of this package travel to the executors by value, so the workers need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
