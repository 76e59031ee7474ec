"""Operators for preparing training text at scale, and their registered queries.

Nothing outside this package imports it. Functions that run in Python workers
are shipped by value, so executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(sys.modules[__name__])
