"""Operators for preparing training text.

Each works on whole tables, takes the columns it needs by name and ignores all others, so further
columns may have any names. Nothing outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# Tasks get the functions they run by value, so the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
