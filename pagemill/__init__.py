"""Captured web responses to a keyed page table and URL states, on Spark."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry the package code with them, so that workers need no
# installation of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
