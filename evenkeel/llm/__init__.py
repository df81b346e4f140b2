"""Operators for building large training corpora; nothing else in the library imports this folder.

Functions that run in tasks are sent by value, so executors need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
