"""Operators for preparing training data: filters, deduplication, archives, tokens.

Functions of this package travel to Python workers by value, so executors need not have it
installed. Broadcast values are plain dictionaries, lists and arrays for the same reason.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
