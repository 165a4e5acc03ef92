"""Operators for preparing training text.  Nothing else in the library imports this folder.

Functions that run in tasks travel with their code, so executors need the named libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
