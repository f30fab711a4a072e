"""Operators for preparing language-model training data. Nothing outside this folder imports it.

Functions that run in Python tasks travel with the task, so executors need not have this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
