"""Operators for preparing training data, one module each; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the task, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
