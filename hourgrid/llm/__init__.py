"""Operators for building training corpora."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the tasks as they are, so workers need not have it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
