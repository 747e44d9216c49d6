"""Operators that prepare text corpora for language-model training."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel to the executors by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
