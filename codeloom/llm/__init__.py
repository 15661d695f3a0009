"""Operators for preparing text to train language models on."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with them; the executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
