"""Operators for training data. Functions that run in tasks travel with the job by value, so
executors need the libraries but not this package."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
