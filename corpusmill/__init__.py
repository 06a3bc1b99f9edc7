"""Spark operators for preparing and analysing generative-model training data."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
