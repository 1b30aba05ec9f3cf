"""Audit the tables of a data lake with Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Task functions of this package travel by value, so that executors need not
# have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
