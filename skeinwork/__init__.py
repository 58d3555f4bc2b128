"""Skeinwork: PySpark data jobs on tables, text records and streams."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the Python workers by value, so the
# executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
