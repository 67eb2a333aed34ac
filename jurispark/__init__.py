"""A PySpark-native engine for large collections of legal documents."""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors by value: nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
