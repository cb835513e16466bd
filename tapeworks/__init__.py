"""Market-data analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Tasks get the package's few Python functions by value: executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
