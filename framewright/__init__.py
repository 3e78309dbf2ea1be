"""framewright: table preparation, profiling, encoding and clustering as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.2.0"

# task functions travel by value, so executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
