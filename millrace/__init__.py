"""millrace: batch and stream analytics as plain Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the Python workers with the query itself,
# so executors do not need the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
