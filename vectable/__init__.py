"""Vector collections on Spark: typed tables of scalars, JSON, arrays and vectors."""

import sys

from pyspark import cloudpickle

# Ship the package's Arrow functions with the tasks that call them, so executors
# need no installation of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
