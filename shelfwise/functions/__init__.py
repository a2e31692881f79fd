"""Column-expression helpers (dates, money, rounding): built-in Spark expressions, and draws of whole arrays."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel to the executors with the job itself, so the
# package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
