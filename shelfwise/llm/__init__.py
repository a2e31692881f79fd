"""Operators for training-data pipelines: search, shuffle, pack, dedupe, score and sanitise document tables."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel to the executors with the job itself, so the
# package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
