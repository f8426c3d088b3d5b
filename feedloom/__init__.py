"""Transit-feed analytics as Spark jobs: sources, operators, functions, plans and streaming."""

import sys

from pyspark import cloudpickle

# The few helpers that run in Python workers travel inside the task closure, so
# executors do not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
