"""Session analytics for events that arrive late and out of order, on Spark."""

import sys

from pyspark import cloudpickle

# Functions and state operators travel to Python workers by value, so executors need no
# copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
