"""Operators that prepare training text: duplicates, language, toxicity, secrets, tokens, pages.

Functions of this subpackage travel to the workers by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
