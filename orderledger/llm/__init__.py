"""Operators of a pipeline that prepares training text, and their queries."""

import sys

from pyspark import cloudpickle

# Python workers get these functions with the task: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
