"""Operators for large training corpora. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions travel to the tasks whole, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
