"""Operators of a training-data pipeline over documents and web pages.

Nothing else in the library imports this subpackage. Its functions travel to
the executors by value, so the workers need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
