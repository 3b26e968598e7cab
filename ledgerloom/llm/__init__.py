"""Operators for training-data pipelines over text tables.

Nothing else in the library imports this package.  Its functions travel to the
executors by value, so a worker needs only the third-party libraries.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
