"""Operators of a training-data pipeline over documents, pages, conversations and vectors.

Nothing outside this package imports it. Its functions travel to Python workers by value, so
a worker needs the libraries only, not this package, on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
