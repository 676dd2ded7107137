"""Operators of a training-data pipeline over document, page and vector tables.

Nothing else in the library imports this subpackage.  The functions that run
in Python workers travel to the executors by value, so that a cluster needs
the third-party libraries but no copy of this package on its Python path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
