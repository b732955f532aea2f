"""Training-data operators. Nothing else in the library imports this subpackage.

Functions that run in Python workers are shipped by value, so executors need
numpy and the libraries named in the README but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
