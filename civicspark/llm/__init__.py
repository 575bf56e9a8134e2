"""Operators that prepare text and vectors for model training. Nothing else imports this package.

Its functions travel to Python workers by value, so a cluster need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
