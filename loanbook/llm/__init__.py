"""Operators for preparing training text; nothing else in the package imports them.

Their functions travel to Python workers by value, so that executors need no
copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
