"""Operators for large training-text collections.

Nothing else in the library imports this subpackage.  Its Python functions are
pickled by value, so executors need numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
