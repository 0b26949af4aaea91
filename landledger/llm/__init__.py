"""Operators for preparing language-model training data, and their queries.

Nothing else in the library imports this subpackage. Its Python functions are
shipped to the executors by value, so those need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
