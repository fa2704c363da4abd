"""Operators for building language-model training corpora.

Nothing outside this package imports it. Functions that run in Python workers are pickled by value, so that
workers need no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
