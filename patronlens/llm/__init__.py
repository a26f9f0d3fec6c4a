"""Operators for preparing language-model training text; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Workers get these functions with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
