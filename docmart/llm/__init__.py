"""Operators of a training-data pipeline over ``documents`` and ``pages``.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# functions that run inside tasks travel with the job, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
