"""Training-data operators.

Python functions of this subpackage travel to the executors by value, so
nothing has to be installed or put on a path there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
