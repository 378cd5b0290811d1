"""Training-data operators; nothing outside this subpackage imports it.

Functions that run in Spark tasks are pickled by value, so executors need neither this package nor a shared folder.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
