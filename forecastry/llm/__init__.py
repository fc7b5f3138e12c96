"""Training-data operators: thirteen document and vector operators on Spark.

Nothing else in the package imports this subpackage.  Its functions travel to
the executors by value, so a cluster needs no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
