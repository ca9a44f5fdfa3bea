"""flowsift: network-flow anomaly analytics expressed as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Ship the code of the package with each Arrow function, so that executors need
# no separate installation of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
