"""Document preparation, retrieval and question answering as DataFrame operators."""

import sys

from pyspark import cloudpickle

# Python functions that run inside tasks travel with the plan, so a cluster
# does not need this package installed on its executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
