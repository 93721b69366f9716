"""trustloom: trust-aware content analytics expressed as Spark plans."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry their code along, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
