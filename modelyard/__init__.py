"""Model-operations analytics expressed as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Ship our Python functions with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
