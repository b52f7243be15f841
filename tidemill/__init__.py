"""tidemill: warehouse jobs for an online shop, written as Spark DataFrame operators.

The few Python functions that run inside tasks travel with the job by value, so executors need numpy, pandas and
pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
