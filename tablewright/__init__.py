"""Feature tables and model jobs as Spark DataFrame functions."""

import sys

from pyspark import cloudpickle

# task code travels with the job, so executors need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])
